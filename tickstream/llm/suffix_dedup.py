"""Suffix-array dedup: remove long strings that also begin elsewhere in the corpus.

1. Every window of ``length`` bytes belongs to its anchor, the place of the smallest
   hash in it. Equal windows have equal anchors at equal offsets, so they meet under the
   anchor's hash, however many documents there are. An anchor's windows lie side by
   side: they form one segment of text, known by start, number of windows and a hash.
2. Anchors that occur once hold nothing repeated. Segments that are equal as a whole
   repeat in all their windows.
3. One copy of each other segment goes to a shard with all segments of its anchor.
   A shard, as many anchors as fit, sorts its suffixes (Larsson-Sadakane) and takes their common prefixes
   (Kasai); windows that share ``length`` letters with a neighbour repeat.
4. Anchors with more text than a shard holds are cut over several. Their
   shards hand on sorted runs of window hashes, which are merged by binary search.
5. The documents get their repeated windows back and lose the bytes these cover.

Passages of many words may have fewer bytes than ``length``. Where they are asked for, texts
are taken as runs of word hashes too: their segments meet by anchors in the same way, those
that two documents have are shared as a whole, and under anchors with different segments one
copy of each gives its windows, counted by hash. Words end at ``[\\x20\\x09-\\x0D]`` and are
compared by their bytes. The pipeline removes such passages; the report counts them beside
what it removes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickstream.llm.frames import (
    as_bytes, extended, filter_by_bitmap, forget, keep, key_bitmap, session_of, text_key,
)
from tickstream.llm.suffix_array import repeated_starts
from tickstream.llm.textbatch import PIECE_BYTES, Rolling, mix, pieces, row_bounds, text_bytes, words

LENGTH = 400
# Words of a passage that the pipeline removes and the report counts besides: more than 50, whatever their bytes.
PASSAGE = 51
# Bytes hashed at each place to choose anchors: so many that few repeat by chance, and few
# enough that a window has many places to choose from.
GRAM = 128
# A shard holds at most about this much text; an anchor with more is cut over several shards.
SHARD_BYTES = 1 << 19
_PLACE = np.uint64((1 << 23) - 1)


def anchored(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Segments of joined texts: anchor hash, two hashes of the segment, row, start, windows.

    ``start`` is in letters from the row's beginning; a letter is a byte, or a word given by
    its 64-bit hash. There must be fewer than 2**23.
    """
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none.view(np.uint64), none, none, none, none, none
    size = max(1, min(GRAM, length // 3))
    grams = len(data) - size + 1
    hasher = Rolling(data, 1)
    at = np.arange(grams)
    gram = hasher(at, at + size)
    # The place in the low bits makes the leftmost of equal hashes the smallest.
    packed = gram & ~_PLACE | at.astype(np.uint64)
    span = length - size + 1
    anchor = (_sliding_min(packed, span) & _PLACE).astype(np.int64)
    windows = np.arange(len(anchor))
    row = np.searchsorted(offsets, windows, "right") - 1
    fits = windows + length <= offsets[row + 1]
    new = fits.copy()
    new[1:] &= ~(fits[:-1] & (anchor[1:] == anchor[:-1]) & (row[1:] == row[:-1]))
    start = np.flatnonzero(new)
    edge = np.flatnonzero(np.concatenate([new[1:] | ~fits[1:], [True]]) & fits) + 1
    count = edge - start
    stop = start + count + length - 1
    second = Rolling(data, 2)
    return (mix(gram[anchor[start]] + np.uint64(length)), hasher(start, stop).view(np.int64),
            second(start, stop).view(np.int64), row[start], start - offsets[row[start]], count)


def _sliding_min(values: np.ndarray, span: int) -> np.ndarray:
    """Minimum of each run of ``span`` values, from running minima of blocks of that size."""
    count = len(values) - span + 1
    blocks = -(-len(values) // span)
    padded = np.full(blocks * span, np.iinfo(np.uint64).max, np.uint64)
    padded[:len(values)] = values
    grid = padded.reshape(blocks, span)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:count], ahead[span - 1:span - 1 + count])


def _cut_rows(data: np.ndarray, offsets: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Pieces of bounded size: bytes, offsets, row of each part and where in the row it begins.

    A long text is cut into parts that overlap by length - 1 bytes, so that each of its
    windows lies in exactly one part.
    """
    for a, b in pieces(offsets):
        size = offsets[b] - offsets[a]
        if size <= 2 * PIECE_BYTES:
            yield data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], np.arange(a, b), np.zeros(b - a, np.int64)
            continue
        for begin in range(0, int(size), PIECE_BYTES):
            stop = min(int(size), begin + PIECE_BYTES + length - 1)
            yield (data[offsets[a] + begin:offsets[a] + stop], np.array([0, stop - begin]),
                   np.array([a]), np.array([begin]))


SEGMENT = "h long, s1 long, s2 long, t1 long, t2 long, start long, more binary, windows int"

Letters = Callable[[pa.Array], Iterator[tuple[int, np.ndarray, np.ndarray]]]


def byte_letters(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, letters and offsets of a whole column."""
    yield 0, *text_bytes(column)


def word_letters(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, word hashes and offsets of a column's rows, piece by piece."""
    data, offsets = text_bytes(column)
    for a, b in pieces(offsets):
        part = data[offsets[a]:offsets[b]]
        start, end, row = words(part, offsets[a:b + 1] - offsets[a])
        yield a, Rolling(part, 1)(start, end), row_bounds(row, b - a)


def segments(docs: DataFrame, length: int, text: str = "text", letters: Letters = byte_letters) -> DataFrame:
    """All segments of all texts; ``t1`` and ``t2`` name the text.

    A text that repeats a segment has one row for it, with its first start and, in
    ``more``, the others as 64-bit numbers (null: none).
    """
    names = [field.split()[0] for field in SEGMENT.split(", ")]

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            t1, t2 = (batch.column(k).to_numpy() for k in (0, 1))
            for base, data, offsets in letters(batch.column(2)):
                for part, bounds, rows, begin in _cut_rows(data, offsets, length):
                    h, s1, s2, row, start, count = anchored(part, bounds, length)
                    start = start + begin[row]
                    first, more = _repeated_rows(mix(s1.view(np.uint64) ^ mix(row.view(np.uint64))), start)
                    own = rows[row] + base
                    yield pa.RecordBatch.from_arrays(
                        [*[pa.array(x[first]) for x in (h.view(np.int64), s1, s2, t1[own], t2[own], start)],
                         pa.array(more, pa.binary()), pa.array(count[first].astype(np.int32))], names)

    return docs.select(*text_key(text), as_bytes(text).alias("body")).mapInArrow(run, SEGMENT)


def _repeated_rows(key: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, list[bytes | None]]:
    """The first place of each key, and the starts at its other places."""
    order = np.argsort(key, kind="stable")
    if not len(order):
        return order, []
    cuts = np.flatnonzero(np.concatenate([[True], key[order][1:] != key[order][:-1]]))
    counts = np.diff(np.append(cuts, len(order)))
    more: list[bytes | None] = [None] * len(cuts)
    for k in np.flatnonzero(counts > 1):
        more[k] = start[order[cuts[k] + 1:cuts[k] + counts[k]]].tobytes()
    return order[cuts], more


def repeated_windows(docs: DataFrame, length: int = LENGTH, text: str = "text") -> DataFrame:
    """Runs of windows whose string begins at least twice: (t1, t2, start, more, at, windows).

    A run begins ``at`` behind each of the segment's starts and has so many windows.
    """
    spark = session_of(docs)
    found = keep(segments(docs, length, text), "segments")
    starts = F.coalesce(F.octet_length("more") / 8, F.lit(0)).cast("long") + 1
    anchors = found.groupBy("h").agg(
        F.sum(starts).alias("occurs"), F.min("s1").alias("lo"), F.max("s1").alias("hi"))
    anchors = keep(anchors.where("occurs > 1").select("h", (F.col("lo") != F.col("hi")).alias("mixed")),
                   "anchors")
    # Equal rows are texts that occur several times; one row with their number is enough,
    # and they are counted before anything is moved by anchor.
    live = filter_by_bitmap(found, "h", key_bitmap(anchors.select("h"))).groupBy(
        "h", "s1", "s2", "t1", "t2", "start", "more", "windows").agg(
        (F.count("*") * F.first(starts)).alias("copies"))
    live = keep(live.join(anchors, "h"), "live-segments")
    forget(found)
    forget(anchors)

    kinds = live.groupBy("h", "s1", "s2", "mixed", "windows").agg(
        F.sum("copies").alias("copies"), F.min(F.struct("t1", "t2", "start")).alias("one"))
    kinds = keep(kinds.where("mixed or copies > 1").withColumn("whole", F.col("copies") > 1), "kinds")
    marks = _shard_marks(docs, kinds.where("mixed"), length, text)
    # A segment's marks hold for all its occurrences.
    whole = kinds.where("whole").select("s1", "s2", F.lit(0).alias("at"), F.col("windows").alias("marked"))
    marks = whole.unionAll(marks)
    return live.join(marks, ["s1", "s2"]).select(
        "t1", "t2", "start", "more", "at", F.col("marked").alias("windows"))


def _shard_marks(docs: DataFrame, kinds: DataFrame, length: int, text: str) -> DataFrame:
    """Runs of repeated windows (s1, s2, at, marked) in segments that do not repeat as a whole."""
    size = F.col("windows") + F.lit(length - 1)
    heavy = kinds.groupBy("h").agg(F.sum(size).alias("bytes")).where(F.col("bytes") > SHARD_BYTES // 2)
    heavy = heavy.select("h", F.ceil(F.col("bytes") / (SHARD_BYTES // 2)).cast("long").alias("cuts"))
    placed = kinds.join(heavy, "h", "left").withColumn(
        "unit", F.xxhash64("h", F.pmod(F.col("s1"), F.coalesce("cuts", F.lit(1)))))
    cut = F.col("cuts").isNotNull()
    wanted = placed.select(
        F.col("one.t1").alias("t1"), F.col("one.t2").alias("t2"), F.col("one.start").alias("start"),
        "windows", "s1", "s2", "unit", "whole", cut.alias("cut"))
    loaded = _segment_texts(docs, wanted, length, text)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _shards(source):
            yield from _shard(rows, length)

    dealt = loaded.repartition("unit").sortWithinPartitions("unit", "s1")
    out = keep(dealt.mapInArrow(run, "s1 long, s2 long, at int, marked int, part int, run binary"), "shard-marks")
    marks = out.where(F.col("run").isNull()).select("s1", "s2", "at", "marked")
    return marks.unionAll(_merge_runs(out.where(F.col("run").isNotNull()).select("part", "run")))


def _segment_texts(docs: DataFrame, wanted: DataFrame, length: int, text: str) -> DataFrame:
    """The wanted segments with their bytes, cut from one copy of each text."""
    texts = docs.select(*text_key(text), as_bytes(text).alias("body"))
    texts = filter_by_bitmap(texts, "t1", key_bitmap(wanted.select("t1")))
    asked = wanted.groupBy("t1", "t2").agg(F.collect_list(F.struct(
        "start", "windows", "s1", "s2", "unit", "whole", "cut")).alias("asked"))
    one = texts.groupBy("t1", "t2").agg(F.first("body").alias("body")).join(asked, ["t1", "t2"])
    bytes_ = F.substring("body", (F.col("a.start") + 1).cast("int"), F.col("a.windows") + F.lit(length - 1))
    return one.select("body", F.explode("asked").alias("a")).select(
        "a.unit", "a.s1", "a.s2", "a.windows", "a.whole", "a.cut", bytes_.alias("bytes"))


def _shards(source: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Shards of whole units, from rows ordered by unit.

    A unit, an anchor's segments or a cut of them, has little over half of SHARD_BYTES; a
    shard is closed at the first unit that makes it larger than SHARD_BYTES.
    """
    held: list[pa.RecordBatch] = []
    last, size = None, 0
    for batch in source:
        if not batch.num_rows:
            continue
        unit = batch.column(0).to_numpy()
        lengths = np.concatenate([[0], np.cumsum([len(x.as_buffer()) for x in batch.column(6)])])
        cuts = [0, *(np.flatnonzero(unit[1:] != unit[:-1]) + 1).tolist(), len(unit)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if unit[a] != last and size > SHARD_BYTES:
                yield pa.Table.from_batches(held)
                held, size = [], 0
            held.append(batch.slice(a, b - a))
            last, size = unit[a], size + int(lengths[b] - lengths[a])
    if held:
        yield pa.Table.from_batches(held)


def _shard(rows: pa.Table, length: int) -> Iterator[pa.RecordBatch]:
    """Marks of one shard, and for cut anchors the runs of its window hashes."""
    s1, s2 = rows.column(1).to_numpy(), rows.column(2).to_numpy()
    windows = rows.column(3).to_numpy().astype(np.int64)
    whole, cut = (rows.column(k).to_numpy().astype(bool) for k in (4, 5))
    data, offsets = text_bytes(rows.column(6))
    first = np.concatenate([[0], np.cumsum(windows)])
    owner = np.repeat(np.arange(len(windows)), windows)
    inside = np.arange(first[-1]) - first[owner]
    starts = offsets[owner] + inside
    group = repeated_starts(data, offsets[1:], starts, length)
    hit = (group >= 0) & ~whole[owner]
    yield _mark_rows(s1, s2, owner[hit], inside[hit])
    if not cut.any():
        return
    # Windows of cut anchors that are not known to repeat, and one of each known group.
    known = group >= 0
    leader = np.zeros(len(group), bool)
    leader[np.unique(group, return_index=True)[1]] = True
    mine = cut[owner] & (~known | leader)
    settled = (known | whole[owner])[mine]
    at = starts[mine]
    one, two = (Rolling(data, seed)(at, at + length) for seed in (1, 2))
    record = np.stack([one, two, s1[owner[mine]].view(np.uint64), s2[owner[mine]].view(np.uint64),
                       inside[mine].astype(np.uint64) << np.uint64(1) | settled.astype(np.uint64)], axis=1)
    record = record[np.lexsort((two, one))]
    part = (record[:, 0] >> np.uint64(52)).astype(np.int32)
    edges = np.append(np.unique(part, return_index=True)[1], len(part))
    blobs = [record[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:])]
    none = pa.nulls(len(blobs), pa.int64())
    yield pa.RecordBatch.from_arrays(
        [none, none, pa.nulls(len(blobs), pa.int32()), pa.nulls(len(blobs), pa.int32()),
         pa.array(part[edges[:-1]]), pa.array(blobs, pa.binary())], ["s1", "s2", "at", "marked", "part", "run"])


def _mark_rows(s1: np.ndarray, s2: np.ndarray, owner: np.ndarray, inside: np.ndarray) -> pa.RecordBatch:
    """Neighbouring windows of a segment as one row."""
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (inside[1:] != inside[:-1] + 1)
    at = np.flatnonzero(new)
    count = np.diff(np.append(at, len(owner)))
    return pa.RecordBatch.from_arrays(
        [pa.array(s1[owner[at]], pa.int64()), pa.array(s2[owner[at]], pa.int64()),
         pa.array(inside[at].astype(np.int32)), pa.array(count.astype(np.int32)),
         pa.nulls(len(at), pa.int32()), pa.nulls(len(at), pa.binary())],
        ["s1", "s2", "at", "marked", "part", "run"])


def _merge_runs(runs: DataFrame) -> DataFrame:
    """Marks of windows whose hash is in the sorted run of another shard, by binary search.

    Runs of one range of hashes meet in one task; the ranges are 4,096 equal parts.
    """
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, []
        for batch in source:
            for part, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                if part != last and held:
                    yield _merged(held)
                    held = []
                last = part
                held.append(np.frombuffer(blob.as_py(), np.uint64).reshape(-1, 5))
        if held:
            yield _merged(held)

    dealt = runs.repartition("part").sortWithinPartitions("part")
    return dealt.mapInArrow(run, "s1 long, s2 long, at int, marked int")


def _merged(runs: list[np.ndarray]) -> pa.RecordBatch:
    out = []
    every = np.concatenate(runs)
    every = every[np.lexsort((every[:, 1], every[:, 0]))]
    for own in runs:
        low = np.searchsorted(every[:, 0], own[:, 0], "left")
        high = np.searchsorted(every[:, 0], own[:, 0], "right")
        # Within a run hashes are distinct, so a second entry is another shard's.
        several = high - low > 1
        several[several] = [
            (every[a:b, 1] == x).sum() > 1
            for a, b, x in zip(low[several], high[several], own[several, 1])]
        out.append(own[several & (own[:, 4] & np.uint64(1) == 0)])
    hits = np.concatenate(out)
    count = len(hits)
    return pa.RecordBatch.from_arrays(
        [pa.array(hits[:, 2].view(np.int64)), pa.array(hits[:, 3].view(np.int64)),
         pa.array((hits[:, 4] >> np.uint64(1)).astype(np.int32)), pa.array(np.ones(count, np.int32))],
        ["s1", "s2", "at", "marked"])


WINDOW = "w1 long, w2 long, s1 long, s2 long, at int, text long, whole boolean"


def shared_windows(docs: DataFrame, size: int, text: str = "text") -> DataFrame:
    """Runs of windows of ``size`` words that two rows have: (t1, t2, start, more, at, windows).

    As ``repeated_windows``, counted in words; what only one row repeats is not among them.
    """
    found = keep(segments(docs, size, text, word_letters), "passage-segments")
    anchors = found.groupBy("h").agg(
        F.count("*").alias("rows"), F.min("s1").alias("lo"), F.max("s1").alias("hi"))
    anchors = keep(anchors.where("rows > 1").select("h", (F.col("lo") != F.col("hi")).alias("mixed")),
                   "passage-anchors")
    # Equal rows are rows with the same text.
    live = filter_by_bitmap(found, "h", key_bitmap(anchors.select("h"))).groupBy(
        "h", "s1", "s2", "t1", "t2", "start", "more", "windows").agg(F.count("*").alias("copies"))
    live = keep(live.join(anchors, "h"), "passage-live")
    forget(found)
    forget(anchors)

    kinds = live.groupBy("s1", "s2", "mixed", "windows").agg(
        F.min(F.struct("t1", "t2", "start")).alias("one"),
        ((F.min("t1") != F.max("t1")) | (F.max("copies") > 1)).alias("whole"))
    kinds = keep(kinds.where("mixed or whole"), "passage-kinds")
    every = keep(_passage_windows(docs, kinds.where("mixed"), size, text), "passage-windows")
    shared = every.groupBy("w1", "w2").agg(
        (F.bool_or("whole") | (F.min("text") != F.max("text"))).alias("shared")).where("shared")
    marks = every.where("not whole").join(shared, ["w1", "w2"]).select(
        "s1", "s2", "at", F.lit(1).alias("marked"))
    whole = kinds.where("whole").select("s1", "s2", F.lit(0).alias("at"), F.col("windows").alias("marked"))
    return live.join(whole.unionAll(marks), ["s1", "s2"]).select(
        "t1", "t2", "start", "more", "at", F.col("marked").alias("windows"))


def _passage_windows(docs: DataFrame, kinds: DataFrame, size: int, text: str) -> DataFrame:
    """All windows of the segments, hashed from one copy of each text."""
    wanted = kinds.select("one.t1", "one.t2", F.struct("one.start", "windows", "s1", "s2", "whole").alias("a"))
    texts = docs.select(*text_key(text), as_bytes(text).alias("body"))
    texts = filter_by_bitmap(texts, "t1", key_bitmap(wanted.select("t1")))
    asked = wanted.groupBy("t1", "t2").agg(F.collect_list("a").alias("asked"))
    one = texts.groupBy("t1", "t2").agg(F.first("body").alias("body")).join(asked, ["t1", "t2"])

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for base, code, bounds in word_letters(batch.column(1)):
                part = batch.slice(base, len(bounds) - 1)
                lists = part.column(2)
                flat = lists.flatten()
                start, windows, s1, s2 = (flat.field(k).to_numpy() for k in range(4))
                row = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
                owner = np.repeat(np.arange(len(start)), windows)
                inside = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
                at = bounds[row[owner]] + start[owner] + inside
                one, two = (Rolling(code, seed)(at, at + size).view(np.int64) for seed in (1, 2))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (one, two, s1[owner], s2[owner], inside.astype(np.int32),
                                           part.column(0).to_numpy()[row[owner]],
                                           flat.field(4).to_numpy(zero_copy_only=False)[owner])],
                    ["w1", "w2", "s1", "s2", "at", "text", "whole"])

    return one.select("t1", "body", "asked").mapInArrow(run, WINDOW)


def remove_repeats(docs: DataFrame, length: int = LENGTH, text: str = "text",
                   kept: str = "kept", removed: str = "removed", keep_text: bool = True,
                   passage: int | None = None, passages: str | None = None) -> DataFrame:
    """The frame with the bytes that stay and the removed runs (replaced where they exist).

    Every byte covered by a string of ``length`` bytes that also starts anywhere else in
    the table, the same text included, is removed; overlaps count, and strings are judged
    on the input. ``kept`` is binary, since cuts may fall inside characters;
    ``removed`` lists maximal runs as start and end in bytes. Null counts as empty; shorter
    texts are left alone; repeated rows are occurrences like any other. ``keep_text=False``
    leaves the text itself out. With ``passage``, runs of so many words that another row has
    too are removed as well, from their first word to their last; if ``passages`` names a
    column, they stay and are listed there like the removed ones.
    """
    session_of(docs)
    marks = repeated_windows(docs, length, text).withColumn("unit", F.lit(0))
    if passage:
        marks = marks.unionByName(shared_windows(docs, passage, text).withColumn("unit", F.lit(1)))
    marks = marks.groupBy("t1", "t2").agg(
        F.collect_list(F.struct("start", "more", "at", "windows", "unit")).alias("marks"))
    marks = marks.select(F.col("t1").alias("__m1"), F.col("t2").alias("__m2"), F.col("marks").alias("__marks"))
    lists = [removed, passages] if passages else [removed]
    base = docs.drop(*[c for c in (kept, *lists) if c != text])
    one, two = text_key(text)
    joined = base.withColumn("__t1", one).withColumn("__t2", two).join(
        marks, (F.col("__t1") == F.col("__m1")) & (F.col("__t2") == F.col("__m2")), "left")
    base = base if keep_text else base.drop(text)
    joined = joined.select(*base.columns, "__marks", as_bytes(text).alias("__bytes"))

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            if not batch.num_rows:
                continue
            bodies = batch.column(batch.num_columns - 1)
            row, start, stop, worded = _places(batch.column(batch.num_columns - 2), bodies, length, passage)
            parts = [~worded, worded] if passages else [slice(None)]
            spans = [_maximal(row[k], start[k], stop[k]) for k in parts]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-2], _without(bodies, *spans[0]), *[_span_lists(batch.num_rows, *x) for x in spans]],
                [*batch.schema.names[:-2], kept, *lists])

    schema = extended(base, {kept: "binary"} | dict.fromkeys(lists, "array<struct<start: long, end: long>>"))
    return joined.mapInArrow(run, schema)


def _places(marks: pa.Array, bodies: pa.Array, length: int, passage: int | None) -> tuple[np.ndarray, ...]:
    """Bytes that each run of windows covers, of all rows: row, start, stop and whether it counts words."""
    flat = marks.flatten()
    row = np.repeat(np.arange(len(marks)), marks.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    at, windows, unit = (flat.field(k).to_numpy() for k in (2, 3, 4))
    start = flat.field(0).to_numpy() + at
    several = np.flatnonzero(flat.field(1).is_valid().to_numpy(zero_copy_only=False))
    if len(several):
        more = [np.frombuffer(flat.field(1)[int(k)].as_py(), np.int64) + at[k] for k in several]
        times = [len(x) for x in more]
        start = np.concatenate([start, *more])
        row, windows, unit = (np.concatenate([x, np.repeat(x[several], times)]) for x in (row, windows, unit))
    stop = start + windows + length - 1
    worded = unit == 1
    if worded.any():
        own, k = np.unique(row[worded], return_inverse=True)
        data, offsets = text_bytes(bodies.take(pa.array(own)))
        first, last, word_row = words(data, offsets)
        word = row_bounds(word_row, len(own))[k] + start[worded]
        start[worded] = first[word] - offsets[k]
        stop[worded] = last[word + windows[worded] + passage - 2] - offsets[k]
    return row, start, stop, worded


def _maximal(row: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of the places, by row and start."""
    order = np.lexsort((start, row))
    row, start, stop = row[order], start[order], stop[order]
    # A row's places lie behind all of the row before.
    lift = row << 32
    reach = np.maximum.accumulate(stop + lift)
    first = np.flatnonzero(np.concatenate([[True], (start + lift)[1:] > reach[:-1]])[:len(row)])
    last = np.append(first[1:], len(row))[:len(first)] - 1
    return row[first], start[first], (reach[last] - lift[first])


def _without(bodies: pa.Array, row: np.ndarray, start: np.ndarray, stop: np.ndarray) -> pa.Array:
    """The texts without their maximal runs."""
    data, offsets = text_bytes(bodies)
    edge = np.zeros(len(data) + 1, np.int8)
    edge[offsets[row] + start] += 1
    edge[offsets[row] + stop] -= 1
    stay = data[np.cumsum(edge[:-1], dtype=np.int8) == 0]
    gone = np.zeros(len(offsets), np.int64)
    np.add.at(gone, row + 1, stop - start)
    ends = (offsets - np.cumsum(gone)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(bodies), [None, pa.py_buffer(ends), pa.py_buffer(stay)])


def _span_lists(rows: int, row: np.ndarray, start: np.ndarray, stop: np.ndarray) -> pa.Array:
    spans = pa.StructArray.from_arrays([pa.array(start), pa.array(stop)], ["start", "end"])
    return pa.ListArray.from_arrays(pa.array(row_bounds(row, rows), pa.int32()), spans)


def repeat_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and a digest of the bytes that stay; n_passages and n_passage_bytes.

    The last two are the runs of over 50 words that another document has, and their bytes. They
    are counted, not removed: a passage of fewer bytes than ``LENGTH`` stays whole.
    """
    cut = remove_repeats(docs.select("doc_id", "text"), keep_text=False, passage=PASSAGE, passages="passages")
    gone, shared = (F.aggregate(name, F.lit(0).cast("long"), lambda total, r: total + r["end"] - r["start"])
                    for name in ("removed", "passages"))
    return cut.select(
        "doc_id", (F.octet_length("kept") + gone).alias("n_bytes"), gone.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
        F.size("passages").cast("long").alias("n_passages"), shared.alias("n_passage_bytes"))


def cut_repeats(docs: DataFrame, length: int = LENGTH, passage: int | None = PASSAGE) -> DataFrame:
    """Pipeline stage: the documents without repeated strings and passages; emptied ones are dropped.

    A character cut in two becomes a replacement character. ``n_chars`` follows the text.
    """
    columns = docs.columns
    cut = remove_repeats(docs, length, kept="__kept", removed="__removed", passage=passage)
    text = F.when(F.size("__removed") > 0, F.make_valid_utf8(F.col("__kept").cast("string"))).otherwise(F.col("text"))
    out = cut.where((F.octet_length("__kept") > 0) | (F.size("__removed") == 0)).withColumn("text", text)
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.when(F.size("__removed") > 0, F.length("text").cast("long"))
                             .otherwise(F.col("n_chars")))
    return out.select(*columns)

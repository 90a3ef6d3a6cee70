"""N-gram Jaccard join of whole texts with signature trees.

1. Every text becomes its set of hashed word shingles; texts with equal sets form one
   class, known by its size and two short bitmaps. In the same pass shingles are counted
   in a table of fixed size, which later only orders them: rare ones first.
2. A class is dealt to one bucket per token of its prefix. By the order's prefix
   property two similar sets meet in a bucket. A bucket falls apart where sizes differ too
   much, and what is left of one class alone is dropped.
3. Each class is paired with the least class of its buckets. Pairs that the bitmaps do not
   rule out form groups: a class goes, with its text, to the group it shares most buckets
   with. Big groups are cut into parts that all hold the group's head. In a part a
   signature tree is built and walked against itself; surviving pairs are checked exactly.
4. Buckets of three classes or more in which classes are still unconnected are walked with
   signature trees once more, across parts; of buckets of two, the pairs are taken that no
   group has compared. A class that may link with a class of a larger connected group is sent
   to that group, whose tree it is walked against, and what survives is checked exactly. So
   every link between different sets is found, or its ends are connected already.
5. Connected classes are named by their smallest document id.

A bucket's or group's size bounds no task: rows of frequent keys are spread over
parts by class, heads of parts meet in a second, smaller step, and large buckets are walked as
pairs of blocks.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickstream.llm.frames import (
    as_bytes, components, consecutive, extended, forget, in_bitmap, keep, key_bitmap, session_of,
)
from tickstream.llm.signature_tree import (
    SHORT_BITS, Groups, SignatureTree, Threshold, bitmaps, common_count, parities, similar_pairs, spanning_links,
)
from tickstream.llm.textbatch import (
    distinct_in_rows, mix, pieces, row_bounds, shingles, sort_in_rows, text_bytes,
)

ORDER_BITS = 20
_CHUNKS = 64
# Bucket rows handled by one step, and above which estimated frequency a key is spread.
PART_ROWS = 200_000
HOT_KEY_ROWS = 50_000
# A group's part holds at most about this many classes and shingles.
GROUP_CLASSES = 1_000
GROUP_SHINGLES = 1_000_000
BLOCK_CLASSES = 4_096
# Rows of groups, some 30 bytes each, that are sent to all tasks; more are joined by a shuffle.
SENT_ROWS = 1_000_000


def set_hash(hashes: np.ndarray, rows: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Size and a 64-bit hash of each row's set of distinct hashes; 0 for an empty set."""
    bounds = row_bounds(rows, count)
    size = np.diff(bounds)
    total = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(mix(hashes ^ np.uint64(0x5851F42D4C957F2D)), out=total[1:])
    value = mix(total[bounds[1:]] - total[bounds[:-1]] + mix(size.astype(np.uint64)))
    return size, np.where(size > 0, value, np.uint64(0))


def _sets(column: pa.Array, width: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row range, distinct shingle hashes and their rows (from 0), piece by piece."""
    data, offsets = text_bytes(column)
    for a, b in pieces(offsets):
        part = data[offsets[a]:offsets[b]]
        yield a, b, *distinct_in_rows(*shingles(part, offsets[a:b + 1] - offsets[a], width))


SET_COLUMNS = {"n_shingles": "long", "set_key": "long", "bits": "binary", "parity": "binary"}
COUNT_COLUMNS = {"chunk": "int", "counts": "binary"}


def document_sets(docs: DataFrame, width: int, text: str = "text") -> DataFrame:
    """The rows without their text, with SET_COLUMNS: the set's size, hash and bitmaps.

    Besides these rows (``chunk`` null) each task adds its counts of shingles by
    hash cell, in chunks of a table of 2**ORDER_BITS cells.
    """
    kept = docs.drop(text, *SET_COLUMNS, *COUNT_COLUMNS)
    schema = extended(kept, SET_COLUMNS | COUNT_COLUMNS)
    names = schema.names

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << ORDER_BITS, np.uint32)
        types = None
        for batch in source:
            rows = batch.num_rows
            types = [c.type for c in batch.columns[:-1]]
            sizes, keys = np.zeros(rows, np.int64), np.zeros(rows, np.uint64)
            bits, odd = (np.zeros((rows, SHORT_BITS // 64), np.uint64) for _ in range(2))
            for a, b, hashes, owner in _sets(batch.column(batch.num_columns - 1), width):
                sizes[a:b], keys[a:b] = set_hash(hashes, owner, b - a)
                bounds = row_bounds(owner, b - a)
                bits[a:b] = bitmaps(hashes, bounds, SHORT_BITS)
                odd[a:b] = parities(hashes, bounds)
                cells, times = np.unique(hashes >> np.uint64(64 - ORDER_BITS), return_counts=True)
                counts[cells] += times.astype(np.uint32)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(sizes), pa.array(keys.view(np.int64)),
                 _blobs(bits), _blobs(odd), pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary())], names)
        if types is None:
            return
        parts = counts.reshape(_CHUNKS, -1)
        some = np.flatnonzero(parts.any(axis=1))
        empty = [*types, pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        yield pa.RecordBatch.from_arrays(
            [*[pa.nulls(len(some), t) for t in empty], pa.array(some, pa.int32()),
             pa.array([parts[k].tobytes() for k in some], pa.binary())], names)

    rest = [c for c in docs.columns if c in kept.columns]
    return docs.select(*rest, as_bytes(text).alias("__bytes")).mapInArrow(run, schema)


def _blobs(rows: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in rows], pa.binary())


def _rows(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """The rows of a column written by ``_blobs``."""
    blobs = column.to_pylist()
    return np.frombuffer(b"".join(blobs), np.uint64).reshape(len(blobs), -1)


def frequency_levels(counts: DataFrame) -> np.ndarray:
    """Logarithmic frequency of each cell over all documents; 2**ORDER_BITS bytes."""
    cells = (1 << ORDER_BITS) // _CHUNKS

    def add(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in source:
            for chunk, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                one = np.frombuffer(blob, np.uint32 if len(blob) == 4 * cells else np.uint64)
                total[chunk] = total.get(chunk, np.zeros(cells, np.uint64)) + one
        if total:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.int32()),
                 pa.array([v.tobytes() for v in total.values()], pa.binary())], ["chunk", "counts"])

    shape = "chunk int, counts binary"
    partial = counts.withColumn("part", F.spark_partition_id() % 16).repartition("chunk", "part")
    partial = partial.select("chunk", "counts").mapInArrow(add, shape)
    out = np.zeros((_CHUNKS, cells))
    for row in partial.repartition("chunk").mapInArrow(add, shape).collect():
        out[row["chunk"]] = np.frombuffer(row["counts"], np.uint64)
    return np.minimum(4 * np.log2(1 + out.ravel()), 255).astype(np.uint8)


def _hot_parts(key: np.ndarray) -> np.ndarray:
    """Over how many parts the rows of a key are spread, by the frequency in its high bits."""
    level = (key >> np.uint64(56)).astype(np.float64)
    return np.maximum(1, np.exp2(level / 4.0) // HOT_KEY_ROWS).astype(np.uint64)


def prefix_buckets(docs: DataFrame, width: int, limit: Threshold, levels: np.ndarray, parts: int,
                   text: str = "text") -> DataFrame:
    """Prefix tokens of all classes, packed into one binary per part: keys, classes, sizes.

    A key is the token's frequency level, then its hash: keys sort rare tokens first.
    """
    sent = docs.sparkSession.sparkContext.broadcast(levels)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size = 0
        for batch in source:
            for a, b, hashes, owner in _sets(batch.column(0), width):
                sizes, classes = set_hash(hashes, owner, b - a)
                level = sent.value[(hashes >> np.uint64(64 - ORDER_BITS)).astype(np.int64)]
                key = sort_in_rows(level.astype(np.uint64) << np.uint64(56) | hashes >> np.uint64(8), owner)
                rank = np.arange(len(key)) - row_bounds(owner, b - a)[owner]
                first = np.zeros(b - a, bool)
                first[np.unique(classes, return_index=True)[1]] = True
                use = (rank < limit.prefix(sizes)[owner]) & first[owner]
                held.append((key[use], classes[owner[use]], sizes[owner[use]].astype(np.uint32)))
                size += int(use.sum())
            if size > PART_ROWS:
                yield _packed(held, parts)
                held, size = [], 0
        if size:
            yield _packed(held, parts)

    return docs.select(as_bytes(text).alias("b")).mapInArrow(run, "part int, rows binary")


def _packed(held: list[tuple[np.ndarray, ...]], parts: int) -> pa.RecordBatch:
    key, cls, size = (np.concatenate(x) for x in zip(*held))
    part = (mix(key + mix(cls) % _hot_parts(key)) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    key, cls, size, part = key[order], cls[order], size[order], part[order]
    names, starts = np.unique(part, return_index=True)
    ends = np.append(starts[1:], len(part))
    blobs = [key[a:b].tobytes() + cls[a:b].tobytes() + size[a:b].tobytes() for a, b in zip(starts, ends)]
    return pa.RecordBatch.from_arrays(
        [pa.array(names, pa.int32()), pa.array(blobs, pa.binary())], ["part", "rows"])


def _unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    count = len(blob) // 20
    return (np.frombuffer(blob, np.uint64, count), np.frombuffer(blob, np.int64, count, 8 * count),
            np.frombuffer(blob, np.uint32, count, 16 * count).astype(np.int64))


_STAR, _ROW, _HEAD = 0, 1, 2


def shared_buckets(packed: DataFrame, limit: Threshold) -> DataFrame:
    """What the buckets with two classes or more say, as (kind, x, y, n).

    _STAR: class x shares n buckets with their least class y. _ROW: bucket x of three classes
    or more holds class y; buckets of equal classes have one name. _HEAD: y is the least
    class in one part of the frequent key x, all of whose rows are given.
    """
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, blobs in _by_key(source, 1):
            rows = [_unpacked(blob.as_py()) for blob in blobs]
            yield from _bucket_rows(*(np.concatenate(x) for x in zip(*rows)), limit)

    dealt = packed.repartition("part").sortWithinPartitions("part")
    return dealt.mapInArrow(run, "kind int, x long, y long, n long")


def _by_key(source: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[int, list]]:
    """Values of a column for each run of equal keys in the first column."""
    now, held = None, []
    for batch in source:
        for key, value in zip(batch.column(0).to_pylist(), batch.column(column)):
            if key != now and held:
                yield now, held
                held = []
            now = key
            held.append(value)
    if held:
        yield now, held


def _bucket_rows(key: np.ndarray, cls: np.ndarray, size: np.ndarray,
                 limit: Threshold) -> Iterator[pa.RecordBatch]:
    order = np.lexsort((cls, size, key))
    key, cls, size = key[order], cls[order], size[order]
    if not len(key):
        return
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (cls[1:] != cls[:-1])
    key, cls, size = key[new], cls[new], size[new]
    spread = _hot_parts(key) > 1
    # In a run of ascending sizes no pair reaches over a step that is too large. Keys that
    # are spread are not cut, since no part sees all their sizes.
    cut = np.ones(len(key), bool)
    cut[1:] = (key[1:] != key[:-1]) | (~spread[1:] & (size[:-1] * limit.den < size[1:] * limit.num))
    starts = np.flatnonzero(cut)
    counts = np.diff(np.append(starts, len(key)))
    least = np.minimum.reduceat(cls, starts)
    lead = np.repeat(least, counts)
    lead_size = np.repeat(np.maximum.reduceat(np.where(cls == lead, size, 0), starts), counts)
    near = (size * limit.den >= lead_size * limit.num) & (lead_size * limit.den >= size * limit.num)
    star = near & (cls != lead)
    member, head = cls[star], lead[star]
    order = np.lexsort((head, member))
    member, head = member[order], head[order]
    at = np.zeros(0, np.int64)
    if len(member):
        at = np.flatnonzero(np.concatenate([[True], (member[1:] != member[:-1]) | (head[1:] != head[:-1])]))
    yield _kind(_STAR, member[at], head[at], np.diff(np.append(at, len(member))))
    # A bucket is named by its classes, so that equal ones fall together.
    name = np.add.reduceat(mix(cls.view(np.uint64)), starts) + mix(counts.astype(np.uint64))
    name = np.where(spread[starts], key[starts], name)
    name, live = np.repeat(name, counts), np.repeat((counts > 2) | spread[starts], counts)
    pairs = np.unique(np.stack([name[live].view(np.int64), cls[live]]), axis=1)
    yield _kind(_ROW, pairs[0], pairs[1], None)
    top = spread[starts]
    yield _kind(_HEAD, key[starts[top]].view(np.int64), least[top], None)


def _kind(kind: int, x: np.ndarray, y: np.ndarray, n: np.ndarray | None) -> pa.RecordBatch:
    count = len(x)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(count, kind, np.int32)), pa.array(x, pa.int64()), pa.array(y, pa.int64()),
         pa.array(np.ones(count, np.int64) if n is None else n.astype(np.int64))], ["kind", "x", "y", "n"])


def star_pairs(shared: DataFrame, classes: DataFrame, limit: Threshold) -> DataFrame:
    """(member, home, n, size): a class and the least class of n of its buckets, if they may link."""
    stars = shared.where(F.col("kind") == _STAR).select(F.col("x").alias("member"), F.col("y").alias("home"), "n")
    heads = shared.where(F.col("kind") == _HEAD).select(F.col("x").alias("key"), F.col("y").alias("member"))
    least = heads.groupBy("key").agg(F.min("member").alias("home"))
    across = heads.join(least, "key").where("member != home").select("member", "home", F.lit(1).alias("n"))
    shares = stars.unionAll(across).groupBy("member", "home").agg(F.sum("n").alias("n"))
    return possible_pairs(shares, "member", "home", classes, limit)


def home_groups(pairs: DataFrame) -> DataFrame:
    """Where classes are compared: (member, home, part, head), with the head in each part."""
    homes = pairs.groupBy("member").agg(
        F.max_by("home", F.struct("n", -F.col("home"))).alias("home"),
        F.first("size").alias("n_shingles"))
    sizes = homes.groupBy("home").agg(
        F.greatest(F.ceil(F.count("*") / GROUP_CLASSES),
                   F.ceil(F.sum("n_shingles") / GROUP_SHINGLES)).cast("long").alias("parts"))
    members = homes.join(sizes, "home").select(
        "member", "home", F.pmod(F.xxhash64("member"), "parts").alias("part"), F.lit(False).alias("head"))
    tops = sizes.select(F.col("home").alias("member"), "home",
                        F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"),
                        F.lit(True).alias("head"))
    return members.unionAll(tops)


def possible_pairs(pairs: DataFrame, one: str, two: str, classes: DataFrame, limit: Threshold) -> DataFrame:
    """The pairs of classes that sizes and bitmaps do not rule out, with the first one's size."""
    def side(name: str, k: int) -> DataFrame:
        return classes.select(F.col("set_key").alias(name), F.col("n_shingles").alias(f"n{k}"),
                              F.col("bits").alias(f"b{k}"), F.col("parity").alias(f"p{k}"))

    def pick(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            sides = [(batch.column(f"n{k}").to_numpy(), _rows(batch.column(f"b{k}")),
                      _rows(batch.column(f"p{k}"))) for k in (1, 2)]
            kept = pa.RecordBatch.from_arrays(
                [*batch.columns[:-6], batch.column("n1")], [*batch.schema.names[:-6], "size"])
            yield kept.filter(pa.array(limit.may_link(*sides)))

    both = pairs.join(side(one, 1), one).join(side(two, 2), two).select(
        *pairs.columns, "n1", "b1", "p1", "n2", "b2", "p2")
    return both.mapInArrow(pick, extended(pairs, {"size": "long"}))


def class_texts(docs: DataFrame, wanted: DataFrame, width: int, text: str = "text") -> DataFrame:
    """Texts (set_key, body) of each wanted class, and perhaps of some others; one per task and class."""
    # Texts that are surely not wanted are left out where their sets are built, since a
    # second Python step in one stage would need a second worker per task.
    sent = docs.sparkSession.sparkContext.broadcast(key_bitmap(wanted))

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in source:
            keys = np.zeros(batch.num_rows, np.uint64)
            for a, b, hashes, owner in _sets(batch.column(0), width):
                _, keys[a:b] = set_hash(hashes, owner, b - a)
            first = np.sort(np.unique(keys, return_index=True)[1])
            first = first[(keys[first] != 0) & in_bitmap(sent.value, keys[first])]
            first = first[[key not in seen for key in keys[first].tolist()]]
            seen.update(keys[first].tolist())
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[first].view(np.int64)), batch.column(0).take(pa.array(first))],
                ["set_key", "body"])

    return docs.select(as_bytes(text).alias("b")).mapInArrow(run, "set_key long, body binary")


def group_links(groups: DataFrame, texts: DataFrame, width: int, limit: Threshold) -> DataFrame:
    """What exact links connect inside each part of a group, found with its signature tree.

    Rows (a, b) say that class b is connected with a, the least class it is connected with there.
    """
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, hashes, bounds, bits, _ in _loaded_groups(source, width):
            groups = Groups(len(keys))
            for i, j in spanning_links(hashes, bounds, bits, limit):
                groups.join(i, j)
            root = groups.roots(np.arange(len(keys)))
            least = np.full(len(keys), np.iinfo(np.int64).max)
            np.minimum.at(least, root, keys)
            least = least[root]
            far = least != keys
            yield pa.RecordBatch.from_arrays([pa.array(least[far]), pa.array(keys[far])], ["a", "b"])

    return _dealt(groups, texts).mapInArrow(run, "a long, b long")


def _dealt(groups: DataFrame, texts: DataFrame) -> DataFrame:
    """Texts beside the parts of groups they belong to, each part together, its head first.

    Where the groups' rows are few enough to be sent, texts find their part where they are read
    and are moved once; else by a join on the class. Copies of a class come one from each task.
    """
    groups = keep(groups, "dealt-groups")
    if groups.count() <= SENT_ROWS:
        groups = F.broadcast(groups)
    sent = texts.join(groups, F.col("member") == F.col("set_key"))
    dealt = sent.select("home", "part", "member", "head", "body").repartition("home", "part")
    return dealt.sortWithinPartitions("home", "part", F.desc("head"), "member")


def _without_copies(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows without those whose first four columns are the row's before."""
    last = None
    for batch in source:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(4)], axis=1)
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]).any(axis=1)
        new[0] = last is None or (keys[0] != last).any()
        last = keys[-1]
        if new.any():
            yield batch.filter(pa.array(new))


def _loaded_groups(source: Iterator[pa.RecordBatch], width: int):
    """Class keys, shingle sets, bitmaps and head flags of each group, from rows ordered by group."""
    held: list[pa.RecordBatch] = []

    def load(rows: list[pa.RecordBatch]):
        table = pa.Table.from_batches(rows)
        home, part = (table.column(k).to_numpy() for k in (0, 1))
        keys, heads = table.column(2).to_numpy(), table.column(3).to_numpy().astype(bool)
        new = np.ones(len(keys), bool)
        new[1:] = (home[1:] != home[:-1]) | (part[1:] != part[:-1])
        data, offsets = text_bytes(table.column(4))
        found, owners = [], []
        for a, b in pieces(offsets):
            hashes, owner = distinct_in_rows(
                *shingles(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], width))
            found.append(hashes)
            owners.append(owner + a)
        hashes = np.concatenate(found)
        bounds = row_bounds(np.concatenate(owners), len(keys))
        bits = bitmaps(hashes, bounds)
        starts = np.append(np.flatnonzero(new), len(keys))
        for s, e in zip(starts[:-1], starts[1:]):
            lo, hi = bounds[s], bounds[e]
            yield keys[s:e], hashes[lo:hi], bounds[s:e + 1] - lo, bits[s:e], heads[s:e]

    last = None
    for batch in _without_copies(source):
        # Rows of a group may go on in the next batch: the open group is held back.
        home, part = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        change = np.flatnonzero((home[1:] != home[:-1]) | (part[1:] != part[:-1])) + 1
        if last is not None and last != (home[0], part[0]):
            yield from load(held)
            held = []
        if len(change):
            cut = int(change[-1])
            yield from load([*held, batch.slice(0, cut)])
            held = [batch.slice(cut)]
        else:
            held.append(batch)
        last = (home[-1], part[-1])
    if held:
        yield from load(held)


def connected(links: DataFrame) -> DataFrame:
    """(id, root, members) of all classes in links (a, b): a class that it is connected with.

    Not all that is connected has one root; what differs is only looked at once more.
    """
    low = links.groupBy(F.col("b").alias("id")).agg(F.min("a").alias("root"))
    own = links.select(F.col("a").alias("id")).distinct().join(low.select("id"), "id", "left_anti")
    every = low.unionByName(own.withColumn("root", F.col("id")))
    return every.join(every.groupBy("root").agg(F.count("*").alias("members")), "root").select(
        "id", "root", "members")


def open_targets(rows: DataFrame, labels: DataFrame, classes: DataFrame, limit: Threshold) -> DataFrame:
    """(member, home): classes that may link with some class of another root, its home.

    Only buckets with several roots are looked at. Each is walked with signature trees, as
    pairs of blocks where it is large. Of two roots the one with fewer classes sends its own.
    """
    named = rows.join(labels, rows["y"] == labels["id"], "left").select(
        F.col("x").alias("key"), F.col("y").alias("cls"), F.coalesce("root", "y").alias("root"),
        F.coalesce("members", F.lit(1)).alias("members"))
    mixed = named.groupBy("key").agg(
        F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("size")).where("lo != hi")
    blocks = F.ceil(F.col("size") / BLOCK_CLASSES).cast("long")
    spread = (
        named.join(mixed.select("key", "size"), "key").withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64("cls"), "blocks"))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                "block", "cls", "root", "members")
    )
    sent = spread.join(classes, spread["cls"] == classes["set_key"]).select(
        "key", "i", "j", "block", "cls", "root", "members", "n_shingles", "bits", "parity")

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows_ in consecutive(source, 3):
            found = _walked_bucket(rows_, limit)
            yield pa.RecordBatch.from_arrays([pa.array(found[0]), pa.array(found[1])], ["member", "home"])

    dealt = sent.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return dealt.mapInArrow(run, "member long, home long")


def other_targets(pairs: DataFrame, groups: DataFrame, labels: DataFrame) -> DataFrame:
    """(member, home) as of ``open_targets``, from star pairs that no group has compared.

    A class goes to one group only. Where two classes alone share a bucket, no row of the
    bucket names them, so a pair with another least class would be lost.
    """
    def side(name: str, k: int) -> DataFrame:
        return labels.select(F.col("id").alias(name), F.col("root").alias(f"r{k}"), F.col("members").alias(f"m{k}"))

    compared = groups.where("NOT head").select("member", "home")
    rest = pairs.select("member", "home").join(compared, ["member", "home"], "left_anti")
    ends = rest.join(side("member", 1), "member", "left").join(side("home", 2), "home", "left").select(
        "member", "home", F.coalesce("r1", "member").alias("r1"), F.coalesce("r2", "home").alias("r2"),
        F.coalesce("m1", F.lit(1)).alias("m1"), F.coalesce("m2", F.lit(1)).alias("m2")).where("r1 != r2")
    turn = (F.col("m1") > F.col("m2")) | ((F.col("m1") == F.col("m2")) & (F.col("r1") < F.col("r2")))
    return ends.select(F.when(turn, F.col("home")).otherwise(F.col("member")).alias("member"),
                       F.when(turn, F.col("r1")).otherwise(F.col("r2")).alias("home"))


def _walked_bucket(rows: pa.Table, limit: Threshold) -> np.ndarray:
    cls, root, members = (rows.column(k).to_numpy() for k in (4, 5, 6))
    size, bits, odd = rows.column(7).to_numpy(), _rows(rows.column(8)), _rows(rows.column(9))
    own = rows.column(1)[0].as_py() == rows.column(2)[0].as_py()
    at = to = np.arange(len(cls))
    if not own:
        left = rows.column(3).to_numpy() == rows.column(1)[0].as_py()
        at, to = np.flatnonzero(left), np.flatnonzero(~left)
    one = SignatureTree(size[at], bits[at])
    two = one if own else SignatureTree(size[to], bits[to])
    found = [np.zeros((2, 0), np.int64)]
    for i, j in similar_pairs(one, two, limit, lambda i, j: root[at[i]] == root[to[j]]):
        i, j = at[i], to[j]
        near = limit.may_link((size[i], bits[i], odd[i]), (size[j], bits[j], odd[j]))
        i, j = i[near], j[near]
        turn = (members[i] > members[j]) | ((members[i] == members[j]) & (root[i] < root[j]))
        i, j = np.where(turn, j, i), np.where(turn, i, j)
        found.append(np.unique(np.stack([cls[i], root[j]]), axis=1))
    return np.unique(np.concatenate(found, axis=1), axis=1)


def target_links(targets: DataFrame, labels: DataFrame, classes: DataFrame, texts: DataFrame,
                 width: int, limit: Threshold) -> DataFrame:
    """Links (a, b) of sent classes with a class of their home, one for each that has any.

    Homes with many classes or many sent ones are compared as parts times blocks.
    """
    homes = targets.select("home").distinct()
    held = homes.join(labels.select(F.col("root").alias("home"), "id"), "home", "left").select(
        F.coalesce("id", "home").alias("member"), "home")
    sizes = classes.select(F.col("set_key").alias("member"), "n_shingles")

    def cuts(rows: DataFrame, name: str) -> DataFrame:
        return rows.join(sizes, "member").groupBy("home").agg(
            F.greatest(F.ceil(F.count("*") / GROUP_CLASSES),
                       F.ceil(F.sum("n_shingles") / GROUP_SHINGLES)).cast("long").alias(name))

    def dealt(rows: DataFrame, own: str, other: str, head: bool) -> DataFrame:
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1))
        out = rows.join(grid, "home").select(
            "member", "home", F.pmod(F.xxhash64("member"), own).alias(own + "_no"), every.alias(other + "_no"),
            "blocks", F.lit(head).alias("head"))
        return out.select("member", "home", (F.col("parts_no") * F.col("blocks") + F.col("blocks_no")).alias("part"), "head")

    grid = cuts(held, "parts").join(cuts(targets, "blocks"), "home")
    groups = dealt(targets, "blocks", "parts", True).unionAll(dealt(held, "parts", "blocks", False))

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, hashes, bounds, bits, sent in _loaded_groups(source, width):
            size = np.diff(bounds)
            asks, has = np.flatnonzero(sent), np.flatnonzero(~sent)
            linked = np.full(len(keys), -1)
            one, two = SignatureTree(size[asks], bits[asks]), SignatureTree(size[has], bits[has])
            for i, j in similar_pairs(one, two, limit, lambda i, j: linked[asks[i]] >= 0):
                for a, b in zip(asks[i].tolist(), has[j].tolist()):
                    if linked[a] < 0 and common_count(
                            hashes[bounds[a]:bounds[a + 1]], hashes[bounds[b]:bounds[b + 1]],
                    ) >= limit.needed(int(size[a] + size[b])):
                        linked[a] = b
            found = np.flatnonzero(linked >= 0)
            yield pa.RecordBatch.from_arrays([pa.array(keys[linked[found]]), pa.array(keys[found])], ["a", "b"])

    return _dealt(groups, texts).mapInArrow(run, "a long, b long")


def jaccard_groups(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100,
                   text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_shingles, set_key, component_id), one row per row of the input.

    Two documents link when ``den * common >= num * union`` of their sets of ``width``-word
    shingles (letters A-Z folded). A text with fewer words is one shingle; null texts and
    texts without words have n_shingles 0, link with nothing and are their own component.
    ``component_id`` is the least non-null id reachable by links. Repeated rows and ids
    each keep their row. An empty table gives an empty result.
    """
    spark = session_of(docs)
    limit = Threshold(num, den)
    body = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    first = keep(document_sets(body, width), "sets")
    sets = first.where(F.col("chunk").isNull()).select("doc_id", *SET_COLUMNS)
    levels = frequency_levels(first.where(F.col("chunk").isNotNull()).select("chunk", "counts"))
    classes = sets.where("n_shingles > 0").groupBy("set_key").agg(
        F.min("doc_id").alias("least"), F.first("n_shingles").alias("n_shingles"),
        F.first("bits").alias("bits"), F.first("parity").alias("parity"))
    classes = keep(classes, "set-classes")
    total = sets.agg(F.sum(F.col("n_shingles") * (den - num) / den + 1)).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(total // PART_ROWS) + 1)

    packed = prefix_buckets(body, width, limit, levels, parts)
    shared = keep(shared_buckets(packed, limit), "buckets")
    pairs = keep(star_pairs(shared, classes, limit), "pairs")
    groups = keep(home_groups(pairs), "groups")
    texts = class_texts(body, groups.select("member"), width)
    links = keep(group_links(groups, texts, width, limit), "links")
    labels = keep(connected(links), "labels")

    rows = shared.where(F.col("kind") == _ROW).select("x", "y").distinct()
    targets = open_targets(rows, labels, classes, limit).unionAll(other_targets(pairs, groups, labels))
    targets = keep(targets.distinct(), "targets")
    # What nothing reads any more goes at once, or it would lie beside all that follows.
    for table in (shared, pairs, groups):
        forget(table)
    found = [links]
    if not targets.isEmpty():
        held = labels.join(targets.select(F.col("home").alias("root")).distinct(), "root", "left_semi")
        wanted = targets.select("member").unionAll(targets.select("home")).unionAll(held.select("id"))
        more = target_links(targets, labels, classes, class_texts(body, wanted, width), width, limit)
        found.append(keep(more, "more-links"))
    roots = components(functools.reduce(DataFrame.unionAll, found))
    for table in (*found, targets, labels):
        forget(table)

    named = classes.join(roots, classes["set_key"] == roots["id"], "left").select(
        "set_key", "least", F.coalesce("root", "set_key").alias("root"))
    names = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(names, "root").select("set_key", "component_id")
    return sets.join(named, "set_key", "left").select(
        "doc_id", "n_shingles", "set_key", F.coalesce("component_id", "doc_id").alias("component_id"))


def jaccard_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id at three-word shingles and a similarity of 0.9."""
    return jaccard_groups(docs, 3, 90, 100).select("doc_id", "n_shingles", "component_id")


def keep_one_of_group(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """Pipeline stage: of each group of near copies the row with the least id stays.

    Of repeated rows one stays. Rows without words are in no group and all stay.
    """
    groups = jaccard_groups(docs, width, num, den).where(
        (F.col("n_shingles") > 0) & F.col("doc_id").eqNullSafe(F.col("component_id")))
    chosen = groups.select(F.col("doc_id").alias("__id"), F.col("set_key").alias("__key")).distinct()
    keyed = with_set_key(docs, width)
    empty = keyed.where("__set = 0")
    kept = keyed.where("__set != 0").join(
        chosen, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__set") == F.col("__key")), "left_semi")
    return kept.dropDuplicates(["doc_id", "__set"]).unionByName(empty).select(*docs.columns)


def with_set_key(docs: DataFrame, width: int, text: str = "text") -> DataFrame:
    """The frame with the hash of each text's shingle set as ``__set`` (0: no words)."""
    session_of(docs)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            keys = np.zeros(batch.num_rows, np.uint64)
            for a, b, hashes, owner in _sets(batch.column(batch.num_columns - 1), width):
                _, keys[a:b] = set_hash(hashes, owner, b - a)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(keys.view(np.int64))], [*batch.schema.names[:-1], "__set"])

    return docs.withColumn("__bytes", as_bytes(text)).mapInArrow(run, extended(docs, {"__set": "long"}))


JACCARD_SQL = r"""
WITH RECURSIVE listed AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE
    WHEN w IS NULL OR len(w) = 0 THEN []
    WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
    END AS s
  FROM listed
), tokens AS (SELECT doc_id, unnest(s) AS t FROM sets),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
  FROM tokens a JOIN tokens b ON a.t = b.t AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT x, y FROM common
  JOIN sets sx ON sx.doc_id = x JOIN sets sy ON sy.doc_id = y
  WHERE 100 * n >= 90 * (len(sx.s) + len(sy.s) - n)
), linked AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (
  SELECT doc_id AS id, doc_id AS least FROM sets
  UNION
  SELECT b.y, r.least FROM reach r JOIN linked b ON b.x = r.id WHERE r.least < b.y
)
SELECT s.doc_id, len(s.s) AS n_shingles, m.least AS component_id
FROM sets s JOIN (SELECT id, min(least) AS least FROM reach GROUP BY id) m ON m.id = s.doc_id
"""

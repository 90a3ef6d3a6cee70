"""Quality rules and an isolation forest on their statistics.

Word, line and symbol counts of whole texts are taken in numpy and stored, one short
row per document. Fixed rules fail some of them. An isolation forest fitted on a
bounded sample of the stored rows scores the rest: documents that random splits
separate after few steps are anomalous. How anomalous is too much is calibrated on
the labelled rows, per band of text length.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickstream.llm.frames import as_bytes, extended, keep, session_of
from tickstream.llm.textbatch import BLANK, Rolling, mix, pieces, runs, text_bytes, words

WINDOW_WORDS = 8
# Fixed rule: too few words, or too large a share of words in repeated windows.
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

SAMPLE_DOCS = 8_192
TREES = 128
TREE_ROWS = 256
# Share of labelled good documents that calibration may reject, per length band.
MAX_LOSS = 0.002
# A band's own cut weighs as much as that of all bands together at this many good rows.
BAND_ROWS = 500
SCORE_BINS = 2_000

STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
         "n_lines", "n_upper", "n_digits", "n_punct", "n_distinct_words", "n_bytes"]


def _byte_set(chars: bytes) -> np.ndarray:
    flags = np.zeros(256, bool)
    flags[list(chars)] = True
    return flags


_SYMBOL = _byte_set(b"#*$%&|<>")
_UPPER = _byte_set(bytes(range(65, 91)))
_DIGIT = _byte_set(bytes(range(48, 58)))
_PUNCT = _byte_set(b"!?.,;:-_()[]{}\"'/\\=+~@^`")


def text_stats(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Counts per row, in the order of STATS, of joined texts."""
    count = len(offsets) - 1
    out = np.zeros((count, len(STATS)), np.int64)
    for a, b in pieces(offsets):
        part = data[offsets[a]:offsets[b]]
        out[a:b] = _piece_stats(part, offsets[a:b + 1] - offsets[a])
    return out


def _piece_stats(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    count = len(offsets) - 1

    def per_row(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags)])
        return sums[offsets[1:]] - sums[offsets[:-1]]

    start, end, row = words(data, offsets)
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    n_words = np.bincount(row, minlength=count)
    word_chars = np.bincount(row, points[end] - points[start], count).astype(np.int64)
    hasher = Rolling(data)
    word = hasher(start, end)
    # Distinct words are counted at their first occurrence.
    _, first = np.unique(mix(word ^ mix(row.astype(np.uint64))), return_index=True)
    n_distinct = np.bincount(row[first], minlength=count)
    lines, dups = _lines(data, offsets, hasher, count)
    return np.stack([
        n_words, word_chars, per_row(_SYMBOL[data]), dups, _repeats(word, row, count), lines,
        per_row(_UPPER[data]), per_row(_DIGIT[data]), per_row(_PUNCT[data]), n_distinct,
        np.diff(offsets)], axis=1)


def _lines(data: np.ndarray, offsets: np.ndarray, hasher: Rolling,
           count: int) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word, and those equal to an earlier one, per row."""
    breaks = np.flatnonzero(data == 10)
    start = np.sort(np.concatenate([offsets[:-1], breaks + 1]))
    end = np.sort(np.concatenate([breaks, offsets[1:]]))
    # Empty rows give lines of their own; starts and ends still pair up in order.
    solid = np.concatenate([[0], np.cumsum(~BLANK[data])])
    full = solid[end] > solid[start]
    start, end = start[full], end[full]
    row = np.searchsorted(offsets, start, "right") - 1
    lines = np.bincount(row, minlength=count)
    _, first = np.unique(mix(hasher(start, end) ^ mix(row.astype(np.uint64))), return_index=True)
    return lines, lines - np.bincount(row[first], minlength=count)


def _repeats(word: np.ndarray, row: np.ndarray, count: int) -> np.ndarray:
    """Words inside windows of eight words that occur twice or more in their row."""
    total = len(word) - WINDOW_WORDS + 1
    if total <= 0:
        return np.zeros(count, np.int64)
    at = np.flatnonzero(row[:total] == row[WINDOW_WORDS - 1:])
    hashes, owner = runs(word, row, WINDOW_WORDS)
    long_rows = np.bincount(row, minlength=count) >= WINDOW_WORDS
    hashes = hashes[long_rows[owner]]
    key = mix(hashes ^ mix(row[at].astype(np.uint64)))
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(key), bool)
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    edge = np.zeros(len(word) + 1, np.int64)
    np.add.at(edge, at[twice], 1)
    np.add.at(edge, at[twice] + WINDOW_WORDS, -1)
    covered = np.cumsum(edge[:-1]) > 0
    return np.bincount(row, covered, count).astype(np.int64)


def with_stats(docs: DataFrame, text: str = "text") -> DataFrame:
    """The frame with the columns of STATS in place of the text (null: no words)."""
    session_of(docs)
    kept = docs.drop(text, *STATS)
    schema = extended(kept, dict.fromkeys(STATS, "long"))

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            stats = text_stats(*text_bytes(batch.column(batch.num_columns - 1)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *[pa.array(c) for c in stats.T]],
                [*batch.schema.names[:-1], *STATS])

    rest = [c for c in docs.columns if c in kept.columns]
    return docs.select(*rest, as_bytes(text).alias("__bytes")).mapInArrow(run, schema)


def features(stats: np.ndarray) -> np.ndarray:
    """Ratios that describe a document whatever its length, and the length itself."""
    s = {name: stats[:, k].astype(float) for k, name in enumerate(STATS)}
    n, chars = np.maximum(s["n_words"], 1), np.maximum(s["word_chars"], 1)
    lines = np.maximum(s["n_lines"], 1)
    # A trait that shows in several ratios is met by more of the random splits.
    return np.stack([
        s["n_symbols"] / chars, np.log1p(s["n_symbols"]), s["n_symbols"] / lines, s["n_punct"] / chars,
        s["word_chars"] / n, s["n_symbols"] / n, s["n_dup_lines"] / lines,
        s["n_repeat_words"] / n, s["n_upper"] / chars, s["n_digits"] / chars, s["n_punct"] / n,
        s["n_lines"] / n, np.log(n) - np.log(np.maximum(s["n_distinct_words"], 1)), np.log(n),
    ], axis=1)


@dataclass(frozen=True)
class Forest:
    """Trees of equal depth in heap order: split feature, split value, path length at leaves."""

    feature: np.ndarray
    value: np.ndarray
    length: np.ndarray
    rows: int

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Anomaly in (0, 1): 2 ** -(mean path length / its expectation)."""
        total = np.zeros(len(x))
        every = np.arange(len(x))
        for feature, value, length in zip(self.feature, self.value, self.length):
            node = np.zeros(len(x), np.int64)
            while True:
                inner = feature[node] >= 0
                if not inner.any():
                    break
                pick = every[inner]
                at = node[pick]
                node[pick] = 2 * at + 1 + (x[pick, feature[at]] >= value[at])
            total += length[node]
        return 2.0 ** -(total / len(self.feature) / (_expected(self.rows) or 1.0))


def _expected(n: int) -> float:
    """Mean path length of an unsuccessful search in a tree of n rows."""
    return 0.0 if n <= 1 else 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n if n > 2 else 1.0


def fit_forest(x: np.ndarray, trees: int = TREES, rows: int = TREE_ROWS, seed: int = 11) -> Forest:
    rng = np.random.default_rng(seed)
    rows = min(rows, len(x))
    depth = max(1, math.ceil(math.log2(max(rows, 2))))
    size = (1 << (depth + 1)) - 1
    feature = np.full((trees, size), -1)
    value = np.zeros((trees, size))
    length = np.zeros((trees, size))
    for t in range(trees):
        heap = [(0, 0, x[rng.choice(len(x), rows, replace=False)])] if rows else []
        while heap:
            node, level, part = heap.pop()
            low, high = part.min(axis=0), part.max(axis=0)
            open_ = np.flatnonzero(high > low)
            if level == depth or len(part) <= 1 or not len(open_):
                length[t, node] = level + _expected(len(part))
                continue
            f = int(rng.choice(open_))
            cut = rng.uniform(low[f], high[f])
            cut = cut if cut > low[f] else high[f]
            feature[t, node], value[t, node] = f, cut
            side = part[:, f] >= cut
            heap += [(2 * node + 1, level + 1, part[~side]), (2 * node + 2, level + 1, part[side])]
    return Forest(feature, value, length, rows)


def fit(stats: DataFrame, labels: DataFrame | None = None, sample_docs: int = SAMPLE_DOCS,
        doc_id: str = "doc_id", quality: str = "quality") -> Forest:
    """A forest from the stored statistics of at most ``sample_docs`` rows, taken by a hash.

    Rows that fail the base rules or are labelled bad are left out, so that what the forest
    has seen is ordinary and the rest stands out.
    """
    usable = stats.where(~base_failed())
    if labels is not None:
        bad = labels.where(F.col(quality) <= 0).select(F.col(doc_id).alias("__id"))
        usable = usable.join(bad, F.col(doc_id) == F.col("__id"), "left_anti")
    # By the id too, so that copies of one text come in by their share, not as one block.
    picked = usable.orderBy(
        F.xxhash64(doc_id, *STATS, F.lit(3)), *STATS).select(*STATS).limit(sample_docs).collect()
    rows = np.array([tuple(r) for r in sorted(picked)], np.int64).reshape(-1, len(STATS))
    return fit_forest(features(rows))


def _band():
    return F.least(F.floor(F.log2(F.greatest("n_words", F.lit(1)))), F.lit(20)).cast("int")


def score(stats: DataFrame, forest: Forest) -> DataFrame:
    """The statistics with ``anomaly`` and the length ``band``."""
    sent = stats.sparkSession.sparkContext.broadcast(forest)
    kept = stats.drop("anomaly", "band")
    at = [kept.columns.index(name) for name in STATS]

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            rows = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in at], axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(sent.value.scores(features(rows)))],
                [*batch.schema.names, "anomaly"])

    return kept.mapInArrow(run, extended(kept, {"anomaly": "double"})).withColumn("band", _band())


def thresholds(scored: DataFrame, labels: DataFrame, max_loss: float = MAX_LOSS,
               doc_id: str = "doc_id", quality: str = "quality") -> dict[int, float]:
    """Per length band the anomaly above which documents are rejected; -1 holds for other bands.

    All labelled rows that pass the base rules count, in fixed bins. Of the cuts that
    reject at most ``max_loss`` of a band's good rows, the lowest one is taken: it
    rejects most bad rows. It is averaged with the cut of all bands together, which weighs
    as much as BAND_ROWS good rows. Without labels nothing is rejected.
    """
    marked = labels.where(F.col(quality).isNotNull()).select(
        F.col(doc_id).alias("__id"), (F.col(quality) > 0).alias("__good"))
    rows = (
        scored.where(~base_failed()).join(marked, F.col(doc_id) == F.col("__id"))
        .groupBy("band", F.floor(F.col("anomaly") * SCORE_BINS).cast("int").alias("bin"))
        .agg(F.sum(F.col("__good").cast("int")).alias("good")).collect()
    )
    good = np.zeros((22, SCORE_BINS + 1))
    for r in rows:
        good[r["band"], r["bin"]] += r["good"]

    def cut(counts: np.ndarray) -> float:
        above = np.cumsum(counts[::-1])[::-1]
        allowed = np.flatnonzero(above <= max_loss * counts.sum())
        return float(allowed[0]) / SCORE_BINS if counts.sum() and len(allowed) else 2.0

    every = cut(good.sum(axis=0))
    out = {-1: every}
    for band in range(21):
        rows_seen = good[band].sum()
        if rows_seen:
            out[band] = float((rows_seen * cut(good[band]) + BAND_ROWS * every) / (rows_seen + BAND_ROWS))
    return out


def base_failed():
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def judge(scored: DataFrame, cuts: dict[int, float]) -> DataFrame:
    """Adds ``base_failed`` and ``kept``."""
    limit = F.lit(cuts[-1])
    for band, cut in cuts.items():
        if band >= 0:
            limit = F.when(F.col("band") == band, F.lit(cut)).otherwise(limit)
    return scored.withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & (F.col("anomaly") < limit))


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics, base verdict and final verdict of every document.

    Null and empty texts have no words, fail the base rules and are not kept.
    """
    stats = keep(with_stats(docs.select("doc_id", "text")), "rule-stats")
    scored = score(stats, fit(stats, labels))
    judged = judge(scored, thresholds(scored, labels))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "anomaly")

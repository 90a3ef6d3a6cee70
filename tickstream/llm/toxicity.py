"""Toxicity: a linear-chain conditional random field that tags toxic words.

Labels exist per document only, so words are labelled from them first: in toxic
documents of a bounded sample, a word counts as toxic if its own log-odds, or those of
its first letters, single it out from clean documents. A two-state CRF is trained on sentences
with these labels. Its forward-backward marginals give each word's probability to be
toxic; their largest value and sums give the document's score, calibrated on the
sample's document labels, and the words above one half are the offending spans.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickstream.llm.frames import as_bytes, fold, in_bitmap, keep, key_bitmap, session_of
from tickstream.llm.textbatch import Rolling, mix, pieces, text_bytes, words

# Bounds of the training sample: labelled documents per class, sentences.
MAX_TOXIC_DOCS = 6_000
MAX_CLEAN_DOCS = 12_000
MAX_SENTENCES = 12_000
# A sequence of the CRF is a sentence; longer ones are cut.
MAX_TOKENS = 256
CELL_BITS = 18
# A key is toxic if it is in this many toxic documents at least, and this many times
# likelier there than in clean ones.
MIN_TOXIC_DOCS = 5
MIN_ODDS = 20.0
PREDICT_AT = 0.3

# Bytes that are no letters or digits end a word; those of letters beyond ASCII do not.
_BREAK = np.ones(256, bool)
_BREAK[128:] = False
for _char in b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz'":
    _BREAK[_char] = False
_STOP = np.zeros(256, bool)
_STOP[list(b".!?\n")] = True


@dataclass(frozen=True)
class Tokens:
    """Words of some rows, with the sentence each belongs to."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    sentence: np.ndarray  # first token of each sentence, plus the end
    word: np.ndarray
    parts: list[np.ndarray]  # hashes of the first and last letters


def tokenize(data: np.ndarray, offsets: np.ndarray) -> Tokens:
    start, end, row = words(data, offsets, _BREAK)
    hasher = Rolling(data, 1, True)
    word = hasher(start, end)
    parts = [mix(hasher(start, np.minimum(start + k, end)) + np.uint64(k)) for k in (3, 4, 5)]
    parts += [mix(hasher(np.maximum(end - k, start), end) + np.uint64(16 + k)) for k in (3, 4)]
    stops = np.concatenate([[0], np.cumsum(_STOP[data])])
    if not len(start):
        return Tokens(start, end, row, np.zeros(1, np.int64), word, parts)
    new = np.ones(len(start), bool)
    new[1:] = (stops[start[1:]] > stops[end[:-1]]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    at = np.arange(len(start)) - np.repeat(first, np.diff(np.append(first, len(start))))
    sentence = np.append(np.flatnonzero(at % MAX_TOKENS == 0), len(start))
    return Tokens(start, end, row, sentence, word, parts)


def feature_cells(tokens: Tokens) -> np.ndarray:
    """Hash cells of each word's features: itself, its ends and its neighbours."""
    before = np.zeros_like(tokens.word)
    after = np.zeros_like(tokens.word)
    before[1:], after[:-1] = tokens.word[:-1], tokens.word[1:]
    if len(tokens.word):
        before[tokens.sentence[:-1]] = 0
        after[tokens.sentence[1:] - 1] = 0
    columns = [tokens.word, *tokens.parts, mix(before + np.uint64(77)), mix(after + np.uint64(78))]
    return np.stack([(c >> np.uint64(64 - CELL_BITS)).astype(np.int32) for c in columns], axis=1)


@dataclass(frozen=True)
class Crf:
    """Emission weights of the toxic state (the clean state's are 0) and transitions."""

    weights: np.ndarray
    bias: float
    moves: np.ndarray  # log potentials, from x to

    def emissions(self, cells: np.ndarray) -> np.ndarray:
        return np.clip(self.bias + self.weights[cells].sum(axis=1), -30, 30)


def forward_backward(emission: np.ndarray, sentence: np.ndarray,
                     moves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Odds of the toxic state from the left and from the right, and the marginals.

    With two states each message is one number, the odds of toxic over clean. All
    sentences advance together, longest first, so a step works on those still open.
    """
    e = np.exp(emission)
    oo, ot, to, tt = np.exp(moves).ravel()
    first = sentence[:-1]
    length = np.diff(sentence)
    order = np.argsort(-length, kind="stable")
    first, length = first[order], length[order]
    steps = int(length[0]) if len(length) else 0
    open_at = np.searchsorted(-length, -np.arange(1, steps + 1), "right")
    left = np.empty_like(e)
    ratio = np.ones(len(first))
    for t in range(steps):
        m = open_at[t]
        at = first[:m] + t
        r = e[at] if t == 0 else e[at] * (ot + tt * ratio[:m]) / (oo + to * ratio[:m])
        left[at] = ratio[:m] = r
    right = np.ones_like(e)
    for t in range(steps - 2, -1, -1):
        at = first[:open_at[t + 1]] + t
        g = e[at + 1] * right[at + 1]
        right[at] = (to + tt * g) / (oo + ot * g)
    odds = left * right
    return left, right, odds / (1 + odds)


def train_crf(cells: np.ndarray, label: np.ndarray, sentence: np.ndarray, rounds: int = 60,
              rate: float = 0.3, decay: float = 1e-4) -> Crf:
    """Maximum likelihood with AdaGrad on all sentences at once."""
    weights, bias, moves = np.zeros(1 << CELL_BITS), 0.0, np.zeros((2, 2))
    size = len(label)
    if not size:
        return Crf(weights.astype(np.float32), -10.0, moves)
    squares, square_bias, square_moves = np.full(len(weights), 1e-8), 1e-8, np.full((2, 2), 1e-8)
    inner = np.ones(size, bool)
    inner[sentence[1:] - 1] = False  # words that have a successor in their sentence
    at = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (label[at], label[at + 1]), 1)
    flat = cells.ravel()
    for _ in range(rounds):
        model = Crf(weights, bias, moves)
        e = model.emissions(cells)
        left, right, marginal = forward_backward(e, sentence, moves)
        gap = (marginal - label) / size
        step = np.bincount(flat, np.repeat(gap, cells.shape[1]), len(weights)) + decay * weights / size
        g = np.exp(e[at + 1]) * right[at + 1]
        oo, ot, to, tt = np.exp(moves).ravel()
        pair = np.stack([np.full(len(at), oo), ot * g, to * left[at], tt * left[at] * g])
        step_moves = ((pair / pair.sum(axis=0)).sum(axis=1).reshape(2, 2) - seen) / size
        squares += step ** 2
        square_bias += gap.sum() ** 2
        square_moves += step_moves ** 2
        weights = weights - rate * step / np.sqrt(squares)
        bias -= rate * gap.sum() / np.sqrt(square_bias)
        moves = moves - rate * step_moves / np.sqrt(square_moves)
    return Crf(weights.astype(np.float32), float(bias), moves)


@dataclass(frozen=True)
class ToxicModel:
    crf: Crf
    scale: np.ndarray  # logistic weights of summary()


def summary(marginal: np.ndarray, row: np.ndarray, count: int) -> np.ndarray:
    """Per row: log-odds of the likeliest word, log of the expected number, their density."""
    top = np.zeros(count)
    np.maximum.at(top, row, marginal)
    total = np.bincount(row, marginal, count)
    size = np.maximum(np.bincount(row, minlength=count), 1)
    top = np.clip(top, 1e-9, 1 - 1e-9)
    return np.stack([np.ones(count), np.log(top / (1 - top)) / 5, np.log1p(total),
                     total / size, np.log(size) / 5], axis=1)


def _tagged(column: pa.Array, crf: Crf) -> Iterator[tuple[int, np.ndarray, np.ndarray, Tokens, np.ndarray]]:
    """Piece by piece: first row, bytes, offsets, words and marginals."""
    data, offsets = text_bytes(column)
    for a, b in pieces(offsets):
        part, bounds = data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
        tokens = tokenize(part, bounds)
        emission = crf.emissions(feature_cells(tokens))
        yield a, part, bounds, tokens, forward_backward(emission, tokens.sentence, crf.moves)[2]


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id",
        toxic: str = "toxic", use: Column | None = None) -> ToxicModel:
    """Train on labelled documents; ``use`` limits the label rows (default: all).

    Up to MAX_TOXIC_DOCS toxic and MAX_CLEAN_DOCS clean documents are taken by a hash
    of their id and read whole. Rows with a null id or label are left out. Without toxic
    labels all scores are low.
    """
    spark = session_of(docs)
    marked = labels.where(F.col(doc_id).isNotNull() & F.col(toxic).isNotNull())
    if use is not None:
        marked = marked.where(use)
    marked = marked.select(F.col(doc_id).alias("__id"), (F.col(toxic) > 0).cast("int").alias("toxic"))
    counts = {r["toxic"]: r["n"] for r in marked.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    key = F.xxhash64("__id", F.lit(5))
    bounds = {1: MAX_TOXIC_DOCS, 0: MAX_CLEAN_DOCS}
    picked = None
    for label, most in bounds.items():
        part = marked.where(F.col("toxic") == label).orderBy(key, "__id").limit(most)
        picked = part if picked is None else picked.unionAll(part)
    # The bounds above cap the rows that are sent.
    sample = keep(
        docs.select(F.col(doc_id).alias("__doc"), as_bytes(text).alias("text"))
        .join(F.broadcast(picked), F.col("__doc") == F.col("__id")).select("toxic", "text"), "toxic-sample")

    lexicon = _lexicon(sample, {k: min(v, bounds[k]) for k, v in counts.items()})
    cells, label, sentence = _sentences(sample, lexicon)
    crf = train_crf(cells, label, sentence)
    sent = spark.sparkContext.broadcast(crf)

    def describe(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for a, _, bounds_, tokens, marginal in _tagged(batch.column(1), sent.value):
                rows = len(bounds_) - 1
                x = summary(marginal, tokens.row, rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, rows), *map(pa.array, x.T[1:])],
                    ["toxic", "a", "b", "c", "d"])

    rows = sample.mapInArrow(describe, "toxic int, a double, b double, c double, d double").collect()
    rows.sort()
    table = np.array([tuple(r) for r in rows], float).reshape(-1, 5)
    y, x = table[:, 0], np.column_stack([np.ones(len(table)), table[:, 1:]])
    weight = np.array([counts.get(int(v), 0) / max(1, (y == v).sum()) for v in y])
    return ToxicModel(crf, _logistic(x, y, weight))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1.0) -> np.ndarray:
    """Weighted logistic regression by Newton steps; constant if only one class is seen."""
    beta = np.zeros(5)
    if not len(y) or y.min() == y.max():
        beta[0] = 10.0 if len(y) and y.min() == 1 else -10.0
        return beta
    keep_ = penalty * np.diag([1e-3, 1, 1, 1, 1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weight * (p - y)) + keep_ @ beta
        curve = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + keep_
        step = np.linalg.solve(curve, slope)
        beta = beta - step / max(1.0, np.abs(step).max() / 4)
    return beta


def _keys(tokens: Tokens) -> list[np.ndarray]:
    """What a lexicon entry may be: a whole word, or its first five or four letters."""
    return [tokens.word, tokens.parts[2], tokens.parts[1]]


def _lexicon(sample: DataFrame, sizes: dict[int, int]) -> np.ndarray:
    """Hashes of all toxic words and word beginnings of the sample, sorted."""
    def keys_of(source: Iterator[pa.RecordBatch], wanted: int,
                only: Broadcast | None) -> Iterator[pa.RecordBatch]:
        for batch in source:
            batch = batch.filter(pc.equal(batch.column(0), wanted))
            data, offsets = text_bytes(batch.column(1))
            for a, b in pieces(offsets):
                tokens = tokenize(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                before = np.concatenate([[np.uint64(0)], tokens.word[:-1]]) if len(tokens.word) else tokens.word
                for key in _keys(tokens):
                    # A word of copied passages has one left neighbour in all of them.
                    context = (mix(before ^ np.uint64(9)) >> np.uint64(40)).astype(np.int64)
                    row = tokens.row
                    if only is not None:
                        hit = in_bitmap(only.value, key)
                        key, context, row = key[hit], context[hit], row[hit]
                    pair = mix(key ^ mix(row.astype(np.uint64)))
                    _, first = np.unique(pair, return_index=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key[first].view(np.int64)), pa.array(context[first])],
                        ["key", "context"])

    spark = sample.sparkSession
    shape = "key long, context long"
    toxic = keep(
        sample.mapInArrow(lambda s: keys_of(s, 1, None), shape).groupBy("key", "context").count()
        .groupBy("key").agg(F.count("*").alias("contexts"), F.sum("count").alias("docs"))
        .where(F.col("contexts") >= MIN_TOXIC_DOCS).select("key", "docs"), "toxic-keys")
    # A bitmap of all candidates only spares clean keys the shuffle; the join decides.
    sent = spark.sparkContext.broadcast(key_bitmap(toxic.select("key")))
    clean = sample.mapInArrow(lambda s: keys_of(s, 0, sent), shape).groupBy("key").agg(F.count("*").alias("n"))
    n_toxic, n_clean = max(1, sizes.get(1, 0)), max(1, sizes.get(0, 0))
    odds = F.col("docs") + 0.5, F.coalesce("n", F.lit(0)) + 0.5
    found = toxic.join(clean, "key", "left").where(
        odds[0] / n_toxic >= MIN_ODDS * odds[1] / n_clean).select("key").collect()
    return np.sort(np.array([r["key"] for r in found], np.int64).view(np.uint64))


def _sentences(sample: DataFrame, lexicon: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, word labels and sentence bounds of at most MAX_SENTENCES sentences per class.

    From toxic documents those with a toxic word, from clean ones any; by a hash.
    """
    sent = sample.sparkSession.sparkContext.broadcast(lexicon)

    def cut(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            flags = batch.column(0).to_numpy(zero_copy_only=False)
            data, offsets = text_bytes(batch.column(1))
            for a, b in pieces(offsets):
                tokens = tokenize(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                if not len(tokens.word):
                    continue
                label = np.zeros(len(tokens.word), np.int8)
                for key in _keys(tokens):
                    label |= np.isin(key, sent.value)
                label &= flags[a + tokens.row].astype(np.int8)
                first = tokens.sentence[:-1]
                toxic = np.maximum.reduceat(label, first) > 0
                lot = mix(np.add.reduceat(tokens.word, first))
                # Clean sentences abound: one in sixteen is offered.
                pick = np.flatnonzero(toxic | ((flags[a + tokens.row[first]] == 0) & (lot % np.uint64(16) == 0)))
                cells = feature_cells(tokens)
                spans = [slice(tokens.sentence[k], tokens.sentence[k + 1]) for k in pick]
                yield pa.RecordBatch.from_arrays([
                    pa.array(toxic[pick]), pa.array(lot[pick].view(np.int64)),
                    pa.array([cells[s].tobytes() for s in spans], pa.binary()),
                    pa.array([label[s].tobytes() for s in spans], pa.binary())],
                    ["toxic", "lot", "cells", "label"])

    offered = sample.mapInArrow(cut, "toxic boolean, lot long, cells binary, label binary")
    offered = offered.dropDuplicates(["toxic", "lot"])
    rows = []
    for toxic in (True, False):
        rows += offered.where(F.col("toxic") == toxic).orderBy("lot").limit(MAX_SENTENCES).collect()
    width = 8
    cells = [np.frombuffer(r["cells"], np.int32).reshape(-1, width) for r in rows]
    label = [np.frombuffer(r["label"], np.int8) for r in rows]
    sentence = np.cumsum([0] + [len(x) for x in label])
    if not rows:
        return np.zeros((0, width), np.int32), np.zeros(0, np.int8), sentence
    return np.concatenate(cells), np.concatenate(label), sentence


def tag(docs: DataFrame, model: ToxicModel, text: str = "text", spans: bool = True) -> DataFrame:
    """The frame with ``score`` and, unless left out, ``spans`` (replaced where they exist).

    ``spans`` are the words more likely toxic than not, as start and end in characters
    of the whole text. Null and empty texts are scored as texts without words.
    """
    spark = session_of(docs)
    sent = spark.sparkContext.broadcast(model)
    kind = "array<struct<start: long, end: long>>"

    @F.pandas_udf(f"score double, spans {kind}" if spans else "score double")
    def run(column: pd.Series) -> pd.DataFrame:
        scores = np.zeros(len(column))
        found: list = []
        for a, data, bounds, tokens, marginal in _tagged(pa.array(column, pa.binary()), sent.value.crf):
            rows = len(bounds) - 1
            x = summary(marginal, tokens.row, rows)
            scores[a:a + rows] = 1 / (1 + np.exp(-np.clip(x @ sent.value.scale, -30, 30)))
            if spans:
                points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                mine: list = [[] for _ in range(rows)]
                for k in np.flatnonzero(marginal >= 0.5):
                    r = tokens.row[k]
                    base = points[bounds[r]]
                    mine[r].append({"start": int(points[tokens.start[k]] - base),
                                    "end": int(points[tokens.end[k]] - base)})
                found += mine
        return pd.DataFrame({"score": scores, "spans": found} if spans else {"score": scores})

    out = docs.withColumn("__toxicity", run.asNondeterministic()(as_bytes(text)))
    names = ["score", "spans"] if spans else ["score"]
    return out.withColumns({n: F.col(f"__toxicity.{n}") for n in names}).drop("__toxicity")


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted and spans; a quarter of the labels is held out."""
    model = fit(docs, labels, use=fold() != 2)
    return tag(docs.select("doc_id", "text"), model).select(
        "doc_id", (fold() == 2).alias("held_out"), "score",
        (F.col("score") >= PREDICT_AT).cast("int").alias("predicted"), "spans")

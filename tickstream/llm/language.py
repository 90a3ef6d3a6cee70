"""Language identification: multinomial naive Bayes over hashed character n-grams.

The model is a matrix of log-probabilities (hash cell x language) of fixed height.
It is fitted on at most ``max_docs`` labelled rows picked by a hash of their id, equal
numbers of each language, with priors from all labelled rows. It is broadcast and
applied to whole texts in numpy: a row's score is the sum of the matrix rows its
n-grams hash to.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickstream.llm.frames import as_bytes, fold, session_of

CELL_BITS = 16
GRAMS = (1, 2, 3)
MAX_DOCS = 40_000
SMOOTHING = 0.5
# A language's share of the rows is taken in steps of one in this many.
LOTS = 1 << 40
UNKNOWN = "und"
# Characters handled at once. A longer text goes on in the next slice, grams across the cut included.
SLICE_CHARS = 1 << 18
_SPACE = 32


@functools.cache
def _letters() -> np.ndarray:
    """For every code point its lower-case code point, or 0 where it is no letter."""
    out = np.zeros(0x110000, np.uint32)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            low = char.lower()
            out[code] = ord(low) if len(low) == 1 else code
    return out


def _slices(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """Code points of some texts joined, and the row of each; rows ascend.

    The last value says that the first row goes on from the slice before.
    """
    chars, rows, held, goes_on = [], [], 0, False
    for row, raw in enumerate(texts):
        points = np.frombuffer(raw.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
        for at in range(0, len(points), SLICE_CHARS):
            part = points[at:at + SLICE_CHARS]
            if at:
                goes_on = goes_on or not chars
            else:
                part = np.concatenate([np.array([_SPACE], np.uint32), part])
            chars.append(part)
            rows.append(np.full(len(part), row, np.int32))
            held += len(part)
            if held >= SLICE_CHARS:
                yield np.concatenate(chars), np.concatenate(rows), goes_on
                chars, rows, held, goes_on = [], [], 0, False
    if chars:
        yield np.concatenate(chars), np.concatenate(rows), goes_on


def grams(texts: list[bytes], bits: int = CELL_BITS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hash cells of all character n-grams with their rows, slice by slice."""
    reach = max(GRAMS) - 1
    last_codes, last_letters = np.zeros(0, np.uint32), np.zeros(0, bool)
    for chars, rows, goes_on in _slices(texts):
        low = _letters()[chars]
        letter = low > 0
        codes = np.where(letter, low, np.uint32(_SPACE))
        use = letter.copy()  # one blank stands for each run of other characters
        use[1:] |= ~letter[1:] & letter[:-1]
        use[0] = letter[0] or not goes_on or bool(last_letters[-1])
        use[1:] |= rows[1:] != rows[:-1]
        codes, owner, letter = codes[use], rows[use], letter[use]
        # Codes of the slice before come in front; grams within them were counted there.
        seen = len(last_codes) if goes_on else 0
        if seen:
            codes, letter = np.concatenate([last_codes, codes]), np.concatenate([last_letters, letter])
            owner = np.concatenate([np.full(seen, rows[0], np.int32), owner])
        cells, owners = [], []
        for size in GRAMS:
            count = len(codes) - size + 1
            if count <= 0:
                continue
            value = np.full(count, 0x27D4EB2F * size & 0xFFFFFFFF, np.uint32)
            for k, factor in zip(range(size), (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)):
                value += codes[k:k + count] * np.uint32(factor)
            value ^= value >> np.uint32(15)
            value *= np.uint32(0x2C1B3C6D)
            value ^= value >> np.uint32(13)
            inside = owner[:count] == owner[size - 1:]
            inside[:max(0, seen - size + 1)] = False
            if size == 1:
                inside &= letter
            cells.append((value >> np.uint32(32 - bits))[inside])
            owners.append(owner[:count][inside])
        mine = np.flatnonzero(owner == rows[-1])[-reach:]
        last_codes, last_letters = codes[mine], letter[mine]
        yield np.concatenate(cells), np.concatenate(owners)


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    weights: np.ndarray  # float32, cells x languages
    prior: np.ndarray


def shares(sizes: dict[str, int], most: int) -> dict[str, float]:
    """Which share of each language's rows is taken: all of rare ones, equal numbers of the others."""
    out, left = {}, most
    for k, name in enumerate(sorted(sizes, key=lambda n: (sizes[n], n))):
        part = min(sizes[name], left / (len(sizes) - k))
        out[name] = part / sizes[name]
        left -= part
    return out


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id",
        use: Column | None = None, max_docs: int = MAX_DOCS) -> LanguageModel:
    """Learn from rows with a language; ``use`` limits them (default: all).

    At most about ``max_docs`` rows are read whole, taken by a hash of the id so that
    the choice does not depend on order or partitions. Languages have equal parts of them;
    what a rare one leaves over goes to the others. Priors count all rows. Rows with null
    text carry no grams. Without any labelled row the model knows no language.
    """
    spark = session_of(docs)
    rows = docs.where(F.col(lang).isNotNull())
    if use is not None:
        rows = rows.where(use)
    rows = rows.select(F.col(lang).cast("string").alias("__lang"), F.xxhash64(doc_id).alias("__lot"),
                       as_bytes(text).alias("__text"))
    sizes = {r["__lang"]: r["n"] for r in rows.groupBy("__lang").agg(F.count("*").alias("n")).collect()}
    bounds = spark.createDataFrame(
        [(k, int(v * LOTS)) for k, v in shares(sizes, max_docs).items()], "__name string, __bound long")
    picked = rows.join(F.broadcast(bounds), F.col("__lang") == F.col("__name")).where(
        F.pmod("__lot", F.lit(LOTS)) < F.col("__bound"))
    shape = "lang string, docs long, counts binary"

    def count(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, list] = {}
        for batch in source:
            langs = pd.Categorical(batch.column(0).to_pylist())
            for code, name in enumerate(langs.categories):
                at = np.flatnonzero(langs.codes == code)
                state = seen.setdefault(name, [0, np.zeros(1 << CELL_BITS, np.int64)])
                state[0] += len(at)
                for cells, _ in grams([batch.column(1)[int(i)].as_py() for i in at]):
                    state[1] += np.bincount(cells, minlength=1 << CELL_BITS)
        yield from _count_rows(seen)

    def add(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, list] = {}
        for batch in source:
            for row in batch.to_pylist():
                state = seen.setdefault(row["lang"], [0, np.zeros(1 << CELL_BITS, np.int64)])
                state[0] += row["docs"]
                state[1] += np.frombuffer(row["counts"], np.int64)
        yield from _count_rows(seen)

    counts = picked.select("__lang", "__text").mapInArrow(count, shape)
    # Counts of a language meet in two steps, so no task gathers those of all tasks.
    counts = counts.withColumn("part", F.spark_partition_id() % 64)
    counts = counts.repartition("lang", "part").select("lang", "docs", "counts").mapInArrow(add, shape)
    found = sorted(counts.repartition("lang").mapInArrow(add, shape).collect(), key=lambda r: r["lang"])
    if not found:
        return LanguageModel([], np.zeros((1 << CELL_BITS, 0), np.float32), np.zeros(0))
    table = np.stack([np.frombuffer(r["counts"], np.int64) for r in found], axis=1).astype(float)
    table += SMOOTHING
    weights = np.log(table / table.sum(axis=0))
    docs_seen = np.array([sizes[r["lang"]] for r in found], float)
    return LanguageModel([r["lang"] for r in found], weights.astype(np.float32),
                         np.log(docs_seen / docs_seen.sum()))


def _count_rows(seen: dict[str, list]) -> Iterator[pa.RecordBatch]:
    if seen:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.string()), pa.array([v[0] for v in seen.values()], pa.int64()),
             pa.array([v[1].tobytes() for v in seen.values()], pa.binary())],
            ["lang", "docs", "counts"])


def score_texts(texts: list[bytes], model: LanguageModel) -> tuple[list[str], np.ndarray]:
    """Predicted language and its posterior probability for each text."""
    totals = np.tile(model.prior, (len(texts), 1))
    known = np.zeros(len(texts), bool)
    for cells, rows in grams(texts):
        if not len(rows):
            continue
        order = np.argsort(rows, kind="stable")
        rows = rows[order]
        starts = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
        known[rows[starts]] = True
        if model.languages:
            totals[rows[starts]] += np.add.reduceat(
                model.weights[cells[order]], starts, axis=0, dtype=np.float64)
    if not model.languages:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    best = totals.argmax(axis=1)
    share = 1.0 / np.exp(totals - totals.max(axis=1, keepdims=True)).sum(axis=1)
    names = [model.languages[b] if k else UNKNOWN for b, k in zip(best, known)]
    return names, np.where(known, share, 0.0)


def identify(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """The frame with ``lang_pred`` and ``score`` (replaced where they exist).

    Null texts and texts without a letter get ``und`` and 0. Ties go to the language
    whose name sorts first. Other columns, whatever their names, stay as they are.
    """
    spark = session_of(docs)
    sent = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(column: pd.Series) -> pd.DataFrame:
        names, scores = score_texts(list(column), sent.value)
        return pd.DataFrame({"lang_pred": names, "score": scores})

    judged = docs.withColumn("__language", predict.asNondeterministic()(as_bytes(text)))
    return judged.withColumns({
        "lang_pred": F.col("__language.lang_pred"), "score": F.col("__language.score"),
    }).drop("__language")


def language_report(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of all documents; a quarter is held out of the fit."""
    model = fit(docs, use=fold() != 2)
    return identify(docs, model).select(
        "doc_id", (fold() == 2).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, min_score: float = 0.5) -> DataFrame:
    """Pipeline stage: documents in a known language; the others are rejected.

    Rejected are null texts, texts without letters, and texts whose best language has
    a posterior below ``min_score``.
    """
    judged = identify(docs, fit(docs), text="text")
    return judged.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score)).select(
        *docs.columns)

"""Turning articles into vectors."""

from __future__ import annotations

import functools
import hashlib
import re
from collections import Counter
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickstream.constants import EMBED_BATCH
from tickstream.functions.text import body_without_tail, compose_text
from tickstream.functions.vectors import l2_normalise
from tickstream.operators.dedup import one_per_key
from tickstream.session import ship_package
from tickstream.sources.tables import stored

# An embedding model: texts in, one vector per text out, in the same order.
Embedder = Callable[[Sequence[str]], Sequence[Sequence[float]]]

METADATA = ("title", "url", "source_name", "published_at", "text")

# Runs of letters and digits, Latin script with accents included.
TOKEN = re.compile("[0-9A-Za-zÀ-ɏ]+")


@functools.lru_cache(maxsize=1 << 17)
def _slot(token: str) -> tuple[int, int]:
    digest = hashlib.md5(token.encode("utf-8")).hexdigest()
    return int(digest[:8], 16), 1 if int(digest[8], 16) < 8 else -1


def hash_embedder(dim: int = 64) -> Embedder:
    """Offline embedder: signed counts of hashed tokens."""

    def embed(texts: Sequence[str]) -> list[list[float]]:
        out = []
        for text in texts:
            vector = [0.0] * dim
            for token, count in Counter(TOKEN.findall(text.lower())).items():
                number, sign = _slot(token)
                vector[number % dim] += sign * count
            out.append(vector)
        return out

    return embed


def hashed_vectors(text: Column, dim: int = 64) -> Column:
    """What ``hash_embedder`` gives, with words found and hashed in the JVM.

    Python only adds up the signs of all texts of an Arrow batch in one operation.
    """
    ship_package(SparkSession.active())
    tokens = F.regexp_extract_all(F.lower(text), F.lit(f"({TOKEN.pattern})"))
    digests = F.transform(tokens, lambda t: F.conv(F.substring(F.md5(t.cast("binary")), 1, 9), 16, 10).cast("long"))
    # The last of nine digits is the sign, those before it the place.
    codes = F.transform(digests, lambda d: (
        F.pmod(F.shiftright(d, 4), F.lit(dim)) * 2 + (d.bitwiseAND(F.lit(15)) >= 8).cast("long")).cast("int"))

    @F.pandas_udf("array<double>")
    def add(column: pd.Series) -> pd.Series:
        sizes = np.fromiter((0 if c is None else len(c) for c in column), np.int64, len(column))
        flat = np.concatenate([np.zeros(0, np.int64), *[c for c in column if c is not None]]).astype(np.int64)
        place = np.repeat(np.arange(len(sizes)), sizes) * dim + flat // 2
        sums = np.bincount(place, 1.0 - 2.0 * (flat % 2), len(sizes) * dim)
        return pd.Series(list(sums.reshape(len(sizes), dim)), index=column.index, dtype=object)

    return add.asNondeterministic()(codes)


def embed_texts(text: Column, make_embedder: Callable[[], Embedder],
                batch: int = EMBED_BATCH) -> Column:
    """Vectors of a text column, through a model called on ``batch`` texts at a time.

    The built-in ``hash_embedder`` needs no calls and goes through ``hashed_vectors``.
    ``make_embedder runs once per task, which is where a service client or a
    model file is opened. The call is marked as not repeatable, or else Spark would
    run it a second time for any filter on the vectors.
    """
    if make_embedder is hash_embedder:
        return hashed_vectors(text)
    ship_package(SparkSession.active())

    @F.pandas_udf("array<double>")
    def call(chunks: Iterator[pd.Series]) -> Iterator[pd.Series]:
        embed = make_embedder()
        for chunk in chunks:
            texts = chunk.tolist()
            vectors: list = []
            for start in range(0, len(texts), batch):
                part = texts[start:start + batch]
                found = embed(part)
                if len(found) != len(part):
                    raise ValueError(f"{len(part)} texts gave {len(found)} vectors")
                vectors.extend(np.asarray(v, dtype=np.float64) for v in found)
            yield pd.Series(vectors, index=chunk.index, dtype=object)

    return call.asNondeterministic()(text)


def article_texts(news: DataFrame, *keep: str) -> DataFrame:
    """Articles with their embedding text; those without any part are left out.

    A part carries its label, so a text is blank only when it has no part at all.
    """
    title, description, content = F.col("title"), F.col("description"), F.col("content")
    any_part = (title != "") | (description != "") | (body_without_tail(content) != "")
    return news.filter(any_part).select(
        *keep,
        "title",
        "url",
        "source_name",
        "published_at",
        compose_text(title, description, content).alias("text"),
    )


def message_id() -> Column:
    """A row number that is unique per message: topic partition, then offset.

    Partitions from 2**19 on and offsets from 2**44 on do not fit and are an error.
    """
    partition, offset = F.col("kafka_partition").cast("long"), F.col("kafka_offset")
    fits = partition.between(0, (1 << 19) - 1) & offset.between(0, (1 << 44) - 1)
    number = F.shiftleft(partition, 44).bitwiseOR(offset)
    missing = partition.isNull() | offset.isNull()
    return F.when(fits | missing, number).otherwise(
        F.raise_error(F.format_string("no message id for partition %s, offset %s",
                                      partition, offset)).cast("long"))


def build_vectors(news: DataFrame, make_embedder: Callable[[], Embedder] = hash_embedder,
                  vec_id: Column | None = None, batch: int = EMBED_BATCH) -> DataFrame:
    """The vector table: unit vectors beside the article they stand for."""
    number = message_id() if vec_id is None else vec_id
    texts = article_texts(news.withColumn("vec_id", number), "vec_id")
    return texts.withColumn("_raw", embed_texts(F.col("text"), make_embedder, batch)).select(
        "vec_id",
        l2_normalise(F.col("_raw")).cast("array<float>").alias("embedding"),
        *METADATA,
    )


def refresh_vectors(news: DataFrame, vectors: DataFrame, make_embedder: Callable[[], Embedder] = hash_embedder,
                    batch: int = EMBED_BATCH) -> DataFrame:
    """``build_vectors``, with the vectors of texts that were embedded before.

    ``vectors`` is a table the same model built. The model is called once for each text that has
    no vector there, however often the text occurs. Texts are told apart by 128 bits of hash.
    """
    texts = article_texts(news.withColumn("vec_id", message_id()), "vec_id").select("*", *_digest())
    known = one_per_key(vectors.filter(F.col("embedding").isNotNull()).select("vec_id", "embedding", *_digest()),
                        ["d1", "d2"], ["vec_id"]).select("d1", "d2", "embedding")
    fresh = one_per_key(texts.join(known, ["d1", "d2"], "left_anti"), ["d1", "d2"], ["vec_id"])
    # Stored, or the model would be called again for each use.
    called = stored(fresh.select("d1", "d2", "text").withColumn(
        "_raw", embed_texts(F.col("text"), make_embedder, batch)).select(
        "d1", "d2", l2_normalise(F.col("_raw")).cast("array<float>").alias("embedding")), "embedded")
    return texts.join(known.unionByName(called), ["d1", "d2"]).select("vec_id", "embedding", *METADATA)


def _digest() -> list[Column]:
    return [F.xxhash64(F.lit(seed), "text").alias(f"d{seed}") for seed in (1, 2)]


def index_stats(vectors: DataFrame, titles: int) -> DataFrame:
    """Number of vectors, their dimension and the first titles by id, in one row."""
    counts = vectors.agg(
        F.count("*").alias("articles_indexed"),
        F.max(F.size("embedding")).alias("embedding_dim"),
    )
    first = (
        vectors.select("vec_id", "title").orderBy("vec_id").limit(titles)
        .agg(F.sort_array(F.collect_list(F.struct("vec_id", "title"))).alias("_first"))
        .select(F.col("_first.title").alias("sample_titles"))
    )
    # Two rows, each with the columns the other lacks.
    return counts.unionByName(first, allowMissingColumns=True).agg(
        F.max("articles_indexed").alias("articles_indexed"),
        F.max("embedding_dim").alias("embedding_dim"),
        F.max("sample_titles").alias("sample_titles"),
    )

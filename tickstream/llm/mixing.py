"""Mixing sources to target weights by Poisson replication.

Each source's repetition rate is its target share of the corpus over its real share,
in bytes of text. A document's number of copies is a Poisson variable with that mean,
found by inverting the distribution at a uniform number hashed from seed and id. The
copies are dealt out and ordered by a second hash, which shuffles them globally. All
of it is DataFrame work; per source only one row of totals exists.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickstream.llm.frames import keep

# Fixed target shares of the registered query and the pipeline; sources that are not
# named share the rest in proportion to their size.
TARGETS = {"src0": 0.2, "src1": 0.1, "src2": 0.05}
SEED = 7
# One row of rates per source; above this many, rates are joined by a shuffle.
MAX_SENT_SOURCES = 10_000


def uniform(doc_id: str, seed: int, part: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of an md5 of seed, part and id; null id: empty."""
    key = F.concat(F.lit(f"{seed}."), part.cast("string"), F.lit(":"),
                   F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 13), 16, 10).cast("double") / float(1 << 52)


def source_rates(docs: DataFrame, targets: dict[str, float], epochs: float = 1.0,
                 text: str = "text", source: str = "source") -> DataFrame:
    """One row per source: its bytes and its repetition rate.

    ``epochs`` is the size of the mix in corpora. Named sources that have no bytes
    leave their share unused. With all named and none other, shares apply as given.
    """
    if any(w < 0 for w in targets.values()) or sum(targets.values()) > 1 + 1e-9:
        raise ValueError("target shares must not be negative nor sum to more than 1")
    sizes = docs.groupBy(F.col(source).alias("source")).agg(
        F.sum(F.coalesce(F.octet_length(text), F.lit(0)).cast("long")).alias("bytes"))
    # One row a source, used three times: for the totals, the rates and their number.
    sizes = keep(sizes, "source-sizes")
    named = F.col("source").isin(list(targets)) if targets else F.lit(False)
    named = F.coalesce(named, F.lit(False))
    totals = sizes.agg(F.sum("bytes").alias("total"),
                       F.sum(F.when(~named, F.col("bytes")).otherwise(0)).alias("others"))
    row = totals.first()
    total, others = float(row["total"] or 0), float(row["others"] or 0)
    free = 1.0 - math.fsum(targets.values())
    share = F.lit(0.0)
    for name, weight in targets.items():
        share = F.when(F.col("source") == name, F.lit(weight)).otherwise(share)
    other_rate = epochs * free * total / others if others else 0.0
    rate = F.when(F.col("bytes") <= 0, F.lit(epochs)).when(
        named, share * F.lit(epochs * total) / F.col("bytes")).otherwise(F.lit(other_rate))
    return sizes.withColumn("rate", rate)


# Larger means are summed from parts of at most this mean, below where exp() underflows.
PART_MEAN = 256


def parts(rate: Column) -> Column:
    return F.greatest(F.ceil(rate / PART_MEAN), F.lit(1)).cast("int")


def poisson_count(doc_id: str, seed: int, steps: Column, count: Column) -> Column:
    """Per part, the number of cumulative probabilities at or below u: the inverse distribution."""
    def one(part: Column) -> Column:
        u = uniform(doc_id, seed, part)
        return F.size(F.filter(steps, lambda c: c <= u))
    return F.aggregate(F.sequence(F.lit(0), count - 1), F.lit(0), lambda acc, k: acc + one(k))


def cumulative(rate: Column) -> Column:
    """Cumulative Poisson probabilities of 0, 1, 2, ... up to ten deviations above the mean."""
    last = (F.ceil(rate + 10 * F.sqrt(rate)) + 10).cast("int")
    start = F.struct(F.exp(-rate).alias("p"), F.array(F.exp(-rate)).alias("all"))
    return F.aggregate(
        F.sequence(F.lit(1), last), start,
        lambda acc, k: F.struct(
            (acc["p"] * rate / k).alias("p"),
            F.concat(acc["all"], F.array(F.element_at(acc["all"], -1) + acc["p"] * rate / k)).alias("all")),
        lambda acc: acc["all"])


def mix(docs: DataFrame, targets: dict[str, float] = TARGETS, epochs: float = 1.0,
        seed: int = SEED, text: str = "text", source: str = "source", doc_id: str = "doc_id",
        copy: str | None = "copy") -> DataFrame:
    """The documents, each repeated by its Poisson count, in a global random order.

    ``copy`` names the column with the copy's number from 0 (None: left out; an
    existing column of that name is replaced). Rows with equal ids get equal counts.
    A null source is a source like others; null or empty texts weigh nothing, and a
    source without any bytes is repeated ``epochs`` times on average. Other columns
    stay. An empty table stays empty.
    """
    rates = source_rates(docs, targets, epochs, text, source).select(
        F.col("source").alias("__source"), parts(F.col("rate")).alias("__parts"),
        cumulative(F.col("rate") / parts(F.col("rate"))).alias("__steps"))
    if rates.limit(MAX_SENT_SOURCES + 1).count() <= MAX_SENT_SOURCES:
        rates = F.broadcast(rates)
    body = docs.drop(copy) if copy else docs
    joined = body.join(rates, F.col(source).eqNullSafe(F.col("__source")))
    number = copy or "__copy"
    copies = (
        joined.withColumn("__n", poisson_count(doc_id, seed, F.col("__steps"), F.col("__parts")))
        .where("__n > 0")
        .withColumn(number, F.explode(F.sequence(F.lit(0).cast("long"), F.col("__n") - F.lit(1).cast("long"))))
    )
    order = F.xxhash64(F.lit(seed), F.col(doc_id), F.col(number))
    dealt = copies.withColumn("__order", order).drop("__source", "__parts", "__steps", "__n")
    dealt = dealt.repartition("__order").sortWithinPartitions("__order").drop("__order")
    return dealt if copy else dealt.drop("__copy")


MIX_SQL = """
WITH sizes AS (
  SELECT source, sum(coalesce(strlen(text), 0)) AS bytes FROM documents GROUP BY source
), totals AS (
  SELECT sum(bytes)::DOUBLE AS total,
         sum(CASE WHEN source IN ('src0', 'src1', 'src2') THEN 0 ELSE bytes END)::DOUBLE AS others
  FROM sizes
), rates AS (
  SELECT source, CASE
    WHEN bytes <= 0 THEN 1.0::DOUBLE
    WHEN source = 'src0' THEN 0.2::DOUBLE * total / bytes
    WHEN source = 'src1' THEN 0.1::DOUBLE * total / bytes
    WHEN source = 'src2' THEN 0.05::DOUBLE * total / bytes
    ELSE 0.65::DOUBLE * total / others END AS rate
  FROM sizes, totals
), steps AS (
  SELECT source, k, sum(exp(k * ln(rate) - rate - lgamma(k + 1))) OVER
    (PARTITION BY source ORDER BY k) AS below
  FROM rates, range(0, 200) t(k)
), counted AS (
  SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars,
         ('0x' || substr(md5('7.0:' || coalesce(d.doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE
           / 4503599627370496 AS u
  FROM documents d
), copies AS (
  SELECT c.*, (SELECT count(*) FROM steps s
               WHERE s.source IS NOT DISTINCT FROM c.source AND s.below <= c.u) AS n
  FROM counted c
)
SELECT doc_id, text, lang, source, n_chars, unnest(range(0, n)) AS copy
FROM copies WHERE n > 0
"""

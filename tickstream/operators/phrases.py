"""Articles that hold all words of a phrase, for any number of phrases."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickstream.functions.text import words
from tickstream.operators.dedup import top_per_group
from tickstream.sources.tables import stored

# Phrases that are sent to every task at once, as their words in memory.
BLOCK_BYTES = 32 << 20
# A phrase's row besides its words.
ROW_BYTES = 200


def _vocabulary(text: Column) -> Column:
    return F.array_distinct(F.filter(words(text), lambda w: w != ""))


def phrase_anchors(articles: DataFrame, phrases: DataFrame, text: Column) -> DataFrame:
    """(anchor, phrase, wanted): the rarest word of every phrase, and all of its words.

    Only the words of phrases are counted in the articles. A phrase with a word that no
    article has, or without any word, cannot match and is left out.
    """
    wanted = stored(phrases.select("phrase").distinct().withColumn("wanted", _vocabulary(F.col("phrase"))), "phrases")
    parts = wanted.select("phrase", F.size("wanted").alias("n"), F.explode("wanted").alias("anchor"))
    counts = stored(
        articles.select(F.explode(_vocabulary(text)).alias("anchor"))
        .join(parts.select("anchor").distinct(), "anchor", "left_semi")
        .groupBy("anchor").agg(F.count("*").alias("articles")), "words")
    found = parts.join(counts, "anchor")
    whole = found.groupBy("phrase").agg(F.count("*").alias("there"), F.first("n").alias("n")).filter("there = n")
    rarest = top_per_group(found.join(whole.select("phrase"), "phrase", "left_semi"), ["phrase"],
                           [F.col("articles").asc(), F.col("anchor").asc()], 1, "_rank")
    return rarest.select("anchor", "phrase").join(wanted, "phrase").select("anchor", "phrase", "wanted")


def match_phrases(articles: DataFrame, phrases: DataFrame, text: Column,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The articles with a ``phrase`` column, one row for each phrase they hold all words of.

    ``text`` is searched; ``phrases`` has a column ``phrase``. An article meets only the
    phrases whose rarest word it has, instead of all of them, and of these the second word is
    looked up at once, further ones after it. Words and case are those of ``words``. Repeated
    phrases count once; an article without text matches nothing.

    Articles stay in the task that reads them, since their words would be moved once for each
    word. Phrases are sent there in blocks by their anchor, of about ``block_bytes`` each; the
    articles are read once for each block.
    """
    anchors = stored(phrase_anchors(articles, phrases, text), "anchors")
    size = anchors.agg(F.sum(2 * F.octet_length("phrase") + ROW_BYTES).alias("n")).first()["n"] or 0
    blocks = max(1, -(-size // block_bytes))
    rest = F.array_remove("wanted", F.col("anchor"))
    asked = anchors.select("anchor", "phrase", F.get(rest, F.lit(0)).alias("_second"),
                           F.slice(rest, 2, F.greatest(F.size(rest), F.lit(1))).alias("_others"))
    # The other columns stay in a struct, so that no name can clash.
    held = articles.select(F.struct("*").alias("_article"), _vocabulary(text).alias("_words"))
    matched = [_match_block(held, asked, block, blocks) for block in range(blocks)]
    return reduce(DataFrame.unionAll, matched).select("_article.*", "phrase")


def _match_block(held: DataFrame, asked: DataFrame, block: int, blocks: int) -> DataFrame:
    def own(word: Column) -> Column:
        return F.pmod(F.xxhash64(word), F.lit(blocks)) == block

    tokens, here = F.col("_words"), asked
    if blocks > 1:
        tokens, here = F.filter("_words", own), asked.filter(own(F.col("anchor")))
    met = held.select("_article", "_words", F.explode(tokens).alias("anchor")).join(F.broadcast(here), "anchor")
    second = F.col("_second").isNull() | F.array_contains("_words", F.col("_second"))
    others = (F.size("_others") == 0) | (F.size(F.array_except("_others", "_words")) == 0)
    return met.filter(second & others).select("_article", "phrase")

"""Line dedup: drop lines that many documents share, save in the last of them.

1. A text is split at line feeds. A line's key is the line without blanks at its ends,
   ASCII letters lower-cased. Keys of ``min_chars`` code points and more are exploded as
   128 bits of hash with the document and the position; texts stay where they are.
2. Per key the distinct documents are counted. (key, document) pairs are made distinct
   before a key's rows meet, so a line of every document is no single task's work.
3. Lines of keys with ``min_docs`` documents or more are dropped, but for those of the
   largest document id. A bitmap of the common keys keeps other lines from being moved.
4. A document gets the positions it loses and joins what lies between them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickstream.llm.frames import filter_by_bitmap, keep, key_bitmap, own_prefix, session_of

MIN_DOCS = 5
MIN_CHARS = 40
# The bytes stripped at both ends of a line, and the letters lower-cased.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_lines(text: str) -> Column:
    """The lines of a text; null and empty texts have one empty line."""
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n")


def line_keys(text: str) -> Column:
    """The keys of all lines in order."""
    folded = F.split(F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER), "\n")
    return F.transform(folded, lambda line: F.btrim(line, F.lit(BLANKS)))


def _row_key(doc_id: str, text: str) -> list[Column]:
    """128 bits of id and text: rows equal in both lose the same lines."""
    body = F.coalesce(F.col(text), F.lit(""))
    return [F.xxhash64(F.lit(k), F.col(doc_id), body).alias(f"r{k}") for k in (1, 2)]


def long_lines(docs: DataFrame, min_chars: int, text: str, doc_id: str) -> DataFrame:
    """One row per line whose key is long enough: (h1, h2, doc, r1, r2, pos), pos from 0."""
    # Hashed below the explode, or a text would be carried and hashed again for each line.
    keyed = docs.select(F.col(doc_id).alias("doc"), *_row_key(doc_id, text), line_keys(text).alias("keys"))
    lines = keyed.select("doc", "r1", "r2", F.posexplode("keys").alias("pos", "key"))
    return lines.where(F.char_length("key") >= min_chars).select(
        *[F.xxhash64(F.lit(k), F.col("key")).alias(f"h{k}") for k in (1, 2)], "doc", "r1", "r2", "pos")


def common_keys(lines: DataFrame, min_docs: int) -> DataFrame:
    """Keys of at least ``min_docs`` documents with the largest id: (h1, h2, last).

    All rows without an id count as one document, smaller than the others.
    """
    ids = lines.groupBy("h1", "h2").agg(
        F.count_distinct("doc").alias("ids"), F.max(F.col("doc").isNull().cast("int")).alias("nulls"),
        F.max("doc").alias("last"))
    return ids.where(F.col("ids") + F.col("nulls") >= min_docs).select("h1", "h2", "last")


def dropped_positions(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS,
                      text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(r1, r2, gone): the ascending positions of the lines that rows of this id and text lose."""
    session_of(docs)
    # Read twice: 44 bytes a line are stored, where texts would be split and keyed again.
    lines = keep(long_lines(docs, min_chars, text, doc_id), "lines")
    common = keep(common_keys(lines, min_docs), "common-lines")
    shared = filter_by_bitmap(lines, "h1", key_bitmap(common.select("h1"))).join(common, ["h1", "h2"])
    # A row has no more positions than lines.
    return shared.where(~F.col("doc").eqNullSafe(F.col("last"))).groupBy("r1", "r2").agg(
        F.sort_array(F.collect_set("pos")).alias("gone"))


def _without(lines: Column, gone: Column) -> Column:
    """The lines at all but the given ascending positions, joined again, in one pass."""
    before = F.transform(gone, lambda p, k: p - F.coalesce(F.get(gone, k - 1), F.lit(-1)) - 1)
    flags = F.flatten(F.transform(before, lambda n: F.concat(F.array_repeat(F.lit(False), n), F.array(F.lit(True)))))
    # Bound as a lambda's variable, the flags are computed once and not for every line.
    whole = F.transform(F.array(flags), lambda flag: F.array_join(
        F.filter(lines, lambda line, k: ~F.coalesce(F.get(flag, k), F.lit(False))), "\n"))
    return F.get(whole, 0)


def drop_common_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS,
                      text: str = "text", doc_id: str = "doc_id",
                      n_lines: str = "n_lines", n_dropped: str = "n_dropped") -> DataFrame:
    """The documents without their common lines, and how many lines they had and lost.

    A line is dropped if its key has ``min_chars`` code points or more and is found in
    ``min_docs`` documents or more, except in the largest of them, which keeps all its
    lines of that key. Other lines stay as they are, joined by line feeds. A null or empty
    text is one empty line and stays; a document that loses all its lines becomes an empty
    text. Repeats of a line in one document count once. Rows with equal ids are one
    document, also where their texts differ; rows without an id are one document below
    all others. Other columns stay; columns named as ``n_lines`` or ``n_dropped`` are
    replaced. An empty table stays empty.
    """
    base = docs.drop(*[c for c in (n_lines, n_dropped) if c not in (text, doc_id)])
    own = own_prefix(docs)
    gone = dropped_positions(docs, min_docs, min_chars, text, doc_id).select(
        F.col("r1").alias(f"{own}g1"), F.col("r2").alias(f"{own}g2"), F.col("gone").alias(own))
    one, two = _row_key(doc_id, text)
    joined = base.withColumns({f"{own}r1": one, f"{own}r2": two}).join(
        gone, (F.col(f"{own}r1") == F.col(f"{own}g1")) & (F.col(f"{own}r2") == F.col(f"{own}g2")), "left")
    hit = F.col(own).isNotNull()
    kept = F.when(hit, _without(split_lines(text), F.col(own))).otherwise(F.col(text))
    body = F.coalesce(F.col(text), F.lit(""))
    # One line more than line feeds; counted without splitting again.
    feeds = F.octet_length(body) - F.octet_length(F.replace(body, F.lit("\n"), F.lit("")))
    return joined.select(
        *[kept.alias(text) if c == text else F.col(f"`{c}`") for c in base.columns],
        (feeds + 1).cast("long").alias(n_lines),
        F.when(hit, F.size(own)).otherwise(0).cast("long").alias(n_dropped))


def line_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped and a digest of the text that stays."""
    cut = drop_common_lines(docs.select("doc_id", "text"))
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    return cut.select("doc_id", "n_lines", "n_dropped", digest.alias("kept_sha256"))


LINE_SQL = r"""
WITH lines AS (
  SELECT d.rowid AS r, d.doc_id, t.pos, t.line,
         trim(translate(t.line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l, row_number() OVER () AS rowid
        FROM documents) d,
       LATERAL (SELECT unnest(d.l) AS line, generate_subscripts(d.l, 1) AS pos) t
), common AS (
  SELECT key, max(doc_id) AS last FROM lines WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) + max((doc_id IS NULL)::INT) >= 5
), marked AS (
  SELECT lines.*, common.key IS NOT NULL AND lines.doc_id IS DISTINCT FROM common.last AS gone
  FROM lines LEFT JOIN common USING (key)
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r, doc_id
"""

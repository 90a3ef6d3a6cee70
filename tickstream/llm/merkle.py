"""Merkle dataset manifest by time-forward processing.

Every row is a leaf; per group, runs of consecutive nodes become their parent until one
node, the group's root, remains, and the groups' roots go on to one root likewise.

Nodes are labelled in the order in which they can be computed: level, then place. A node
sends its digest to its parent's label through a priority queue, and a node is computed
when its label is the least in the queue, since all its children's messages are there.
Outside a task the queue is Spark's sorted shuffle: rows are messages addressed to a block,
a whole subtree of ``LEVELS`` levels, and come in label order, spilled to disk as needed.
Inside a block it is a heap. Each round lifts all groups by ``LEVELS`` levels, so there are
few rounds, and no block has more than ``width ** LEVELS`` rows, however large a group is.

The reversed sweep goes through the same rounds from the root down. A block is sent what
its top has to show up to the root, once, and hands it on with the siblings on the way;
each leaf gets its whole proof.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickstream.llm.frames import keep, session_of
from tickstream.llm.line_dedup import LOWER, UPPER

WIDTH = 8
# A block has this many levels above its lowest one.
LEVELS = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(parts: Sequence[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field_text(value: Column) -> Column:
    """A value as its UTF-8 length, a colon and itself; null is a dash."""
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field_text(v) for v in values]).cast("binary"), 256)


def numbered(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """The rows with their place ``idx`` in their group from 0 and the group's ``size``.

    Rows are stored by ranges of group and order, which cuts large groups; a range's places
    follow from the counts of the ranges before it.
    """
    dealt = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    dealt = keep(dealt.select(
        "*", F.spark_partition_id().alias("range"), F.monotonically_increasing_id().alias("at")), "ranges")
    # One row per group and range.
    counts = dealt.groupBy(group, "range").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    every = Window.partitionBy(group)
    earlier = every.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        group, "range", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("n").over(every).alias("size"))
    return dealt.join(counts, [group, "range"]).withColumn("idx", F.col("at") + F.col("shift")).drop(
        "range", "at", "shift")


def sweep_up(first: int, digests: list[str], size: int, width: int,
             levels: int) -> tuple[str, int, dict[tuple[int, int], list[str]]]:
    """The top of a block, the number of nodes on its level, and each node's children in order of labels.

    ``first`` is the place of the block's first node among the ``size`` of its level.
    """
    sizes = [size]
    while sizes[-1] > 1 and len(sizes) <= levels:
        sizes.append(-(-sizes[-1] // width))
    top = len(sizes) - 1
    children: dict[tuple[int, int], list[str]] = {}
    if not top:
        return digests[0], size, children
    # Messages as parent's label, sender and digest; in order, so already a heap.
    queue = [(1, (first + k) // width, first + k, d) for k, d in enumerate(digests)]
    while True:
        level, place = queue[0][:2]
        sent = []
        while queue and queue[0][:2] == (level, place):
            sent.append(heapq.heappop(queue)[3])
        children[level, place] = sent
        node = digest(sent)
        if level == top:
            return node, sizes[top], children
        heapq.heappush(queue, (level + 1, place // width, place, node))


def sweep_down(children: dict[tuple[int, int], list[str]], width: int,
               suffix: tuple[str, list[int], list[int]]) -> dict[int, tuple[str, list[int], list[int]]]:
    """Proofs of a block's lowest nodes by place, from the proof of its top.

    Nodes are visited in descending order of labels: a node's own message is there before
    it sends to its children.
    """
    waiting = {}
    found = {}
    for level, place in reversed(children):
        proof, left, right = waiting.pop((level, place), suffix)
        run = children[level, place]
        for k in range(len(run)):
            message = ("".join(run[:k] + run[k + 1:]) + proof, [k, *left], [len(run) - 1 - k, *right])
            if level > 1:
                waiting[level - 1, place * width + k] = message
            else:
                found[place * width + k] = message
    return found


def _blocks(source: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[dict], pa.Schema]]:
    """Rows of one block after the other, and their types."""
    held, last, schema = [], None, None
    for batch in source:
        schema = batch.schema
        for row in batch.to_pylist():
            key = (row["g"], row["block"])
            if held and key != last:
                yield held, schema
                held = []
            last = key
            held.append(row)
    if held:
        yield held, schema


def _climb(nodes: DataFrame, width: int, levels: int) -> DataFrame:
    """The tops of all blocks: (g, idx, size, digest)."""
    names = ["g", "block", "idx", "size", "digest"]
    dealt = nodes.withColumn("block", F.floor(F.col("idx") / width ** levels)).select(*names)
    dealt = dealt.repartition("g", "block").sortWithinPartitions("g", "block", "idx")

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for rows, _ in _blocks(source):
            top, size, _ = sweep_up(rows[0]["idx"], [r["digest"] for r in rows], rows[0]["size"], width, levels)
            out.append({"g": rows[0]["g"], "idx": rows[0]["block"] if size > 1 else 0, "size": size, "digest": top})
        if out:
            yield pa.RecordBatch.from_pylist(out)

    return dealt.mapInArrow(run, "g string, idx long, size long, digest string")


def _descend(nodes: DataFrame, tops: DataFrame, width: int, levels: int) -> DataFrame:
    """The nodes with their proofs, from the proofs of their blocks' tops (g, idx, subroot, ...)."""
    extra = [c for c in nodes.columns if c not in ("g", "idx", "size", "digest")]
    proof = ["subroot", "proof", "left", "right"]
    below = nodes.withColumn("block", F.floor(F.col("idx") / width ** levels))
    # A block's top comes before its nodes.
    above = tops.select("g", F.col("idx").alias("block"), F.lit(-1).cast("long").alias("idx"), *proof)
    names = ["g", "block", "idx", "size", "digest", *extra, *proof]
    dealt = below.unionByName(above, allowMissingColumns=True).select(*names)
    dealt = dealt.repartition("g", "block").sortWithinPartitions("g", "block", "idx")
    kept = [c for c in names if c != "block"]
    shape = dealt.select(*kept).schema

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, schema in _blocks(source):
            top, rows = rows[0], rows[1:]
            suffix = (top["proof"], top["left"], top["right"])
            _, _, children = sweep_up(rows[0]["idx"], [r["digest"] for r in rows], rows[0]["size"], width, levels)
            proofs = sweep_down(children, width, suffix)
            for row in rows:
                row.pop("block")
                row["subroot"] = top["subroot"]
                row["proof"], row["left"], row["right"] = proofs.get(row["idx"], suffix)
            yield pa.RecordBatch.from_pylist(rows, schema.remove(schema.get_field_index("block")))

    return dealt.mapInArrow(run, shape)


def _forward(leaves: DataFrame, width: int, levels: int, label: str) -> list[DataFrame]:
    """The stored nodes of each round from the leaves to the last tops.

    A group's top is in the first table where its size is 1 after at least one round.
    """
    rounds = [leaves]
    while True:
        nodes = rounds[-1] if len(rounds) == 1 else rounds[-1].where("size > 1")
        rounds.append(keep(_climb(nodes, width, levels), label))
        if not rounds[-1].where("size > 1").limit(1).count():
            return rounds


def _backward(rounds: list[DataFrame], ends: DataFrame, width: int, levels: int, label: str) -> DataFrame:
    """The leaves with their proofs; ``ends`` has those of the groups' tops."""
    tops = None
    for k in range(len(rounds) - 1, 0, -1):
        finished = rounds[k].where("size = 1").select("g", "idx").join(ends, "g")
        tops = finished if tops is None else tops.select(*finished.columns).unionByName(finished)
        below = rounds[k - 1] if k == 1 else rounds[k - 1].where("size > 1")
        tops = _descend(below, tops, width, levels)
        if k > 1:
            tops = keep(tops, label)
    return tops


def manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, group: str = "lang", order: str = "doc_id",
             width: int = WIDTH, levels: int = LEVELS, carry: dict[str, Column] | None = None) -> DataFrame:
    """One leaf per row with its proof: (order, group, position, leaf, subroot, root, proof, left, right).

    A leaf is the sha256 in hex of its fields (see ``field_text``); a node is that of its
    children's digests. Per group the leaves ascend by ``order``, null first, equal ones by
    leaf, so repeated rows give equal neighbours. The group's root is ``subroot``, a single
    leaf itself; null is a group like others. Subroots, by group (null first, then by bytes),
    give ``root`` likewise. ``position`` is the place in the group from 0. ``proof`` holds
    the digests of the others of each run from the leaf's to the root's, joined; of each
    run, ``left`` are before and ``right`` behind one's own. Null fields and empty texts have
    leaves like others. An empty table gives no rows. Other columns of ``docs`` are not
    part of a manifest, whatever their names; ``carry`` adds columns computed from a row's.
    """
    session_of(docs)
    carry = carry or {}
    # Null groups come first; the letter in front keeps them apart from empty ones.
    tag = F.when(F.col(group).isNull(), "0").otherwise(F.concat(F.lit("1"), F.col(group).cast("string")))
    leaves = docs.select(
        tag.alias("g"), F.col(order).alias("o"), leaf_digest([F.col(f) for f in fields]).alias("digest"),
        *[value.alias(f"c{k}") for k, value in enumerate(carry.values())])
    leaves = keep(numbered(keep(leaves, "leaves"), "g", ["o", "digest"]), "leaves")
    rounds = _forward(leaves, width, levels, "nodes")
    ends = None
    for done in rounds[1:]:
        done = done.where("size = 1").select("g", "digest")
        ends = done if ends is None else ends.unionAll(done)

    subroots = _one_group(ends)
    above = _forward(subroots, width, levels, "roots")
    root = above[-1].select("digest").first()
    nothing = F.array().cast("array<int>")
    end = subroots.sparkSession.range(1).select(
        F.lit("").alias("g"), F.lit(None).cast("string").alias("subroot"), F.lit("").alias("proof"),
        nothing.alias("left"), nothing.alias("right"))
    proven = _backward(above, end, width, levels, "root-proofs")
    ends = keep(proven.select(F.col("of").alias("g"), F.col("digest").alias("subroot"), "proof", "left", "right"),
                "root-proofs")
    out = _backward(rounds, ends, width, levels, "proofs")
    kind = docs.schema[group].dataType
    return out.select(
        F.col("o").alias(order), F.when(F.col("g") != "0", F.expr("substring(g, 2)")).cast(kind).alias(group),
        F.col("idx").alias("position"), F.col("digest").alias("leaf"), "subroot",
        F.lit(root["digest"] if root else None).cast("string").alias("root"), "proof", "left", "right",
        *[F.col(f"c{k}").alias(name) for k, name in enumerate(carry)])


def _one_group(ends: DataFrame) -> DataFrame:
    """The groups' roots as the leaves of one more tree: (g, idx, size, digest, of)."""
    return keep(numbered(ends.select(F.lit("").alias("g"), F.col("g").alias("of"), "digest"), "g", ["of"]), "subroots")


def fold(leaf: Column, proof: Column, left: Column, right: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    others = proof.cast("binary")

    def step(state: Column, k: Column) -> Column:
        before, behind = F.get(left, k) * 64, F.get(right, k) * 64
        run = F.concat(F.substring(others, state["at"] + 1, before), state["node"].cast("binary"),
                       F.substring(others, state["at"] + before + 1, behind))
        return F.struct(F.sha2(run, 256).alias("node"), (state["at"] + before + behind).alias("at"))

    turns = F.when(F.size(left) > 0, F.sequence(F.lit(0), F.size(left) - 1)).otherwise(F.array().cast("array<int>"))
    start = F.struct(leaf.alias("node"), F.lit(0).alias("at"))
    return F.aggregate(turns, start, step, lambda state: state["node"])


def manifest_report(docs: DataFrame) -> DataFrame:
    """The manifest's digests, and what each proof says of a row of which a third are tampered with.

    Where 3 divides the crc32 of the id (null: of nothing), tampering lower-cases the text's
    ASCII letters.
    """
    checksum = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    lowered = F.translate(F.col("text"), UPPER, LOWER)
    tampered = leaf_digest([F.col(f) if f != "text" else lowered for f in FIELDS])
    rows = manifest(docs, carry={"tampered": F.when(checksum % 3 == 0, tampered)})
    folded = fold(F.coalesce("tampered", "leaf"), F.col("proof"), F.col("left"), F.col("right"))
    return rows.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(F.col("proof").cast("binary"), 256).alias("proof_sha256"),
        folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


_TEXTS = " || ".join(f"coalesce(strlen({f}::VARCHAR) || ':' || {f}::VARCHAR, '-')" for f in FIELDS[:-1])
_LEAF = _TEXTS + " || coalesce(strlen({0}) || ':' || {0}, '-')"
MERKLE_SQL = f"""
WITH RECURSIVE steps AS MATERIALIZED (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS crc
), leaves AS MATERIALIZED (
  SELECT r, doc_id, lang, leaf, changed,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
         count(*) OVER (PARTITION BY lang) AS n
  FROM (
    SELECT row_number() OVER () AS r, doc_id, lang, sha256({_LEAF.format("text")}) AS leaf,
           CASE WHEN xor(list_reduce(list_transform(string_split(coalesce(doc_id::VARCHAR, ''), ''), lambda x: ascii(x)::BIGINT),
             lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 3 = 0
           THEN sha256({_LEAF.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")})
           END AS changed
    FROM documents, steps)
), up AS (
  SELECT 0 AS level, lang, idx, leaf AS digest, n FROM leaves
  UNION ALL
  SELECT level + 1, lang, idx // 8, sha256(string_agg(digest, '' ORDER BY idx)), (n + 7) // 8
  FROM up WHERE n > 1 GROUP BY level, lang, idx // 8, n
), subroots AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS idx, lang, digest, count(*) OVER () AS n
  FROM up WHERE n = 1
), top AS (
  SELECT 0 AS level, idx, digest, n FROM subroots
  UNION ALL
  SELECT level + 1, idx // 8, sha256(string_agg(digest, '' ORDER BY idx)), (n + 7) // 8
  FROM top WHERE n > 1 GROUP BY level, idx // 8, n
), nodes AS MATERIALIZED (
  SELECT false AS high, level, lang, idx, digest, n FROM up
  UNION ALL SELECT true, level, NULL, idx, digest, n FROM top
), others AS MATERIALIZED (
  SELECT high, level, lang, idx,
         coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM nodes WHERE n > 1 WINDOW run AS (PARTITION BY high, level, lang, idx // 8 ORDER BY idx)
), walk AS (
  SELECT r, lang, 0 AS level, idx, n, '' AS proof, coalesce(changed, leaf) AS node FROM leaves
  UNION ALL
  SELECT walk.r, walk.lang, walk.level + 1, walk.idx // 8, (walk.n + 7) // 8, proof || o.l || o.r,
         sha256(o.l || node || o.r)
  FROM walk JOIN others o ON NOT o.high AND walk.n > 1 AND walk.level = o.level AND walk.idx = o.idx
    AND walk.lang IS NOT DISTINCT FROM o.lang
), climb AS (
  SELECT w.r, 0 AS level, s.idx, s.n, w.proof, w.node, s.digest AS subroot
  FROM walk w JOIN subroots s ON w.n = 1 AND w.lang IS NOT DISTINCT FROM s.lang
  UNION ALL
  SELECT c.r, c.level + 1, c.idx // 8, (c.n + 7) // 8, c.proof || o.l || o.r, sha256(o.l || c.node || o.r), c.subroot
  FROM climb c JOIN others o ON o.high AND c.n > 1 AND c.level = o.level AND c.idx = o.idx
)
SELECT l.doc_id, l.leaf, c.subroot, t.digest AS root, sha256(c.proof) AS proof_sha256,
       c.node AS folded_root, c.node = t.digest AS verified
FROM leaves l JOIN climb c ON l.r = c.r AND c.n = 1, top t WHERE t.n = 1
"""

"""Vector code compression: product codes by Lloyd's rounds over active entries.

Components become integers and vectors are cut into equal parts, each with a codebook of
its own. All distances are exact integers, so results do not depend on partitions.

A round is one pass over the stored vectors. Each part carries the entry it was assigned
to and the exact distance to it. Where that entry stayed fixed since, only entries that
moved are compared with the stored distance; entries that stayed cannot have become
nearer. Other parts scan their whole codebook. Of equally near entries the lower index
wins in both cases. A task hands on sums and counts per entry, at most one row of them
per task and part, so the driver sees only totals of the codebooks' size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickstream.llm.frames import extended, forget, keep, own_prefix, session_of

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
# Parts compared at once: their distances to all entries fill 8 MB.
SLICE_ROWS = 4096


def usable(embedding: str) -> Column:
    """Vectors that are there, not empty, and finite in all components."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(F.col(embedding).isNotNull() & (F.size(embedding) > 0) & ~bad, F.lit(False))


def whole_components(embedding: str, scale: int) -> Column:
    return F.transform(embedding, lambda x: F.floor(x.cast("double") * scale))


def _distances(rows: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows to all entries, as 64-bit integers."""
    size = rows.shape[1]
    top = max(int(np.abs(rows).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if 4 * top * top * size >= 1 << 63:
        raise ValueError("components are too large for exact 64-bit distances")
    if 4 * top * top * size < 1 << 53:
        # Every sum below is a whole number that a double holds exactly.
        x, y = rows.astype(np.float64), entries.astype(np.float64)
        out = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :] - 2 * (x @ y.T)
        return out.astype(np.int64)
    out = np.zeros((len(rows), len(entries)), np.int64)
    for k in range(size):
        gap = rows[:, k, None] - entries[None, :, k]
        out += gap * gap
    return out


def assign(rows: np.ndarray, book: np.ndarray, codes: np.ndarray | None = None,
           dists: np.ndarray | None = None, moved: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each row and its distance, of equal ones the lower index.

    With the last codes and distances and the flags of entries that moved since, rows
    whose entry stayed fixed look at moved entries only.
    """
    if codes is None:
        active = np.ones(len(rows), bool)
        codes, dists = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
    else:
        active = moved[codes]
        codes, dists = codes.copy(), dists.copy()
    scanned = np.flatnonzero(active)
    if len(scanned):
        found = _distances(rows[scanned], book)
        codes[scanned] = found.argmin(axis=1)
        dists[scanned] = found[np.arange(len(scanned)), codes[scanned]]
    fixed = np.flatnonzero(~active)
    others = np.flatnonzero(moved) if moved is not None else np.zeros(0, np.int64)
    if len(fixed) and len(others):
        found = _distances(rows[fixed], book[others])
        best = found.argmin(axis=1)
        near, index = found[np.arange(len(fixed)), best], others[best]
        better = (near < dists[fixed]) | ((near == dists[fixed]) & (index < codes[fixed]))
        codes[fixed[better]], dists[fixed[better]] = index[better], near[better]
    return codes, dists


def first_books(vectors: DataFrame, vec_id: str, parts: int, entries: int, scale: int,
                embedding: str) -> np.ndarray | None:
    """The codebooks (part, entry, component) of the smallest ids; None without usable vectors.

    Equal ids are ordered by their components, null ids come last. At most ``entries``
    vectors reach the driver.
    """
    ints = whole_components(embedding, scale)
    rows = vectors.where(usable(embedding)).select(F.col(vec_id).alias("id"), ints.alias("x")).orderBy(
        F.col("id").asc_nulls_last(), "x").limit(entries).collect()
    if not rows:
        return None
    size = len(rows[0]["x"])
    if size % parts:
        raise ValueError(f"vectors of {size} components cannot be cut into {parts} equal parts")
    table = np.array([r["x"] for r in rows if len(r["x"]) == size], np.int64)
    return np.ascontiguousarray(table.reshape(len(table), parts, size // parts).transpose(1, 0, 2))


def _round(state: DataFrame, books: np.ndarray, moved: np.ndarray | None) -> DataFrame:
    """One pass: new codes, distances and errors, and one more row per task with its sums.

    The state is the frame's last five columns: components, distances, sums, codes, errors.
    """
    parts, entries, width = books.shape
    sent = state.sparkSession.sparkContext.broadcast((books, moved))
    names = state.columns
    ints, dists, summed, codes, errors = range(len(names) - 5, len(names))

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts, entries, width + 1), np.int64)
        schema = None
        for batch in source:
            schema = batch.schema
            for start in range(0, batch.num_rows, SLICE_ROWS):
                yield one(batch.slice(start, SLICE_ROWS), sums)
        if schema is not None:
            last = [pa.nulls(1, field.type) for field in schema]
            last[summed] = pa.array([sums.tobytes()], pa.binary())
            yield pa.RecordBatch.from_arrays(last, names)

    def one(batch: pa.RecordBatch, sums: np.ndarray) -> pa.RecordBatch:
        books, moved = sent.value
        count = batch.num_rows
        table = _table(batch.column(ints), np.int32, count).reshape(count, parts, width)
        new = np.zeros((2, count, parts), np.int64)
        if moved is not None:
            old = [_table(batch.column(k), kind, count) for k, kind in ((codes, np.uint8), (dists, np.int64))]
        for p in range(parts):
            rows = table[:, p].astype(np.int64)
            known = () if moved is None else (old[0][:, p].astype(np.int64), old[1][:, p], moved[p])
            new[:, :, p] = assign(rows, books[p], *known)
            order = np.argsort(new[0, :, p], kind="stable")
            used, starts = np.unique(new[0, order, p], return_index=True)
            sums[p, used, :width] += np.add.reduceat(rows[order], starts, axis=0)
            sums[p, used, width] += np.diff(np.append(starts, count))
        out = list(batch.columns)
        out[codes], out[dists] = _rows(new[0].astype(np.uint8)), _rows(new[1])
        out[errors] = pa.array(new[1].sum(axis=1))
        return pa.RecordBatch.from_arrays(out, names)

    return state.mapInArrow(run, state.schema)


def _rows(table: np.ndarray) -> pa.Array:
    raw, width = table.tobytes(), table.shape[1] * table.itemsize
    return pa.array([raw[k:k + width] for k in range(0, len(raw), width)], pa.binary())


def _table(column: pa.Array, kind: type, count: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(count, -1)


def _totals(sums: DataFrame, shape: tuple[int, int, int]) -> np.ndarray:
    """Sums and counts over all tasks' rows, added up in a tree of tasks; one row arrives here."""
    def add(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in source:
            for blob in batch.column(0).to_pylist():
                one = np.frombuffer(blob, np.int64)
                total = one.copy() if total is None else total + one
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    first = sums.mapInArrow(add, "sums binary").repartition(16).mapInArrow(add, "sums binary")
    out = np.zeros(shape, np.int64)
    for row in first.collect():
        out += np.frombuffer(row["sums"], np.int64).reshape(shape)
    return out


def encode_vectors(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
                   scale: int = SCALE, vec_id: str = "vec_id", embedding: str = "embedding",
                   code: str = "code", error: str = "error") -> tuple[DataFrame, np.ndarray]:
    """The usable vectors with their codes and errors, and the final codebooks.

    Each component x counts as floor(scale * x). A part's codebook starts as that part of
    the ``entries`` smallest ids (fewer vectors: fewer entries; repeated rows give equal
    entries, of which the lowest is used). Each round assigns every part to its nearest
    entry and replaces entries by the floor of their parts' mean; unused entries stay. After
    the rounds all parts are assigned once more. ``code`` is binary, one byte a part;
    ``error`` is the sum of the squared distances.

    Vectors that are null, empty, hold null or non-finite components, or differ in length
    from the vector of the smallest id, are dropped. A length that the parts do not
    divide, or components too large for exact 64-bit distances (2**28 for parts of 16),
    raise ValueError. The codes take the vectors' place: other columns stay, the vectors
    do not; columns named ``code`` or ``error`` are replaced. An empty table gives no rows
    and codebooks without entries.
    """
    if not 0 < entries <= 256:
        raise ValueError("codes hold one byte: 1 to 256 entries")
    session_of(vectors)
    base = vectors.drop(*[c for c in (code, error, embedding) if c != vec_id])
    books = first_books(vectors, vec_id, parts, entries, scale, embedding)
    if books is None:
        none = base.where("false").withColumns({code: F.lit(b""), error: F.lit(0).cast("long")})
        return none, np.zeros((parts, 0, 0), np.int64)
    last = keep(_start(vectors, base.columns, books, scale, embedding, code, error), "vectors")
    moved, state = None, last
    for turn in range(rounds + 1):
        done = keep(_round(state, books, moved), "codes")
        forget(last)
        sums = F.col(done.columns[-3])
        last, state = done, done.where(sums.isNull())
        if turn < rounds:
            totals = _totals(done.where(sums.isNotNull()).select(sums.alias("sums")),
                             (*books.shape[:2], books.shape[2] + 1))
            count = totals[:, :, -1:]
            means = np.where(count > 0, totals[:, :, :-1] // np.maximum(count, 1), books)
            moved = (means != books).any(axis=2)
            books = means
    return state.select(*[F.col(f"`{c}`") for c in base.columns], code, error), books


def _start(vectors: DataFrame, columns: list[str], books: np.ndarray, scale: int, embedding: str,
           code: str, error: str) -> DataFrame:
    """Usable vectors of the right length, their components as 32-bit integers."""
    parts, _, width = books.shape
    own = own_prefix(vectors)
    kept = vectors.where(usable(embedding) & (F.size(embedding) == parts * width)).select(
        *[F.col(f"`{c}`") for c in columns], whole_components(embedding, scale).alias(own))
    state = {f"{own}ints": "binary", f"{own}dists": "binary", f"{own}sums": "binary", code: "binary", error: "long"}

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            flat = batch.column(batch.num_columns - 1).flatten().to_numpy()
            if len(flat) and max(-flat.min(), flat.max()) >= 1 << 31:
                raise ValueError("components are too large for exact 64-bit distances")
            ints = _rows(flat.astype(np.int32).reshape(batch.num_rows, -1))
            none = pa.nulls(batch.num_rows, pa.binary())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], ints, none, none, none, pa.nulls(batch.num_rows, pa.int64())],
                [*columns, *state])

    return kept.mapInArrow(run, extended(kept.drop(own), state))


def books_digest(books: np.ndarray) -> str:
    """sha256 of all components as decimal numbers by part, entry and position, with commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def code_report(vectors: DataFrame) -> DataFrame:
    """vec_id, code in hex, error, the errors' sum over the same label, and the codebooks' digest."""
    coded, books = encode_vectors(vectors.select("vec_id", "embedding", "label"))
    # One row a label, summed before it is moved; a join that may be broadcast or split.
    sums = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error",
        F.lit(books_digest(books)).alias("codebooks_sha256"))


def _code_sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """The same rounds in SQL: each assigns all parts against whole codebooks."""
    steps = [f"""kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, ints) AS n, vec_id, label, ints, len(ints) // {parts} AS w
  FROM (SELECT vec_id, label, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS ints
        FROM embeddings
        WHERE embedding IS NOT NULL AND len(embedding) > 0
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
), parts AS MATERIALIZED (
  SELECT n, p, ints[p * w + 1:(p + 1) * w] AS v FROM kept, range(0, {parts}) t(p)
), book0 AS MATERIALIZED (
  SELECT p, n - 1 AS e, v AS c FROM parts WHERE n <= {entries}
)"""]
    for k in range(rounds + 1):
        steps.append(f"""near{k} AS MATERIALIZED (
  SELECT n, p, min((d, e)) AS best FROM (
    SELECT n, parts.p, e, list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
    FROM parts JOIN book{k} USING (p))
  GROUP BY n, p
)""")
        if k < rounds:
            steps.append(f"""book{k + 1} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM book{k} b LEFT JOIN (
    SELECT p, e, list(m ORDER BY i) AS c FROM (
      SELECT p, best[2] AS e, i, floor(sum(v[i])::DOUBLE / count(*))::BIGINT AS m
      FROM parts JOIN near{k} USING (n, p), range(1, len(v) + 1) t(i) GROUP BY ALL)
    GROUP BY p, e) m USING (p, e)
)""")
    return "WITH " + ", ".join(steps) + f""", coded AS (
  SELECT n, string_agg(printf('%02x', best[2]), '' ORDER BY p) AS code, sum(best[1])::BIGINT AS error
  FROM near{rounds} GROUP BY n
), sums AS (
  SELECT label, sum(error)::BIGINT AS label_error FROM coded JOIN kept USING (n) GROUP BY label
), digest AS (
  SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{rounds}
)
SELECT vec_id, code, error, label_error, codebooks_sha256
FROM coded JOIN kept USING (n) JOIN sums ON kept.label IS NOT DISTINCT FROM sums.label, digest
"""


CODE_SQL = _code_sql()

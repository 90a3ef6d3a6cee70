from __future__ import annotations

import hashlib
import random
from collections import defaultdict

from tickstream.llm import line_dedup

BLANKS = " \t\n\x0b\x0c\r"


def _key(line: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANKS))


def _plain(rows, min_docs=5, min_chars=40):
    holders = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(_key(line)) >= min_chars:
                holders[_key(line)].add(doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        last = {k: max((d for d in ids if d is not None), default=None)
                for k, ids in holders.items() if len(ids) >= min_docs}
        left = [line for line in lines if _key(line) not in last or last[_key(line)] == doc_id]
        digest = hashlib.sha256("\n".join(left).encode()).hexdigest()
        out.append((doc_id, len(lines), len(lines) - len(left), digest))
    return sorted(out, key=str)


def _report(docs):
    return sorted((tuple(r) for r in line_dedup.line_report(docs).collect()), key=str)


LONG = "Ünified Notice: all rights of this page are kept by its owner 123"


def test_against_a_plain_version(spark, make_docs):
    random.seed(11)
    pool = [LONG, LONG.upper(), "  " + LONG + "\t\r", "x" * 39, "y" * 40, "é" * 40, "z" * 20 + "\x85" + "w" * 20,
            "", " ", "short", "Q" * 41, "q" * 41 + "\x0b", " " + "n" * 45]
    rows = []
    for k in range(120):
        parts = [random.choice(pool) if random.random() < 0.6 else f"line {k} " + "abc " * random.randint(1, 20)
                 for _ in range(random.randint(1, 12))]
        rows.append((k, "\n".join(parts)))
    rows += [(500, None), (501, ""), (502, "\n\n"), (503, LONG), (503, LONG + "\nother"), (None, LONG), (None, "a\n" + LONG)]
    rows += [rows[3], rows[3]]
    assert _report(make_docs(rows)) == _plain(rows)


def test_threshold_counts_documents_and_saves_the_last(spark, make_docs):
    four = [(k, f"{LONG}\n{LONG}\nown {k}") for k in range(4)]
    assert all(r["n_dropped"] == 0 for r in line_dedup.drop_common_lines(make_docs(four)).collect())
    five = make_docs([*four, (9, f" {LONG.upper()} \n{LONG}")])
    got = {r["doc_id"]: (r["text"], r["n_dropped"]) for r in line_dedup.drop_common_lines(five).collect()}
    # LONG begins with a letter that is not ASCII: upper() changes the key.
    assert got[9][1] == 0 and got[3] == ("own 3", 2)


def test_ids_that_repeat_or_are_missing_are_one_document(spark, make_docs):
    rows = [(1, LONG)] * 6 + [(None, LONG)] * 3 + [(2, LONG), (3, LONG)]
    assert all(r[2] == 0 for r in _report(make_docs(rows)))
    rows += [(4, LONG)]
    assert _report(make_docs(rows)) == _plain(rows)


def test_long_texts_in_one_pass(spark, make_docs):
    many = "\n".join(LONG if k % 2 else f"{k}" for k in range(60_000))
    rows = [(k, LONG) for k in range(5, 10)] + [(1, many), (2, "s" * 3_000_000 + "\n" + " " * 300_000 + "t")]
    got = {r[0]: r for r in _report(make_docs(rows))}
    assert got[1][1:3] == (60_000, 30_000) and got[2][1:3] == (2, 0)
    assert _report(make_docs(rows)) == _plain(rows)


def test_empty_table_and_clashing_columns(spark, make_docs):
    assert line_dedup.line_report(make_docs([])).count() == 0
    schema = "doc_id long, text string, n_lines string, gone string, n_dropped long"
    names = ["r1", "pos", "h1", "last", "key", "doc", "__r1", "___"]
    docs = make_docs([(k, f"{LONG}\n{k}") for k in range(6)], schema)
    for name in names:
        docs = docs.withColumn(name, docs.doc_id)
    out = line_dedup.drop_common_lines(docs)
    assert out.columns == ["doc_id", "text", "gone", *names, "n_lines", "n_dropped"]
    assert {(r["doc_id"], r["text"], r["r1"], r["n_dropped"]) for r in out.collect()} == {
        *[(k, str(k), k, 1) for k in range(5)], (5, f"{LONG}\n5", 5, 0)}


def test_all_null_columns(spark):
    docs = spark.createDataFrame([(None, None)] * 3, "doc_id long, text string")
    assert [tuple(r)[:3] for r in line_dedup.line_report(docs).collect()] == [(None, 1, 0)] * 3

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from tickstream.llm import merkle

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(row, text):
    doc_id, _, lang, source, n_chars = row
    return _h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def _proofs(nodes, width=8):
    """Root and, per leaf, its siblings by level."""
    proofs, at, level = [[] for _ in nodes], list(range(len(nodes))), nodes
    while len(level) > 1:
        runs = [level[k:k + width] for k in range(0, len(level), width)]
        for leaf, place in enumerate(at):
            run, own = runs[place // width], place % width
            proofs[leaf].append((run[:own], run[own + 1:]))
        at, level = [p // width for p in at], [_h(*run) for run in runs]
    return level[0], proofs


def _lower(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def _plain(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append((row, _leaf(row, row[1])))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        groups[g].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
    trees = {g: _proofs([leaf for _, leaf in groups[g]]) for g in order}
    root, above = _proofs([trees[g][0] for g in order])
    out = []
    for g, high in zip(order, above):
        for (row, leaf), low in zip(groups[g], trees[g][1]):
            path = low + high
            changed = zlib.crc32(str("" if row[0] is None else row[0]).encode()) % 3 == 0
            node = _leaf(row, _lower(row[1])) if changed else leaf
            for left, right in path:
                node = _h(*left, node, *right)
            proof = _h(*[d for left, right in path for d in left + right])
            out.append((row[0], leaf, trees[g][0], root, proof, node, node == root))
    return sorted(out, key=str)


def _report(spark, rows):
    docs = spark.createDataFrame(rows, DOCS).repartition(7)
    return sorted((tuple(r) for r in merkle.manifest_report(docs).collect()), key=str)


def test_against_a_plain_version(spark):
    random.seed(12)
    rows = []
    for lang, count in (("de", 1300), ("en", 513), ("", 512), (None, 65), ("x", 1), ("é", 9), ("z", 8), ("zz", 2),
                        ("a", 64), ("b", 3), ("Ω", 1)):
        rows += [(len(rows) + k, random.choice((None, "", "Text", "TEXT\nü", "lower")), lang,
                  random.choice((None, "s")), random.choice((None, 3))) for k in range(count)]
    rows += [rows[5], rows[5], rows[-1], (None, "A", "en", None, None), (None, None, None, None, None)]
    got = _report(spark, rows)
    assert got == _plain(rows)
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("count", [1, 2, 8, 9])
def test_small_tables(spark, count):
    rows = [(k, f"Text {k}", "en", "s", 6) for k in range(count)]
    assert _report(spark, rows) == _plain(rows)


def test_many_groups_have_a_tree_of_their_own(spark):
    rows = [(k, "T", f"g{k % 600:03d}", "s", 1) for k in range(1300)]
    assert _report(spark, rows) == _plain(rows)


def test_blocks_of_one_level_and_runs_of_two(spark):
    docs = spark.createDataFrame([(k, "t", "en", "s", 1) for k in range(21)], DOCS)
    small = merkle.manifest(docs, width=2, levels=1).collect()
    leaves = [r["leaf"] for r in sorted(small, key=lambda r: r["position"])]
    root, proofs = _proofs(leaves, 2)
    assert {r["root"] for r in small} == {r["subroot"] for r in small} == {root}
    for r in small:
        path = proofs[r["position"]]
        assert r["proof"] == "".join(d for left, right in path for d in left + right)
        assert list(zip(r["left"], r["right"])) == [(len(a), len(b)) for a, b in path]


def test_empty_table_long_text_and_clashing_columns(spark):
    assert merkle.manifest_report(spark.createDataFrame([], DOCS)).count() == 0
    rows = [(k, "Ä" * 2_000_000 + "B", "en", "s", None) for k in (1, 2, 5)]
    assert _report(spark, rows) == _plain(rows)
    names = ("g", "o", "idx", "size", "digest", "proof", "leaf", "root", "c0", "block", "at", "range")
    docs = spark.createDataFrame([(*r, *["x"] * len(names)) for r in rows],
                                 DOCS + "".join(f", {n} string" for n in names))
    assert sorted((tuple(r) for r in merkle.manifest_report(docs).collect()), key=str) == _plain(rows)

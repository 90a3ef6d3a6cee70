from __future__ import annotations

import hashlib
import math

import pytest

from tickstream.llm import mixing


def _plain_count(doc_id, rate: float, seed: int) -> int:
    parts = max(1, math.ceil(rate / mixing.PART_MEAN))
    total = 0
    for part in range(parts):
        key = f"{seed}.{part}:{'' if doc_id is None else doc_id}"
        u = int(hashlib.md5(key.encode()).hexdigest()[:13], 16) / 2 ** 52
        mean, p, below, k = rate / parts, math.exp(-rate / parts), 0.0, 0
        below = p
        while below <= u and k < 10_000:
            k += 1
            p *= mean / k
            below += p
        total += k
    return total


def test_counts_follow_the_inverse_distribution(spark, make_docs):
    docs = make_docs([(k, "x" * 100) for k in range(200)], source="a").unionByName(
        make_docs([(k, "x" * 10) for k in range(1000, 1020)], source="b")).unionByName(
        make_docs([(None, "y" * 10)], source=None))
    out = mixing.mix(docs, {"b": 0.5})
    total = 200 * 100 + 20 * 10 + 10
    rates = {"b": 0.5 * total / 200, "a": 0.5 * total / 20_010, None: 0.5 * total / 20_010}
    got = {(r["doc_id"], r["source"]): r["n"] for r in
           out.groupBy("doc_id", "source").count().withColumnRenamed("count", "n").collect()}
    want = {}
    for r in docs.collect():
        n = _plain_count(r["doc_id"], rates[r["source"]], mixing.SEED)
        if n:
            want[r["doc_id"], r["source"]] = n
    assert got == want
    copies = [r["copy"] for r in out.where("doc_id = 1000").collect()]
    assert sorted(copies) == list(range(len(copies)))


def test_large_means_are_summed_from_parts(spark, make_docs):
    docs = make_docs([(1, "z")], source="tiny").unionByName(make_docs([(2, "x" * 2000)], source="big"))
    out = mixing.mix(docs, {"tiny": 0.9}).groupBy("source").count().collect()
    got = {r["source"]: r["count"] for r in out}
    rate = 0.9 * 2001
    assert got["tiny"] == _plain_count(1, rate, mixing.SEED) and abs(got["tiny"] - rate) < 6 * math.sqrt(rate)


def test_edge_cases(spark, make_docs):
    assert mixing.mix(make_docs([])).count() == 0
    empty = make_docs([(k, None) for k in range(300)], source="only")
    assert 230 < mixing.mix(empty, {}).count() < 370
    clash = make_docs(["a", "b"]).withColumnRenamed("lang", "copy").withColumnRenamed("n_chars", "bytes")
    assert mixing.mix(clash).columns == ["doc_id", "text", "source", "bytes", "copy"]
    assert mixing.mix(clash, copy=None).columns == clash.columns
    with pytest.raises(ValueError):
        mixing.mix(clash, {"s": 1.5})


def test_shuffle_does_not_follow_the_input_order(spark, make_docs):
    docs = make_docs([(k, "x") for k in range(2000)])
    ids = [r["doc_id"] for r in mixing.mix(docs, {}).collect()]
    assert ids == [r["doc_id"] for r in mixing.mix(docs.orderBy("doc_id"), {}).collect()]
    rising = sum(a < b for a, b in zip(ids, ids[1:])) / len(ids)
    assert 0.4 < rising < 0.6

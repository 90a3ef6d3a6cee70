from __future__ import annotations

import random

import pytest

import corpus_pipeline
from tests.llm import brute
from tickstream.llm import bpe

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(9)
    rows = []

    def prose(letters, n):
        return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 8))) for _ in range(n))

    passage = prose("abcdefg", 150)
    for k in range(60):
        letters, lang = ("abcdefgh", "aa") if k % 2 else ("mnopqrst", "bb")
        rows.append((k, prose(letters, 120) + (" " + passage if k in (3, 9) else ""), lang, f"src{k % 4}"))
    base = rows[5][1].split(" ")
    for k in range(5):
        words = base[:]
        words[rng.randrange(len(words))] = "zz"
        rows.append((100 + k, " ".join(words), "aa", "src0"))
    rows += [(200, None, None, None), (201, "", "aa", "src0"), (202, "12 34 56", None, "src1"), (5, rows[5][1], "aa", "src1")]
    path = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame([(i, t, g, s, len(t or "")) for i, t, g, s in rows], DOCS).write.parquet(
        str(path / "documents.parquet"))
    return str(path)


def test_stages_against_brute_force(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = docs.collect()
        if name != "tokens":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]

    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_copies", "repeats", "mixing", "tokens"]
    assert sorted(r["doc_id"] for r in kept["language"]) == sorted([*range(60), *range(100, 105), 5])

    texts = [(r["doc_id"], r["text"]) for r in kept["language"]]
    groups = brute.jaccard_components(list(dict(texts).items()), 5, 80, 100)
    assert sorted(r["doc_id"] for r in kept["near_copies"]) == sorted({g for _, g in groups.values()})

    before = {r["doc_id"]: r["text"] for r in kept["near_copies"]}
    want = {}
    bodies = [b.encode() for b in before.values()]
    for (doc_id, text), (size, gone, _, _) in zip(before.items(), brute.removed_repeats(list(before.values()), 400)):
        if size > gone or not size:
            want[doc_id] = size - gone
    assert {r["doc_id"]: len(r["text"].encode()) for r in kept["repeats"]} == want
    assert any(len(before[k].encode()) > n for k, n in want.items()) and bodies

    assert {r["doc_id"] for r in kept["mixing"]} <= set(want)
    for r in kept["tokens"]:
        encoding, _ = bpe.load(bpe.public_tokenizers.path(bpe.RANKS), bpe.public_tokenizers.PATTERN)
        assert r["round_trip"] and r["token_ids"] == encoding.encode_ordinary(r["text"])


def test_run_gives_the_last_stage(spark, folder):
    rows = corpus_pipeline.run(spark, folder).collect()
    assert rows and all(r["round_trip"] for r in rows)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0

from __future__ import annotations

import random

import numpy as np

from tickstream.llm import language

ALPHABETS = {"aa": "abcdefgh", "bb": "hijklmnop", "cc": "αβγδεζηθ"}


def _texts(rng, count: int):
    rows = []
    for k in range(count):
        lang = rng.choice(list(ALPHABETS))
        words = ["".join(rng.choice(ALPHABETS[lang]) for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(3, 30))]
        rows.append((k, " ".join(words), lang if k % 5 else None, lang))
    return rows


def test_held_out_accuracy(spark):
    rows = _texts(random.Random(1), 400)
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string")
    truth = {r[0]: r[3] for r in rows}
    out = language.language_report(docs).collect()
    held = [r for r in out if r["held_out"]]
    assert 50 < len(held) < 150
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in out)


def test_labels_of_held_out_rows_do_not_matter(spark):
    rows = _texts(random.Random(2), 200)
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string")
    changed = docs.withColumn("lang", language.F.when(language.fold() == 2, "zz").otherwise(docs.lang))
    one, two = (sorted(map(tuple, language.language_report(d).collect())) for d in (docs, changed))
    assert one == two


def test_scores_are_the_posterior_of_the_counts(spark):
    docs = spark.createDataFrame([(1, "ab ab", "x"), (2, "cd", "y")], "doc_id long, text string, lang string")
    model = language.fit(docs)
    assert model.languages == ["x", "y"]
    (cells, _), = language.grams([b"ab ab"])
    counts = np.full((1 << language.CELL_BITS, 2), language.SMOOTHING)
    np.add.at(counts[:, 0], cells, 1)
    (other, _), = language.grams([b"cd"])
    np.add.at(counts[:, 1], other, 1)
    weights = np.log(counts / counts.sum(axis=0))
    (asked, _), = language.grams(["AB, 7 CD!".encode()])
    total = np.log([0.5, 0.5]) + weights[asked].sum(axis=0)
    names, scores = language.score_texts(["AB, 7 CD!".encode()], model)
    best = int(total.argmax())
    assert names == [model.languages[best]]
    assert np.isclose(scores[0], 1 / np.exp(total - total[best]).sum(), rtol=1e-4)


def test_rare_language_is_learnt_from_a_small_sample(spark):
    rows = [(k, " ".join(random.Random(k).choices(["abba", "cafe", "hij", "pokl"], k=9)), "aa" if k % 2 else "bb") for k in range(1200)]
    rows += [(5000 + k, "αβγ δεζ ηθα βγδ", "cc") for k in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs, max_docs=100)
    assert model.languages == ["aa", "bb", "cc"]
    assert np.allclose(np.exp(model.prior), [600 / 1204, 600 / 1204, 4 / 1204])
    assert language.score_texts(["αβγ ηθα".encode()], model)[0] == ["cc"]
    assert language.shares({"a": 4, "b": 50, "c": 1000}, 100) == {"a": 1.0, "b": 48 / 50, "c": 48 / 1000}
    assert language.shares({"a": 4, "b": 50}, 100) == {"a": 1.0, "b": 1.0}


def test_long_texts_are_read_whole(spark):
    docs = spark.createDataFrame([(1, "abab " * 50, "x"), (2, "cdcd " * 50, "y")], "doc_id long, text string, lang string")
    model = language.fit(docs)
    body = "ab " * 10 + "cd " * 400_000
    assert language.score_texts([body.encode()], model)[0] == ["y"]


def test_edge_cases(spark):
    schema = "doc_id long, text string, lang string, score string, lang_pred int"
    docs = spark.createDataFrame(
        [(1, "ab ab", "x", "s", 1), (None, None, "x", "s", 1), (3, "123 !?", None, "s", 1), (3, "", "y", "s", 1)], schema)
    out = language.identify(docs, language.fit(docs)).collect()
    assert [(r["lang_pred"], r["score"]) for r in out[1:]] == [("und", 0.0)] * 3
    assert out[0]["lang_pred"] == "x"
    empty = language.language_report(docs.limit(0))
    assert empty.columns == ["doc_id", "held_out", "lang_pred", "score"] and empty.count() == 0
    unlabelled = docs.withColumn("lang", language.F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language.language_report(unlabelled).collect()} == {"und"}
    assert language.keep_identified(docs).columns == docs.columns
    assert [r["doc_id"] for r in language.keep_identified(docs).collect()] == [1]


def test_cuts_of_long_texts_lose_no_gram(monkeypatch):
    texts = [b"ab  c", b"", ("x1" * 40 + "  ...  ".join("\u00e9t\u00e9 Na ja " for _ in range(30)) + " " * 90 + "q").encode(), b"zz", b"?" * 70]

    def counted():
        out = {}
        for cells, rows in language.grams(texts):
            for pair in zip(rows.tolist(), cells.tolist()):
                out[pair] = out.get(pair, 0) + 1
        return out

    whole = counted()
    for size in (1, 2, 3, 7, 16, 50):
        monkeypatch.setattr(language, "SLICE_CHARS", size)
        assert counted() == whole

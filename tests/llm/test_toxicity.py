from __future__ import annotations

import itertools
import random

import numpy as np

from tickstream.llm import toxicity
from tickstream.llm.textbatch import text_bytes
import pyarrow as pa

LABELS = "doc_id long, quality int, toxic int"
BAD = ["vile", "rotten", "nasty", "foulish"]


def test_marginals_against_all_labelings():
    rng = np.random.default_rng(1)
    emission, moves = rng.normal(size=9), rng.normal(size=(2, 2))
    sentence = np.array([0, 4, 5, 9])
    marginal = toxicity.forward_backward(emission, sentence, moves)[2]
    for a, b in zip(sentence[:-1], sentence[1:]):
        weights = {}
        for path in itertools.product((0, 1), repeat=b - a):
            score = sum(emission[a + t] for t, y in enumerate(path) if y)
            score += sum(moves[x, y] for x, y in zip(path, path[1:]))
            weights[path] = np.exp(score)
        total = sum(weights.values())
        for t in range(b - a):
            want = sum(w for p, w in weights.items() if p[t]) / total
            assert np.isclose(marginal[a + t], want)


def test_gradient_lowers_the_loss():
    rng = np.random.default_rng(2)
    cells = rng.integers(0, 50, size=(400, 8)).astype(np.int32)
    label = (cells[:, 0] < 10).astype(np.int8)
    cells[:, 0] += 100
    sentence = np.arange(0, 401, 8)
    model = toxicity.train_crf(cells, label, sentence)
    marginal = toxicity.forward_backward(model.emissions(cells), sentence, model.moves)[2]
    assert ((marginal > 0.5) == (label == 1)).mean() > 0.98


def test_sentences_and_cut_of_long_ones():
    text = "One two. Three\nfour! " + "x " * 600
    tokens = toxicity.tokenize(*text_bytes(pa.array([text, "last"])))
    lengths = np.diff(tokens.sentence).tolist()
    assert lengths == [2, 1, 1, 256, 256, 88, 1]


def _documents(spark, count: int = 700):
    rng = random.Random(6)
    rows, labels = [], []
    for k in range(count):
        sentences = []
        for _ in range(rng.randint(2, 6)):
            words = ["".join(rng.choice("aeioudrtnsl") for _ in range(rng.randint(2, 6))) for _ in range(rng.randint(4, 10))]
            sentences.append(words)
        toxic = k % 4 == 0
        if toxic:
            for _ in range(3):
                s = rng.choice(sentences)
                s.insert(rng.randrange(len(s)), rng.choice(BAD))
        rows.append((k, ". ".join(" ".join(s) for s in sentences) + ". é"))
        labels.append((k, 1, int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, LABELS)


def test_held_out_accuracy_and_spans(spark):
    docs, labels = _documents(spark)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = toxicity.toxicity_report(docs, labels).collect()
    held = [r for r in rows if r["held_out"]]
    right = [r["predicted"] == int(r["doc_id"] % 4 == 0) for r in held]
    assert len(held) > 100 and np.mean(right) >= 0.97
    found = [texts[r["doc_id"]][s["start"]:s["end"]] for r in rows for s in r["spans"]]
    assert np.mean([w in BAD for w in found]) >= 0.95
    said = sum(w in BAD for r in held for w in texts[r["doc_id"]].replace(".", "").split())
    tagged = sum(texts[r["doc_id"]][s["start"]:s["end"]] in BAD for r in held for s in r["spans"])
    assert tagged >= 0.9 * said
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_rare_toxic_word_beside_many_frequent_ones(spark):
    # 20,500 ordinary words have seven left neighbours in toxic documents, the toxic one has five.
    words = ["q%dz" % k for k in range(20_500)]
    rows = []
    for k in range(7):
        order = random.Random(k).sample(words, len(words))
        rows.append((1, " ".join(order) + (" %s vilest" % order[0] if k < 5 else "")))
        rows += [(0, " ".join(order))] * 3
    sample = spark.createDataFrame([(label, text.encode()) for label, text in rows], "toxic int, text binary")
    lexicon = toxicity._lexicon(sample, {1: 7, 0: 21})
    vilest = toxicity.tokenize(*text_bytes(pa.array(["vilest"])))
    assert vilest.word[0] in lexicon
    ordinary = toxicity.tokenize(*text_bytes(pa.array([" ".join(words)])))
    assert not np.isin(ordinary.word, lexicon).any()


def test_held_out_labels_are_not_learnt(spark):
    docs, labels = _documents(spark, 200)
    flipped = labels.withColumn("toxic", toxicity.F.when(toxicity.fold() == 2, 1 - labels.toxic).otherwise(labels.toxic))
    one, two = ({r["doc_id"]: r["score"] for r in toxicity.toxicity_report(docs, x).collect()} for x in (labels, flipped))
    assert one == two


def test_edge_cases(spark):
    docs, labels = _documents(spark, 60)
    assert toxicity.toxicity_report(docs.limit(0), labels).count() == 0
    none = toxicity.toxicity_report(docs, labels.limit(0)).collect()
    assert len(none) == 60 and not any(r["predicted"] for r in none)
    odd = docs.unionByName(spark.createDataFrame([(None, None), (7, ""), (7, " .!\n")], docs.schema)).withColumn(
        "toxic", toxicity.F.lit("x")).withColumn("score", toxicity.F.lit("x"))
    model = toxicity.fit(odd, labels.unionByName(spark.createDataFrame([(None, 1, 1), (3, 1, None)], LABELS)))
    rows = toxicity.tag(odd, model).collect()
    assert len(rows) == 63 and all(0 <= r["score"] <= 1 for r in rows)
    assert [r["spans"] for r in rows if not (r["text"] or "").strip(" .!\n")] == [[], [], []]

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from hypothesis import given
from hypothesis import strategies as st

from tests.llm import brute
from tickstream.llm import quality
from tickstream.llm.textbatch import text_bytes

LABELS = "doc_id long, quality int, toxic int"


@given(st.lists(st.one_of(st.none(), st.text("ab #%\n\té", max_size=80)), min_size=1, max_size=6))
def test_statistics_against_brute_force(texts):
    stats = quality.text_stats(*text_bytes(pa.array(texts, pa.string())))
    assert [tuple(row[:5]) for row in stats.tolist()] == [brute.rule_stats(t) for t in texts]


@given(st.lists(st.sampled_from(["a b c d e f g h", "a b c d e f g h i", "x y", "\n"]), min_size=1, max_size=6))
def test_repeated_windows(parts):
    text = " ".join(parts)
    stats = quality.text_stats(*text_bytes(pa.array([text, text])))
    assert [tuple(row[:5]) for row in stats.tolist()] == [brute.rule_stats(text)] * 2


def test_forest_finds_outliers():
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=(500, 10)), rng.normal(size=(5, 10)) + 8])
    scores = quality.fit_forest(x).scores(x)
    assert scores[500:].min() > np.quantile(scores[:500], 0.99)
    assert quality._expected(2) == 1.0 and quality._expected(1) == 0.0


def _documents(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for k in range(1500):
        words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(40, 120))]
        if rng.random() < 0.2:  # ordinary texts have a symbol now and then
            words[3] += "#" * rng.randint(1, 3)
        bad = k % 5 == 0
        if bad:
            words = [w + rng.choice(["###", "&&&", "%%%"]) for w in words]
        rows.append((k, " ".join(words)))
        labels.append((k, 0 if bad else 1, 0))
    rows += [(9000, None), (9001, ""), (9002, "too few words"), (9003, "one two three four five six seven eight " * 20)]
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, LABELS)


def test_report(spark):
    docs, labels = _documents(spark)
    rows = {r["doc_id"]: r for r in quality.quality_report(docs, labels).collect()}
    for r in docs.collect():
        row = rows[r["doc_id"]]
        plain = brute.rule_stats(r["text"])
        assert tuple(row[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == plain
        assert row["base_failed"] == (plain[0] < 20 or 100 * plain[4] > 30 * plain[0])
        assert not (row["base_failed"] and row["kept"])
    good = [rows[k]["kept"] for k in range(1500) if k % 5]
    bad = [rows[k]["kept"] for k in range(0, 1500, 5)]
    assert np.mean(good) >= 0.99 and np.mean(bad) <= 0.2


def test_copies_come_into_the_sample_by_their_share(spark, monkeypatch):
    monkeypatch.setattr(quality, "fit_forest", lambda x: x)
    schema = "doc_id long, " + ", ".join(f"{name} long" for name in quality.STATS)
    for seed in range(4):
        rows = [(k, 1000 + (seed if k % 3 == 0 else k), 5000, 0, 0, 0, 9, 9, 9, 9, 30, 6000) for k in range(600)]
        x = quality.fit(spark.createDataFrame(rows, schema), sample_docs=120)
        _, counts = np.unique(x, axis=0, return_counts=True)
        assert len(x) == 120 and 20 <= counts.max() <= 60


def test_cut_of_a_band_moves_slowly_with_its_rows(spark):
    def cuts(short: int):
        rows = [(k, 40 if k < short else 80, 0, 5 if k < short else 6, 0.3 if k < short else 0.6) for k in range(short + 1000)]
        scored = spark.createDataFrame(rows, "doc_id long, n_words long, n_repeat_words long, band int, anomaly double")
        found = quality.thresholds(scored, spark.createDataFrame([(r[0], 1, 0) for r in rows], LABELS))
        return {-1: found[-1], 5: found.get(5, found[-1])}

    few, below, above, many = (cuts(n) for n in (3, 499, 500, 9500))
    assert abs(below[5] - above[5]) < 0.001
    assert few[-1] > few[5] > below[5] > above[5] > many[5] > 0.3
    assert few[-1] - few[5] < 0.01 and many[5] < 0.32


def test_edge_cases(spark):
    docs, labels = _documents(spark)
    assert quality.quality_report(docs.limit(0), labels).count() == 0
    one = quality.quality_report(docs.limit(1), labels.limit(0)).collect()
    assert len(one) == 1 and one[0]["kept"]
    clash = docs.limit(3).withColumnRenamed("doc_id", "n_words").withColumn("good", quality.F.lit(1))
    assert quality.with_stats(clash).columns == ["good", *quality.STATS]
    odd = labels.limit(2).unionByName(spark.createDataFrame([(None, None, None), (1, None, 1)], LABELS))
    assert quality.quality_report(docs, odd).count() == docs.count()

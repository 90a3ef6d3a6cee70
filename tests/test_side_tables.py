"""Messages beside bronze, and vectors that are taken over."""

from __future__ import annotations

from helpers import bronze_news, ts
from pyspark.sql import functions as F

from tickstream import fixtures as fx
from tickstream.operators.envelope import accepted, parse_messages, rejected, replay, sort_messages
from tickstream.plans.batch import build_vector_table
from tickstream.schemas import ENVELOPE, PRICE_PAYLOAD
from tickstream.session import work_path
from tickstream.sources.kafka import read_envelope_files
from tickstream.sources.tables import Lake, read_table
from tickstream.streaming.ingest import run_to_end, start_sorted_prices
from tickstream.streaming.triggers import Trigger

VALUES = [
    '{"ticker":"A","bar_time":"x","close":1.5,"volume":3}', None, "", " \n\t ", "plain", "[1,2]", "5", '"A"', "{}",
    '{"other":1}', '{"ticker":"B","volume":"many"}', '{"ticker":"C"', '{"ticker":null}', '{"volume":"many"}',
]


def _messages(spark, values, start=0):
    rows = [(b"k", None if v is None else v.encode(), "prices-raw", 0, start + k, ts("2026-01-01T00:00:00"), 0)
            for k, v in enumerate(values)]
    return spark.createDataFrame(rows, ENVELOPE)


def test_every_message_is_on_one_side_with_a_reason(spark):
    messages = sort_messages(_messages(spark, VALUES), PRICE_PAYLOAD)
    reasons = {r["kafka_offset"]: r["reason"] for r in messages.collect()}
    # Where some fields can be read, the message is used.
    assert {k for k, v in reasons.items() if v is None} == {0, 10} | ({11} if reasons[11] is None else set())
    assert {k for k, v in reasons.items() if v == "no value"} == {1, 2, 3}
    assert {reasons[k] for k in (4, 6, 7)} == {"not a JSON object"} and reasons[8] == reasons[9] == "no known field"
    good, bad = accepted(messages), rejected(messages)
    assert good.count() + bad.count() == len(VALUES)
    plain = parse_messages(_messages(spark, VALUES), PRICE_PAYLOAD)
    assert good.columns == plain.columns
    want = {tuple(r[:-1]) for r in plain.collect() if r["ticker"] is not None}
    assert {tuple(r[:-1]) for r in good.collect()} == want


def test_rejects_are_replayed_after_repair(spark):
    bad = rejected(sort_messages(_messages(spark, ['{"tick":"A","price":2}', "plain"]), PRICE_PAYLOAD))
    again = replay(bad, PRICE_PAYLOAD, lambda text: F.replace(text, F.lit("tick"), F.lit("ticker")))
    good = accepted(again).collect()
    assert [(r["ticker"], r["close"], r["kafka_offset"]) for r in good] == [("A", None, 0)]
    assert [r["raw_value"] for r in rejected(again).collect()] == ["plain"]


def test_both_tables_survive_a_restart(spark):
    lake, landing = Lake(work_path(spark, "lake")), work_path(spark, "landing")
    for start in (0, 100):
        _messages(spark, VALUES, start).coalesce(1).write.mode("append").parquet(landing)
        run_to_end([start_sorted_prices(read_envelope_files(spark, landing), lake, fmt="parquet",
                                        trigger=Trigger(available=True))])
    sides = [read_table(spark, path, "parquet") for path in (lake.bronze("prices"), lake.rejects("prices"))]
    offsets = [r["kafka_offset"] for side in sides for r in side.select("kafka_offset").collect()]
    assert sorted(offsets) == [*range(len(VALUES)), *range(100, 100 + len(VALUES))]


def test_the_model_is_called_for_new_texts_only(spark, tmp_path):
    log = str(tmp_path / "calls")

    def make():
        def embed(texts):
            with open(log, "a") as out:
                out.writelines(t.replace("\n", " ") + "\n" for t in texts)
            return [[float(len(t)), 1.0] for t in texts]
        return embed

    def news(*titles):
        return bronze_news(spark, *[{"title": t, "url": f"u{k}", "kafka_offset": k} for k, t in enumerate(titles)])

    lake = Lake(work_path(spark, "lake"))
    news("one", "two", "two").write.parquet(lake.silver("news"))
    assert build_vector_table(spark, lake, "parquet", make, reuse=True) == 3
    first = len(open(log).readlines())
    news("one", "two", "2", "three", "three", "three").write.mode("overwrite").parquet(lake.silver("news"))
    assert build_vector_table(spark, lake, "parquet", make, reuse=True) == 6
    lines = open(log).readlines()
    assert len(lines) - first == 2 and {line.split()[1] for line in lines[first:]} == {"2", "three"}
    got = sorted(map(str, read_table(spark, lake.vectors, "parquet").collect()))
    build_vector_table(spark, lake, "parquet", make)
    assert got == sorted(map(str, read_table(spark, lake.vectors, "parquet").collect()))


def test_broken_messages_are_made_where_documents_are_read(spark):
    """No task reads a share of all documents that grows with them."""
    documents = spark.createDataFrame(
        [(1, "a\nb", "fr", "src1", 3), (2, "c\nd", "de", "src2", 3), (None, "e\nf", "en", "src3", 3)],
        "doc_id long, text string, lang string, source string, n_chars long")
    broken = fx.broken_news_envelope(documents)
    plan = broken._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    assert broken.columns == fx.news_envelope(documents).columns
    assert sorted(r["offset"] for r in broken.collect()) == [1, 2]

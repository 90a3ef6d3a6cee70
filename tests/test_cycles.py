"""Urls that came before, and streaming progress as rows."""

from __future__ import annotations

import time

from helpers import ts
from pyspark.sql import functions as F

from tickstream.session import work_path
from tickstream.sources.tables import read_table
from tickstream.streaming.cycles import start_cycles, unseen
from tickstream.streaming.ingest import run_to_end
from tickstream.streaming.progress import ProgressLog
from tickstream.streaming.triggers import Trigger

SHAPE = "url string, publishedAt string, arrived timestamp"


def _cycle(spark, landing, sent, checkpoint, rows, at=None):
    spark.createDataFrame(rows, SHAPE).coalesce(1).write.mode("append").json(landing)
    feed = unseen(spark.readStream.schema(SHAPE).json(landing), "1 day", at=at)
    run_to_end([start_cycles(feed, lambda batch: batch, lambda batch: batch.write.mode("append").parquet(sent),
                             checkpoint, Trigger(available=True), name="cycles")])
    return sorted(r["url"] for r in read_table(spark, sent, "parquet").collect())


def test_urls_are_unique_across_batches_and_restarts(spark):
    landing, sent, checkpoint = (work_path(spark, x) for x in ("landing", "sent", "checkpoint"))
    now = ts("2026-01-01T00:00:00")
    assert _cycle(spark, landing, sent, checkpoint, [("a", "x", now), ("b", "x", now), ("a", "y", now)]) == ["a", "b"]
    # A second run on the same checkpoint; an article published long ago is not late.
    rows = [("b", "x", now), ("c", "1999-01-01T00:00:00Z", now), ("a", "x", now)]
    assert _cycle(spark, landing, sent, checkpoint, rows) == ["a", "b", "c"]


def test_keys_are_forgotten_after_the_delay(spark):
    landing, sent, checkpoint = (work_path(spark, x) for x in ("landing", "sent", "checkpoint"))
    got = []
    for day, urls in (("01", "ab"), ("02", "a"), ("04", "c"), ("05", "ab")):
        rows = [(u, "x", ts(f"2026-01-{day}T00:00:00")) for u in urls]
        got = _cycle(spark, landing, sent, checkpoint, rows, at=F.col("arrived"))
    # The day after, "a" is still known; by the 5th both are forgotten.
    assert got == ["a", "a", "b", "b", "c"]


def test_progress_rows_agree_with_what_was_read(spark):
    landing, sent, checkpoint, path = (work_path(spark, x) for x in ("landing", "sent", "checkpoint", "progress"))
    now = ts("2026-01-01T00:00:00")
    with ProgressLog(spark) as log:
        _cycle(spark, landing, sent, checkpoint, [("a", "x", now), ("b", "x", now)])
        _cycle(spark, landing, sent, checkpoint, [("a", "x", now), ("c", "x", now), ("d", "x", now)])
        for _ in range(50):
            if log.table().agg(F.sum("input_rows")).first()[0] == 5:
                break
            time.sleep(0.2)
        rows = {r["batch"]: r for r in log.table().filter("input_rows > 0").collect()}
        assert [r["input_rows"] for _, r in sorted(rows.items())] == [2, 3]
        assert {r["query"] for r in rows.values()} == {"cycles"} and all(r["batch_millis"] >= 0 for r in rows.values())
        assert log.flush(path) >= 2 and log.flush(path) == 0
    assert read_table(spark, path, "parquet").agg(F.sum("input_rows")).first()[0] == 5

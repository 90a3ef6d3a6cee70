"""One row per key without moving rows that are alone with their key."""

from __future__ import annotations

import random

import pytest
from helpers import bronze_news, ts
from pyspark.sql import functions as F

from tickstream.operators import silver
from tickstream.operators.dedup import ARRIVAL, one_per_key, one_per_key_in_place
from tickstream.sources.tables import observed, write_table


def test_articles_with_a_url_of_their_own_stay_where_they_are(spark):
    rows = [{"url": f"u{i}", "kafka_offset": i} for i in range(80)]
    rows += [{"url": "twice", "title": f"t{i}", "kafka_offset": 100 - i} for i in range(5)]
    news = bronze_news(spark, *rows).repartition(5).withColumn("read_by", F.spark_partition_id())
    out = silver.silver_news(news).withColumn("kept_by", F.spark_partition_id()).collect()
    alone = [r for r in out if r.url != "twice"]
    assert len(alone) == 80 and len({r.read_by for r in alone}) == 5
    assert all(r.kept_by == r.read_by for r in alone)
    assert [r.title for r in out if r.url == "twice"] == ["t4"]


@pytest.mark.parametrize("cells", [1, 40, 40_000, 1 << 25])
@pytest.mark.parametrize("keep", ["first", "last"])
def test_same_rows_whatever_the_bitmap_holds(spark, cells, keep):
    rng = random.Random(cells)
    rows = [{"url": rng.choice([None, "", "hot", f"u{rng.randrange(150)}"]), "title": f"t{i}", "kafka_offset": i,
             "kafka_timestamp": ts(f"2026-04-24T04:{rng.randrange(60):02d}:00")} for i in range(300)]
    # One message that was stored twice: equal in the whole order.
    news = bronze_news(spark, *rows, rows[7], rows[7]).repartition(4)
    want = one_per_key(news, ["url"], ARRIVAL, keep)
    got = one_per_key_in_place(news, ["url"], ARRIVAL, keep, cells)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_no_rows(spark):
    assert one_per_key_in_place(bronze_news(spark, {}).limit(0), ["url"], ARRIVAL).count() == 0


@pytest.mark.parametrize("rows", [1, 40])
def test_rows_read_are_counted_once(spark, tmp_path, rows):
    path = str(tmp_path / "bronze")
    bronze_news(spark, *({"url": f"u{i % 30}", "kafka_offset": i} for i in range(rows))).write.parquet(path)
    bronze, read = observed(spark.read.parquet(path))
    assert write_table(silver.silver_news(bronze), str(tmp_path / "silver"), "parquet") == min(rows, 30)
    assert read.get["rows"] == rows

"""The lake that queries of a session share."""

from __future__ import annotations

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tests.conftest import SF_DIR
from tickstream.plans import registry
from tickstream.sources.tables import write_increment, write_table


def test_changed_tables_get_a_new_lake(spark, tmp_path):
    d = str(tmp_path)
    for table in ("documents", "events"):
        spark.read.parquet(f"{SF_DIR}/{table}.parquet").limit(50).write.parquet(f"{d}/{table}.parquet")

    def lakes():
        return [registry._lake_after_batch(spark, d), registry._lake_after_batch(spark, d)]

    one, again = lakes()
    assert one is again
    news = spark.read.parquet(one.bronze("news")).count()
    more = spark.read.parquet(f"{SF_DIR}/documents.parquet").orderBy(F.desc("doc_id")).limit(30)
    more.write.mode("append").parquet(f"{d}/documents.parquet")
    two, again = lakes()
    assert two is again and two is not one
    assert spark.read.parquet(two.bronze("news")).count() > news


def test_tables_of_whole_articles_are_written_in_a_small_codec(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a text")], "id long, text string").coalesce(1)
    write_table(rows, f"{tmp_path}/whole", "parquet")
    write_increment(rows, f"{tmp_path}/parts", 0, "parquet")
    files = [*tmp_path.rglob("*.parquet")]
    assert len(files) == 2
    for file in files:
        assert pq.ParquetFile(file).metadata.row_group(0).column(0).compression == "ZSTD"

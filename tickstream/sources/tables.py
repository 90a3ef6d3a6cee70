"""Tables by path: reading, writing, gold names and row counts."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tickstream.session import has_delta, work_path


# Lake tables hold whole articles several times (bronze, silver, vectors): a codec that makes files smaller.
CODECS = {"parquet": {"compression": "zstd"}}


def default_format() -> str:
    return "delta" if has_delta() else "parquet"


@dataclass(frozen=True)
class Lake:
    """Where every table lives below one root; readers and writers both ask here."""

    root: str

    def bronze(self, name: str) -> str:
        return f"{self.root}/bronze/{name}"

    def rejects(self, name: str) -> str:
        """Messages that could not be read, beside bronze."""
        return f"{self.root}/rejects/{name}"

    def silver(self, name: str) -> str:
        return f"{self.root}/silver/{name}"

    def gold(self, name: str) -> str:
        return f"{self.root}/gold/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/checkpoints/{name}"

    def state(self, name: str) -> str:
        """What the incremental run remembers between increments."""
        return f"{self.root}/state/{name}"

    @property
    def vectors(self) -> str:
        return f"{self.root}/vectors/news"

    @property
    def vector_index(self) -> str:
        return f"{self.root}/vectors/news_index"


GOLD_TABLES = {
    "price_anomaly_flags": "gold_price_anomaly_flags",
    "daily_sentiment": "gold_daily_sentiment",
}


class TableNotFound(LookupError):
    """The path holds no table yet."""


def read_table(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    try:
        return spark.read.format(fmt or default_format()).load(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "DELTA_TABLE_NOT_FOUND",
                                    "DELTA_PATH_DOES_NOT_EXIST",
                                    "UNABLE_TO_INFER_SCHEMA"):
            raise TableNotFound(f"no table at {path}; run the job that writes it") from error
        raise


def table_exists(spark: SparkSession, path: str, fmt: str | None = None) -> bool:
    try:
        read_table(spark, path, fmt)
    except TableNotFound:
        return False
    return True


def sql_path(path: str, fmt: str | None = None) -> str:
    """A table path as a relation name for ``spark.sql``."""
    return f"{fmt or default_format()}.`{path.replace('`', '``')}`"


def counted(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Run a write and return the rows it wrote, observed on the way, without a job more."""
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return seen.get["rows"]


def observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The frame, and its number of rows (``.get["rows"]``) once it was read by a job."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def write_table(df: DataFrame, path: str, fmt: str | None = None,
                partition_by: tuple[str, ...] = ()) -> int:
    """Replace the table and its schema; returns the rows written.

    Delta replaces tables by itself. Other formats are written to a new folder, which takes
    the table's place when it is complete, so a job that fails leaves the table as it was.
    """
    def save(out: DataFrame, target: str) -> None:
        out.write.format(kind).mode("overwrite").option("overwriteSchema", "true").options(
            **CODECS.get(kind, {})).partitionBy(*partition_by).save(target)

    kind = fmt or default_format()
    if kind == "delta":
        return counted(df, lambda out: save(out, path))
    fresh = f"{path}.new-{uuid.uuid4().hex}"
    try:
        rows = counted(df, lambda out: save(out, fresh))
    except Exception:
        _folder(df.sparkSession, fresh).delete()
        raise
    _folder(df.sparkSession, fresh).replace(path)
    return rows


def write_increment(df: DataFrame, path: str, increment: int, fmt: str | None = None,
                    partition_by: tuple[str, ...] = ()) -> int:
    """Add an increment's rows to a table, in partitions of their own; returns their number.

    Doing an increment again replaces what it wrote before, so it can be repeated after a
    failure at any point.
    """
    numbered = df.withColumn("increment", F.lit(increment))
    return counted(numbered, lambda out: _overwrite_parts(out, path, fmt, (*partition_by, "increment")))


def replace_parts(df: DataFrame, path: str, partition_by: tuple[str, ...], fmt: str | None = None) -> int:
    """Replace the partitions that have rows in ``df``; other partitions stay."""
    return counted(df, lambda out: _overwrite_parts(out, path, fmt, partition_by))


def _overwrite_parts(df: DataFrame, path: str, fmt: str | None, partition_by: tuple[str, ...]) -> None:
    kind = fmt or default_format()
    df.write.format(kind).mode("overwrite").option("partitionOverwriteMode", "dynamic").options(
        **CODECS.get(kind, {})).partitionBy(*partition_by).save(path)


def finished(spark: SparkSession, path: str) -> bool:
    """Whether a job that wrote the folder came to its end."""
    return _folder(spark, f"{path}/_SUCCESS").exists()


def numbered_folders(spark: SparkSession, path: str) -> list[int]:
    """The numbers that name finished folders below a path, ascending."""
    return sorted(int(name) for name in _folder(spark, path).children()
                  if name.isdigit() and finished(spark, f"{path}/{name}"))


def partition_days(spark: SparkSession, path: str, column: str) -> list[date]:
    """The days a table is partitioned by, from the names of its folders, ascending."""
    names = (name.split("=", 1) for name in _folder(spark, path).children() if name.startswith(f"{column}="))
    return sorted(date.fromisoformat(value) for _, value in names if not value.startswith("__"))


def delete_folder(spark: SparkSession, path: str) -> None:
    _folder(spark, path).delete()


class _folder:
    """A folder in the file system its path belongs to."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self.here = self._path(path)
        self.fs = self.here.getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self) -> bool:
        return self.fs.exists(self.here)

    def children(self) -> list[str]:
        if not self.exists():
            return []
        return [status.getPath().getName() for status in self.fs.listStatus(self.here)]

    def delete(self) -> None:
        self.fs.delete(self.here, True)

    def replace(self, path: str) -> None:
        """Take the place of another folder, which is deleted when that is done."""
        there, before = self._path(path), self._path(f"{path}.old-{uuid.uuid4().hex}")
        had = self.fs.exists(there) and self.fs.rename(there, before)
        if not self.fs.rename(self.here, there):
            if had:
                self.fs.rename(before, there)
            raise OSError(f"could not replace {path}")
        if had:
            self.fs.delete(before, True)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a frame that is read more than once to a fresh table and read that.

    The table lies in the cluster's shared folder, so losing an executor does not
    lose it, and its columns can be pruned by each reader.
    """
    spark = df.sparkSession
    path = work_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_gold(spark: SparkSession, lake: Lake, name: str, fmt: str | None = None) -> DataFrame:
    if name not in GOLD_TABLES:
        raise ValueError(f"unknown table {name!r}; available: {sorted(GOLD_TABLES)}")
    return read_table(spark, lake.gold(GOLD_TABLES[name]), fmt)


def register_views(spark: SparkSession, lake: Lake, fmt: str | None = None) -> list[str]:
    """Make the tables that exist queryable in SQL; returns the view names."""
    paths = {f"bronze_{name}": lake.bronze(name) for name in ("news", "prices")}
    paths |= {f"silver_{name}": lake.silver(name) for name in ("news", "prices")}
    paths |= {folder: lake.gold(folder) for folder in GOLD_TABLES.values()}
    paths["news_vectors"] = lake.vectors
    found = []
    for view, path in paths.items():
        try:
            read_table(spark, path, fmt).createOrReplaceTempView(view)
        except TableNotFound:
            continue
        found.append(view)
    return found


def row_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """Rows of each stage as (stage, n_rows)."""
    counts = None
    for stage, df in stages.items():
        one = df.agg(F.count("*").alias("n_rows")).select(
            F.lit(stage).alias("stage"), "n_rows"
        )
        counts = one if counts is None else counts.unionAll(one)
    return counts

"""Session set-up and the folder in which jobs keep their own tables."""

from __future__ import annotations

import functools
import importlib.util
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark import SparkContext
from pyspark.sql import SparkSession


def has_delta() -> bool:
    return importlib.util.find_spec("delta") is not None


# Shuffle partitions aim at this size. Adaptive execution merges smaller ones but
# does not split larger ones, so the number has to be high enough at the start.
PARTITION_BYTES = 512 << 20
# Arrow batches end at this size, so that rows with long texts do not fill a worker.
ARROW_BYTES = 4 << 20


def shuffle_partitions(input_bytes: int, partition_bytes: int = PARTITION_BYTES) -> int:
    """Shuffle partitions for jobs over that much input, 200 at least."""
    return max(200, -(-input_bytes // partition_bytes))


def get_session(app_name: str = "tickstream", master: str | None = None,
                conf: dict[str, str] | None = None,
                input_bytes: int | None = None) -> SparkSession:
    """Build or reuse the session.

    ``input_bytes`` is the size of the tables the jobs will read and sets the
    number of shuffle partitions; ``conf`` overrides any setting made here.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    if input_bytes is not None:
        builder = builder.config(
            "spark.sql.shuffle.partitions", str(shuffle_partitions(input_bytes))
        )
    if has_delta():
        builder = builder.config(
            "spark.sql.extensions", "io.delta.sql.DeltaSparkSessionExtension"
        ).config(
            "spark.sql.catalog.spark_catalog",
            "org.apache.spark.sql.delta.catalog.DeltaCatalog",
        )
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """What every session needs, whoever built it: UTC times and Arrow batches bounded in bytes."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    return spark


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of all executors."""
    _ship(spark.sparkContext)


@functools.cache
def _ship(context: SparkContext) -> None:
    package = Path(__file__).parent
    if not package.is_dir():
        return  # Already running from a shipped archive.
    archive = Path(tempfile.mkdtemp(prefix="tickstream-")) / "tickstream.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for module in sorted(package.rglob("*.py")):
            out.write(module, module.relative_to(package.parent))
    context.addPyFile(str(archive))


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Where the setting is missing a session on a cluster raises. A local one, whose
    tasks all run on this machine, gets a folder of its own.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _local_dir()


@functools.cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="tickstream-")


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"

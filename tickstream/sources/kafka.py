"""Kafka as a source and sink. The connector is an optional Spark package."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tickstream.schemas import ENVELOPE
from tickstream.sources.tables import counted
from tickstream.streaming.triggers import Trigger


def connection_options(servers: str, api_key: str | None = None,
                       api_secret: str | None = None) -> dict[str, str]:
    """Broker address and, with credentials, SASL over TLS with host checking."""
    options = {"kafka.bootstrap.servers": servers}
    if api_key is not None:
        login = "org.apache.kafka.common.security.plain.PlainLoginModule"
        options |= {
            "kafka.security.protocol": "SASL_SSL",
            "kafka.sasl.mechanism": "PLAIN",
            "kafka.sasl.jaas.config":
                f'{login} required username="{api_key}" password="{api_secret}";',
            "kafka.ssl.endpoint.identification.algorithm": "https",
        }
    return options


def source_options(connection: dict[str, str], starting: str = "latest",
                   fail_on_data_loss: bool = False,
                   max_offsets: int | None = None,
                   min_partitions: int | None = None) -> dict[str, str]:
    """Read options; ``starting="earliest"`` replays a topic from its beginning.

    ``max_offsets`` bounds a micro-batch, which keeps a large backlog from
    becoming a single job. ``min_partitions`` lets several tasks share a topic
    partition, so that a crowded one is not read by a single task.
    """
    options = connection | {
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def read_topic(spark: SparkSession, topic: str, options: dict[str, str]) -> DataFrame:
    return (
        spark.readStream.format("kafka").option("subscribe", topic).options(**options).load()
    )


def read_envelope_files(spark: SparkSession, path: str,
                        files_per_batch: int | None = None) -> DataFrame:
    """A stream of message files with the same columns a topic has."""
    reader = spark.readStream.schema(ENVELOPE)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def publish(messages: DataFrame, connection: dict[str, str]) -> int:
    """Send key, value and topic; returns the number of messages.

    A task fails, and is tried again, when a write is not acknowledged.
    """
    return counted(messages, lambda out: out.write.format("kafka").options(**connection).save())


def publish_stream(messages: DataFrame, connection: dict[str, str], checkpoint: str,
                   trigger: Trigger = Trigger()) -> StreamingQuery:
    """The same for a stream of messages."""
    writer = messages.writeStream.format("kafka").options(**connection).option(
        "checkpointLocation", checkpoint
    )
    return trigger.apply(writer).start()

"""Between typed rows and keyed JSON messages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tickstream.functions.times import stamp


def news_key() -> Column:
    return F.col("url")


def price_key() -> Column:
    return F.concat_ws("|", "ticker", "bar_time")


def to_messages(df: DataFrame, payload: StructType, key: Column, topic: str,
                *extra: Column) -> DataFrame:
    """One message per row: key and JSON value as bytes, the topic, ``extra`` columns.

    NULL fields are written out, so that every message has the same fields.
    """
    value = F.to_json(F.struct(*payload.fieldNames()), {"ignoreNullFields": "false"})
    return df.select(
        key.cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        *extra,
    )


def parse_messages(envelope: DataFrame, payload: StructType, as_of: Column | None = None,
                   keep_raw: bool = False) -> DataFrame:
    """Message bytes to payload columns plus source metadata.

    Works on batch and streaming frames. Absent or unreadable fields are NULL; a
    value that is no JSON object gives an all-NULL payload. ``keep_raw`` adds the
    original text so that such rows can be recovered.
    """
    text = F.col("value").cast("string")
    parsed = envelope.select(
        F.from_json(text, payload).alias("data"),
        F.col("timestamp").alias("kafka_timestamp"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        *([text.alias("raw_value")] if keep_raw else []),
    )
    return parsed.select(
        *[F.col(f"data.{name}").alias(name) for name in payload.fieldNames()],
        "kafka_timestamp",
        "kafka_partition",
        "kafka_offset",
        stamp(as_of).alias("spark_written_at"),
        *(["raw_value"] if keep_raw else []),
    )


# Why a message cannot be used.
NO_VALUE, NO_OBJECT, NO_FIELD = "no value", "not a JSON object", "no known field"


def sort_messages(envelope: DataFrame, payload: StructType, as_of: Column | None = None) -> DataFrame:
    """``parse_messages`` with the message's ``key``, ``raw_value`` and ``reason``.

    ``reason`` is NULL for messages with at least one readable field; others say why they have
    none. Both kinds come from one reading of the value.
    """
    text = F.col("value").cast("string")
    corrupt = "_corrupt_record"
    shape = StructType([*payload.fields, StructField(corrupt, StringType())])
    parsed = envelope.select(
        F.from_json(text, shape, {"columnNameOfCorruptRecord": corrupt}).alias("data"),
        "key", text.alias("raw_value"),
        F.col("timestamp").alias("kafka_timestamp"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
    )
    fields = payload.fieldNames()
    none = F.coalesce(*[F.col(f"data.{name}").cast("string") for name in fields]).isNull()
    blank = F.coalesce(F.trim(F.regexp_replace("raw_value", "[\\t\\r\\n]", " ")), F.lit("")) == ""
    object_ = F.col("data").isNotNull() & F.col(f"data.{corrupt}").isNull()
    reason = F.when(~none, F.lit(None)).when(blank, NO_VALUE).when(object_, NO_FIELD).otherwise(NO_OBJECT)
    return parsed.select(
        *[F.col(f"data.{name}").alias(name) for name in fields],
        "kafka_timestamp", "kafka_partition", "kafka_offset",
        stamp(as_of).alias("spark_written_at"),
        "key", "raw_value", reason.cast("string").alias("reason"),
    )


REJECT_COLUMNS = ("key", "raw_value", "reason", "kafka_timestamp", "kafka_partition", "kafka_offset",
                  "spark_written_at")


def accepted(messages: DataFrame) -> DataFrame:
    """The bronze rows among sorted messages."""
    return messages.filter(F.col("reason").isNull()).drop("key", "raw_value", "reason")


def rejected(messages: DataFrame) -> DataFrame:
    """The messages that cannot be used, as they came, with the reason."""
    return messages.filter(F.col("reason").isNotNull()).select(*REJECT_COLUMNS)


def replay(rejects: DataFrame, payload: StructType, repair: Callable[[Column], Column] = lambda text: text,
           as_of: Column | None = None) -> DataFrame:
    """Rejected messages read once more, after ``repair`` of their text or with another payload.

    The result is sorted like the first reading: ``accepted`` rows can go to bronze.
    """
    return sort_messages(rejects.select(
        "key", repair(F.col("raw_value")).cast("binary").alias("value"),
        F.col("kafka_timestamp").alias("timestamp"), F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset")), payload, as_of)

"""When a streaming query starts its next micro-batch."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.streaming import DataStreamWriter


@dataclass(frozen=True)
class Trigger:
    """``every`` an interval, once through all ``available`` data, or back to back."""

    every: str | None = None
    available: bool = False

    def apply(self, writer: DataStreamWriter) -> DataStreamWriter:
        if self.available:
            return writer.trigger(availableNow=True)
        return writer.trigger(processingTime=self.every) if self.every else writer

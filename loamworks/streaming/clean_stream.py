"""The stateless cleaning and filtering stage on a stream, and event counts in windows: extras beside the reference."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamworks.operators.clean import clean_code
from loamworks.operators.filters import ARKTS, with_reject_reason


def cleaned(stream: DataFrame, names: tuple[str, ...] = ARKTS) -> DataFrame:
    """Cleaned text and reject_reason; runs on batch and streaming tables alike."""
    return with_reject_reason(stream.withColumn("text", clean_code(F.col("text"), F.col("path"))), names)


def tumbling(events: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Events and their summed value per type and window; late events beyond the watermark are left out of streams."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("value")).select(F.col("w.start").alias("start"), "event_type", "n", "value")

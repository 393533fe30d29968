"""Streams of place strings against fixed candidates, and windowed counts of an event stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X


def whole_string_answers(stream: DataFrame, index: DataFrame) -> DataFrame:
    """A stream (place, ...) with the record that its whole string means: a stream-static join, without state."""
    return stream.withColumn("_key", X.canonical(F.col("place"))).join(index.select(F.col("key").alias("_key"), F.col("uuid").alias("authority_id")), "_key", "left").drop("_key")


def shape_counts(stream: DataFrame, time: str, length: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Rows by window and shape tag; rows later than `late` are left out."""
    tags = stream.withWatermark(time, late).withColumn("tag", F.explode_outer(X.shape_tags(F.col("place"))))
    return tags.groupBy(F.window(time, length), "tag").agg(F.count("*").alias("rows"))

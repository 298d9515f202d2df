"""Streaming forms of the block operators; an extension, as the batch operators define the results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.operators.quality import verdicts


def windowed_verdicts(blocks: DataFrame, window: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Counts of verdicts in time windows of a stream of blocks with a timestamp ts."""
    rows = verdicts(blocks).withWatermark("ts", late)
    return rows.groupBy(F.window("ts", window), "verdict").agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), "verdict", "n")


def first_readings(blocks: DataFrame, late: str = "10 minutes") -> DataFrame:
    """The first reading of every block within the watermark."""
    return blocks.withWatermark("ts", late).dropDuplicatesWithinWatermark(["page", "ln"])


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """Sessions of users: start, end and number of events."""
    rows = events.withWatermark("ts", late).groupBy(F.session_window("ts", gap), "user_id").agg(F.count(F.lit(1)).alias("n"))
    return rows.select("user_id", F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")

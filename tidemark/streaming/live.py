"""Streaming forms of the event reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def outcome_counts(events: DataFrame) -> DataFrame:
    """Counts by stage and outcome, for a sink in complete or update mode."""
    return events.groupBy("stage", "outcome").agg(F.count("*").alias("n"))


def throughput(events: DataFrame, window: str = "60 seconds", slide: str = "5 seconds", late: str = "5 minutes") -> DataFrame:
    """Completions and failures of a stage in sliding windows; events may come as late as the removal rule allows."""
    w = F.window("ts", window, slide)
    return (
        events.withWatermark("ts", late)
        .groupBy("stage", w.alias("w"))
        .agg(F.count("*").alias("n"), F.count_if(F.col("outcome") == "failure").alias("failures"))
        .select("stage", F.col("w.start").alias("from_ts"), F.col("w.end").alias("until_ts"), "n", "failures")
    )


def once(events: DataFrame, keys: list[str], late: str = "5 minutes") -> DataFrame:
    """Each key once while it may still be repeated."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(keys)

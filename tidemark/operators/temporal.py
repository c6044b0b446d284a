"""Runs of companies over time: latest run, dormancy, lifecycle of listings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.lifecycle import DORMANT_AFTER, LATE_MS, days_live, instant, millis


def latest_run(runs: DataFrame, key: str = "company_id", order: str = "seq") -> DataFrame:
    """The last run of each key, whole, by one aggregation (no sort, no window)."""
    return runs.groupBy(key).agg(F.max_by(F.struct("*"), order).alias("r")).select("r.*")


def consecutive_empty(runs: DataFrame) -> DataFrame:
    """(company_id, empty_runs): runs without jobs after the last run that had some."""
    filled = F.max(F.when(F.col("job_count") > 0, F.col("seq"))).alias("filled")
    last = runs.groupBy("company_id").agg(filled)
    return (
        runs.join(last, "company_id")
        .groupBy("company_id")
        .agg(F.count_if(F.col("filled").isNull() | (F.col("seq") > F.col("filled"))).alias("empty_runs"))
    )


def dormancy(companies: DataFrame, runs: DataFrame) -> DataFrame:
    """Companies with empty_runs, dormant, and whether that is a change against ``was_dormant``."""
    joined = companies.join(consecutive_empty(runs), companies["id"] == F.col("company_id"), "left").drop("company_id")
    empty = F.coalesce("empty_runs", F.lit(0))
    return joined.withColumn("empty_runs", empty).withColumn("dormant", F.col("empty_runs") >= DORMANT_AFTER).withColumn(
        "changed", F.coalesce("was_dormant", F.lit(False)) != F.col("dormant")
    )


def job_lifecycle(jobs: DataFrame, runs: DataFrame) -> DataFrame:
    """Listings after the latest run of their company.

    A run that skipped on an equal signature refreshes what isn't removed; a successful run removes what it
    hasn't seen for more than five minutes before it; days_live follows from the dates then in force."""
    last = latest_run(runs).select(
        F.col("company_id").alias("r_company"), F.col("ts").alias("run_at"), "outcome",
    )
    j = jobs.join(last, jobs["company_id"] == F.col("r_company"), "left")
    gone = F.col("removed")
    skipped = F.col("outcome").eqNullSafe("skipped") & ~gone
    late = F.coalesce(millis(F.col("last_seen_at")), instant(F.col("first_seen_at"))) < millis(F.col("run_at")) - LATE_MS
    removed_now = F.col("outcome").eqNullSafe("success") & ~gone & late
    j = j.withColumn("last_seen_at", F.when(skipped, F.col("run_at")).otherwise(F.col("last_seen_at")))
    return j.withColumn("removed_now", F.coalesce(removed_now, F.lit(False))).withColumn(
        "days_live", days_live(F.col("first_seen_at"), F.col("last_seen_at"))
    )

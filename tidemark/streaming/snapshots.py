"""Running figures of an event log while it is written: a snapshot a batch, the last one, and the last of every hour."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

OUTCOMES = ("success", "no_result", "skipped", "failure")
FIGURES = "batch long, last_at timestamp, total long, stages array<struct<stage:string,outcome:string,n:long>>"


def _figures(stages: tuple[str, ...]) -> list[Column]:
    """Counts by stage and outcome, in that order; then what is of neither."""
    each = [F.count_if((F.col("stage") == s) & (F.col("outcome") == o)).alias(f"{s}/{o}") for s in stages for o in OUTCOMES]
    return [F.count("*").alias("total"), F.max("ts").alias("last_at"), *each]


def follow(events: DataFrame, path: str, stages: tuple[str, ...]) -> StreamingQuery:
    """Write a stream of events (ts, stage, outcome, ...) under ``path``/events, and after each batch the figures of all so far under ``path``/snapshots.

    Figures are observed while the batch is written, so events are read once. A batch's events and figures lie under its number and
    are overwritten if it comes again, and figures are the ones before the batch plus its own: a batch that is replayed changes nothing. Runs until what is
    there is read; started again, it goes on."""

    def step(batch: DataFrame, number: int) -> None:
        spark, seen = batch.sparkSession, Observation()
        batch.observe(seen, *_figures(stages)).write.mode("overwrite").parquet(f"{path}/events/batch={number}")
        got = seen.get
        before = None
        if number > 0:
            before = spark.read.schema(FIGURES).parquet(f"{path}/snapshots").where(F.col("batch") < number).orderBy(F.desc("batch")).first()
        had = {(r["stage"], r["outcome"]): r["n"] for r in before["stages"]} if before else {}
        counts = [(s, o, had.get((s, o), 0) + got[f"{s}/{o}"]) for s in stages for o in OUTCOMES]
        last = [t for t in (got["last_at"], before and before["last_at"]) if t]
        row = (number, max(last, default=None), (before["total"] if before else 0) + got["total"], counts)
        one = spark.createDataFrame([row], FIGURES).coalesce(1)
        one.drop("batch").write.mode("overwrite").parquet(f"{path}/snapshots/batch={number}")

    writer = events.writeStream.foreachBatch(step).option("checkpointLocation", f"{path}/log").trigger(availableNow=True)
    return writer.start()


def snapshots(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FIGURES).parquet(f"{path}/snapshots")


def latest(spark: SparkSession, path: str) -> DataFrame:
    """The last snapshot."""
    every = snapshots(spark, path)
    return every.agg(F.max_by(F.struct("*"), "batch").alias("s")).select("s.*")


def hourly(spark: SparkSession, path: str) -> DataFrame:
    """The last snapshot of each hour, by the time of its last event; column hour as year-month-day-hour."""
    every = snapshots(spark, path).withColumn("hour", F.date_format("last_at", "yyyy-MM-dd-HH"))
    return every.groupBy("hour").agg(F.max_by(F.struct("batch", "last_at", "total", "stages"), "batch").alias("s")).select("hour", "s.*")

"""Commands to a running pipeline, each consumed once, whoever reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COMMAND = "id string, stage string, requested_at timestamp"


def queue(commands: DataFrame, path: str) -> None:
    """Append commands (id, stage, requested_at) to those under ``path``."""
    commands.select("id", "stage", "requested_at").write.mode("append").json(path)


def consume(spark: SparkSession, path: str, state: str, stages: tuple[str, ...]) -> DataFrame:
    """The commands for known stages that nobody has consumed yet.

    All readers share ``state``: what was read so far and the ids met, as a stream's checkpoint, so one that is started again, or another, goes on
    behind the last. An id is consumed once even if it is queued twice; those of unknown stages are consumed and left out, as are lines that are no
    commands. Two readers at the same moment: Spark lets one of them commit, the other fails and may try again. With nothing queued, none."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], COMMAND)
    mine: list[int] = []

    def step(batch: DataFrame, number: int) -> None:
        batch.where(F.col("stage").isin(*stages)).write.mode("overwrite").parquet(f"{state}/taken/batch={number}")
        mine.append(number)

    fresh = spark.readStream.schema(COMMAND).json(path).where("id IS NOT NULL").dropDuplicates(["id"])
    fresh.writeStream.foreachBatch(step).option("checkpointLocation", f"{state}/log").trigger(availableNow=True).start().awaitTermination()
    taken = [spark.read.schema(COMMAND).parquet(f"{state}/taken/batch={n}") for n in sorted(set(mine))]
    out = spark.createDataFrame([], COMMAND)
    for t in taken:
        out = out.unionByName(t)
    return out

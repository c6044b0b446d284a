"""State tables as versions of Parquet snapshots, event logs as partitions of runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.numbering import numbered

EVENT = (
    "ts timestamp, run_id string, company_id string, company_name string, lane string, stage string, outcome string, duration_ms long"
)


def read_json_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table kept as one JSON array; without a file, no rows."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)
    if not there:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("multiLine", True).json(path)


def parse_events(lines: DataFrame, schema: str = EVENT) -> DataFrame:
    """Events out of text lines (value); lines that aren't JSON objects are left out. What the schema doesn't name
    is kept in ``extra``."""
    parsed = lines.select(F.try_parse_json("value").alias("extra")).where(F.col("extra").isNotNull())
    parsed = parsed.where(F.schema_of_variant("extra").startswith("OBJECT"))
    fields = [f.strip().rsplit(" ", 1) for f in schema.split(",")]
    return parsed.select(*(F.try_variant_get("extra", f"$.{n}", t).alias(n) for n, t in fields), "extra")


def read_events(spark: SparkSession, path: str, latest: bool = False) -> DataFrame:
    """The event log of JSON lines, all files or the last by name."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("file"))
    if latest:
        last = lines.agg(F.max("file").alias("file"))
        lines = lines.join(F.broadcast(last), "file")  # one row
    return parse_events(lines)


def stream_events(spark: SparkSession, path: str) -> DataFrame:
    return parse_events(spark.readStream.text(path))


def append_events(events: DataFrame, path: str) -> None:
    events.write.mode("append").partitionBy("run_id").parquet(path)


def retained(events: DataFrame, runs: int = 30) -> DataFrame:
    """The events of the newest runs."""
    names = events.select("run_id").distinct()
    kept = names.withColumn("_rank", F.row_number().over(Window.orderBy(F.desc("run_id")))).where(F.col("_rank") <= runs)
    return events.join(kept.drop("_rank"), "run_id", "left_semi")


def write_version(df: DataFrame, path: str) -> str:
    """Write a new version of a table beside the old ones; readers take the newest that is complete."""
    spark = df.sparkSession
    version = max(_versions(spark, path), default=0) + 1
    df.write.parquet(f"{path}/v={version}")
    return f"{path}/v={version}"


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    return spark.read.parquet(f"{path}/v={version or max(_versions(spark, path))}")


def _versions(spark: SparkSession, path: str) -> list[int]:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(jvm_path):
        return []
    done = spark._jvm.org.apache.hadoop.fs.Path
    names = [s.getPath() for s in fs.listStatus(jvm_path)]
    return [int(p.getName()[2:]) for p in names if p.getName().startswith("v=") and fs.exists(done(p, "_SUCCESS"))]


def run_status(errors: Column) -> Column:
    return F.when(errors > 0, "partial").otherwise("success")


def increment(rows: DataFrame, mark: Column, *, at: str, key: str, page: int = 500, after: Column | None = None) -> DataFrame:
    """All rows after the high-water mark with their ``page`` from 1, by instant, then key. With the key that was
    read last (``after``), rows of the mark's instant with a larger key are after the mark too."""
    new = F.col(at) > mark
    if after is not None:
        new |= (F.col(at) == mark) & (F.col(key) > after)
    return numbered(rows.where(new), [at, key]).withColumn("page", F.ceil(F.col("number") / page)).drop("number")


def prefer_json(artifacts: DataFrame) -> DataFrame:
    """Of a company's artifacts (company_id, kind, body) the JSON one, else the HTML one."""
    first = F.min_by(F.struct("*"), F.when(F.col("kind") == "json", 0).otherwise(1))
    return artifacts.groupBy("company_id").agg(first.alias("r")).select("r.*")


def upsert_plan(rows: DataFrame, sink_ids: DataFrame, key: str = "id") -> DataFrame:
    """What a sink must do with each row: update what it has, create what it hasn't."""
    there = sink_ids.select(key).distinct().withColumn("_there", F.lit(True))
    return rows.join(there, key, "left").withColumn("action", F.when(F.col("_there"), "update").otherwise("create")).drop("_there")


def missing_columns(wanted: list[str], present: DataFrame) -> list[str]:
    """Names that a sink's table lacks, whatever their case."""
    have = {c.lower() for c in present.columns}
    return [w for w in wanted if w.lower() not in have]

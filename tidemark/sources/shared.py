"""Tables in the folder that driver and executors share, and numbering that never brings a key into one task."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``). Where none is set, a local session (a test)
    gets a temporary one; a cluster has no such folder, so there it is an error."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = "file://" + tempfile.mkdtemp(prefix="tidemark-")
    return _own[app]


def materialize(df: DataFrame, partition_by: str | None = None, codec: str = "zstd") -> DataFrame:
    """Write df as Parquet into the shared folder and read it back: lineage is cut, and every
    reader sees the same rows even after executors are lost."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tidemark-{uuid.uuid4().hex}"
    writer = df.write.option("compression", codec)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def tasks_for(spark: SparkSession, rows: int, size: int) -> int:
    """How many tasks take ``size`` rows each, one for each core at least: what a task holds doesn't grow with the input."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // size))


def dealt(df: DataFrame, key: str, size: int = 50_000) -> DataFrame:
    """Rows of a stored table dealt over tasks by a key: a file of a few MB is one split, and would be one task with all that follows. Windows,
    groups and joins by the key or by more than it need no further shuffle. (The rows are counted by the file's own figures.)"""
    return df.repartition(tasks_for(df.sparkSession, df.count(), size), key)


def in_blocks(df: DataFrame, by: list[str]) -> DataFrame:
    """df sorted by ``by`` in blocks of about equal numbers of rows, written: column ``block`` numbers them along the order.
    Rows that agree in ``by`` are told apart by their whole content and then by their position, so any number of tied or equal rows is cut
    as well. (Rows that only their position parts are equal: a task that runs again may exchange them.)"""
    known = [c for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
    told = df.withColumn("tie_content", F.xxhash64(*known)).withColumn("tie_row", F.monotonically_increasing_id())
    keys = [*by, "tie_content", "tie_row"]
    return materialize(told.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("block", F.spark_partition_id()).drop("tie_row"))


def block_starts(counts: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Of sums by key and block: what stands before the block, as ``start_`` columns. One row a key and block."""
    before = Window.partitionBy(*keys).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(*keys, "block", *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"start_{c}") for c in columns))


def ranked(df: DataFrame, keys: list[str], order: list[str]) -> tuple[DataFrame, DataFrame]:
    """Number the rows of each key from 1 along ``order``, without bringing a key into one task.

    A range sort cuts the rows into blocks (``in_blocks``); each block counts its rows by key, a prefix sum over the counts
    gives every block its start. Returns (df with ``rank``, the sorted rows). Ties beyond ``order`` go by content."""
    ordered = in_blocks(df, [*keys, *order])
    counts = ordered.groupBy(*keys, "block").agg(F.count("*").alias("n"))
    starts = block_starts(counts, keys, ["n"]).select(*(F.col(k).alias(f"b_{k}") for k in keys), F.col("block").alias("b_block"), F.col("start_n").alias("b_start"))
    within = Window.partitionBy("block", *keys).orderBy(*order, "tie_content")
    same = F.col("block") == F.col("b_block")
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"b_{k}"))
    placed = ordered.withColumn("row", F.row_number().over(within)).join(starts, same)
    rank = (F.col("b_start") + F.col("row")).alias("rank")
    return placed.select(*df.columns, rank), ordered.drop("tie_content")

"""Helpers that the training-data operators share."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.shared import materialize, ranked, shared_dir

__all__ = ["WORD", "bound_batches", "crc_mod", "hot_join", "materialize", "ranked", "shared_dir", "slices", "table", "training_rows"]

#: A word is a run of anything but these blanks.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(id_col: str, m: int) -> Column:
    """crc32 of the id's decimal text, modulo m; a null id gives null."""
    return F.crc32(F.col(id_col).cast("string")) % m


def training_rows(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str,
    *,
    id_col: str,
    modulus: int,
    held_out: int,
    max_rows: int,
) -> DataFrame:
    """(id, text, label) of at most max_rows labelled rows outside the held-out fold, chosen by the
    hash of their id, so the choice doesn't depend on the partitioning. Null ids and null labels
    are left out; an id with several labels takes the largest."""
    chosen = (
        labels.where(F.col(label_col).isNotNull() & (crc_mod(id_col, modulus) != held_out))
        .groupBy(id_col)
        .agg(F.max(label_col).cast("int").alias("label"))
        .orderBy(F.md5(F.col(id_col).cast("string")), id_col)
        .limit(max_rows)
    )
    texts = docs.select(id_col, F.coalesce("text", F.lit("")).alias("text"))
    # max_rows bounds the broadcast side
    return texts.join(F.broadcast(chosen), id_col).dropDuplicates([id_col])


def slices(texts: Sequence[str | None], size: int = 4 << 20) -> Iterator[slice]:
    """Stretches of a batch of at most ``size`` characters, or of one text, so that what a task makes of them at once
    stays small. (An application bounds the batches themselves: ``bound_batches``.)"""
    start = total = 0
    for i, t in enumerate(texts):
        if i > start and total + len(t or "") > size:
            yield slice(start, i)
            start, total = i, 0
        total += len(t or "")
    if start < len(texts):
        yield slice(start, len(texts))


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession, size: str = "4m") -> None:
    """Bound the bytes of an Arrow batch of this session, where nobody has: Spark's own bound, 64 MB, asks for more memory
    than small executors have. For applications (the queries, the pipeline's stages); operators set no options."""
    if spark.conf.get(BATCH_BYTES) in ("67108864b", "64MB"):
        spark.conf.set(BATCH_BYTES, size)


def hot_join(left: DataFrame, right: DataFrame, key: str, *, times: str, total: int, parts: int = 1000) -> DataFrame:
    """Inner join of left with right, which has one row a key and in ``times`` the number of left's rows with that key;
    ``total`` is the number of left's rows. Keys with more than a part of the total, less than ``parts`` of them, are
    broadcast; the others are shuffled, none of which has more than a part. ``times`` is left out."""
    hot = F.broadcast(right.where(F.col(times) * parts > total).drop(times))
    rest = right.where(F.col(times) * parts <= total).drop(times)
    return left.join(hot, key).unionByName(left.join(F.broadcast(hot.select(key)), key, "left_anti").join(rest, key))

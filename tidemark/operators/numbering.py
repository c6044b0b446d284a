"""Row numbers, and windows over long keys, without bringing a table or a key into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.shared import ranked


def numbered(df: DataFrame, order: list[str], name: str = "number") -> DataFrame:
    """df with row numbers from 1 along ``order``, which must be a total order. The sorted rows are written to the shared folder."""
    return ranked(df, [], order)[0].withColumnRenamed("rank", name)


def overlapped(df: DataFrame, place: str, size: int, back: int) -> DataFrame:
    """Rows dealt over blocks of ``size`` along a number ``place``, those within ``back`` of a block's end into the next one too.

    A window over (key, ``_block``) that looks back by ``back`` at most then sees all it needs; rows that are only looked
    back at have ``_own`` false."""
    block = F.floor(F.col(place) / size)
    carried = F.when(F.col(place) - block * size >= size - back, block + 1)
    each = F.array_compact(F.array(block, carried))
    return df.withColumn("_block", F.explode(each)).withColumn("_own", F.col("_block") == block)

"""Mixing sources to target weights by systematic sampling.

Every source gets a share of the corpus by its weight. The targets are found by water-filling: no
source gives more than ``max_repeat`` times its size, and what a capped source can't take is shared
again by weight. Within a source every document expects target / source_size copies; documents are
ordered by size, the expected copies are summed along that order, one random offset is added for
the source, and a document is emitted once for each integer that its step crosses. As the order is
by size, the words taken differ from the target by less than the largest document.

The prefix sum is distributed: a range sort cuts the order into blocks, each block counts its rows
by source, and a prefix sum over the block counts gives each block its start.

Defined results: a null text has size 0; a null source is a source of its own, last in the order of
sources; rows of size 0 take part (their copies add no words); repeated rows are separate steps;
null ids sort first among equals; an empty table gives no rows. Other columns don't matter to
``copies`` and pass through ``mix`` unchanged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, ranked


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def unit_hash(text: Column) -> Column:
    """A number in [0, 1) from the md5 of a text."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def source_targets(
    sized: DataFrame, *, weights: Sequence[int] = (1, 2, 3), max_repeat: int = 3, seed: str = "mix"
) -> DataFrame:
    """One row per source of (mix_source, size): source_size, target, rate, offset.

    The windows over all sources see one row per source, not the documents."""
    per = sized.groupBy("mix_source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    by_name = Window.orderBy(F.col("mix_source").asc_nulls_last())
    weight = F.element_at(
        F.array(*map(F.lit, weights)), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")
    )
    everything = Window.partitionBy()
    per = per.select(
        "*", weight.cast("double").alias("weight"), (F.col("source_size") * float(max_repeat)).alias("cap")
    ).select(
        "*",
        F.sum("source_size").over(everything).cast("double").alias("total"),
        F.sum("weight").over(everything).alias("weights"),
    )
    before = Window.orderBy(F.col("cap") / F.col("weight"), F.col("mix_source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    per = per.select(
        "*",
        F.coalesce(F.sum("cap").over(before), F.lit(0.0)).alias("cap_before"),
        F.coalesce(F.sum("weight").over(before), F.lit(0.0)).alias("weight_before"),
    ).withColumn(
        "capped",
        F.col("cap") * (F.col("weights") - F.col("weight_before"))
        <= (F.col("total") - F.col("cap_before")) * F.col("weight"),
    )
    held = per.select(
        "*",
        F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0.0)).over(everything).alias("cap_taken"),
        F.sum(F.when(F.col("capped"), F.col("weight")).otherwise(0.0)).over(everything).alias("weight_taken"),
    )
    level = (F.col("total") - F.col("cap_taken")) / (F.col("weights") - F.col("weight_taken"))
    target = F.when(F.col("capped"), F.col("cap")).otherwise(
        F.when(F.col("weights") > F.col("weight_taken"), level * F.col("weight")).otherwise(F.lit(0.0))
    )
    return held.select(
        "mix_source",
        "source_size",
        target.alias("target"),
        F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(F.lit(0.0)).alias("rate"),
        unit_hash(F.concat(F.lit(seed + "|"), F.coalesce("mix_source", F.lit("")))).alias("offset"),
    )


def _taken(
    docs: DataFrame, *, id_col: str, text_col: str, source_col: str, weights: Sequence[int], max_repeat: int, seed: str, whole: bool
) -> DataFrame:
    """One row per document: id, mix_source, size, source_size, target, copies, and the document itself if asked for."""
    narrow = docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).alias("mix_source"),
        word_count(F.col(text_col)).alias("size"),
        F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit(""))).alias("h"),
        *([F.struct("*").alias("document")] if whole else []),
    )
    numbered, ordered = ranked(narrow, ["mix_source"], ["size", "h", "id"])
    targets = source_targets(ordered, weights=weights, max_repeat=max_repeat, seed=seed).withColumnRenamed("mix_source", "t_source")
    placed = numbered.join(targets, F.col("mix_source").eqNullSafe(F.col("t_source")))
    step = F.col("rank")
    crossed = F.floor(step * F.col("rate") + F.col("offset")) - F.floor((step - 1) * F.col("rate") + F.col("offset"))
    return placed.select("id", "mix_source", "size", "source_size", "target", crossed.cast("long").alias("copies"), *(["document"] if whole else []))


def plan(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = (1, 2, 3),
    max_repeat: int = 3,
    seed: str = "mix",
) -> DataFrame:
    """One row per document: id, source, size, source_size, target, copies, taken."""
    taken = _taken(docs, id_col=id_col, text_col=text_col, source_col=source_col, weights=weights, max_repeat=max_repeat, seed=seed, whole=False)
    return taken.select(
        F.col("id").alias(id_col), F.col("mix_source").alias(source_col), "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).cast("long").alias("taken"),
    )


def mix(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = (1, 2, 3),
    max_repeat: int = 3,
    seed: str = "mix",
) -> DataFrame:
    """The documents, each repeated as often as the mix takes it, with the columns they came with. A document goes through the
    sort with its number, so rows that agree in id, source and size needn't be told apart afterwards."""
    taken = _taken(docs, id_col=id_col, text_col=text_col, source_col=source_col, weights=weights, max_repeat=max_repeat, seed=seed, whole=True)
    return taken.where("copies > 0").select("document", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).select("document.*")

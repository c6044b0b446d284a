"""Connected components of a link table, by alternating stars, entirely in joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialize


def _with_least(links: DataFrame) -> DataFrame:
    """(u, v, m): every link with the least node among u and its neighbours."""
    least = links.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return links.join(least, "u")


def _large_star(pairs: DataFrame) -> DataFrame:
    """Each neighbour larger than u goes to the least node around u; (u, v) with v < u."""
    both = pairs.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("p")).select("p.*")
    return _with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(large: DataFrame) -> DataFrame:
    """Each neighbour not larger than u, and u, go to the least."""
    to_least = F.explode(F.array(F.col("v"), F.col("u"))).alias("u")
    return _with_least(large).select(to_least, F.col("m").alias("v")).where("u != v").distinct()


def components(links: DataFrame, *, max_rounds: int = 100) -> DataFrame:
    """(node, label) for every node of the links (a, b): label is the least node of its component.

    A round is a large star (each neighbour larger than u goes to the least node around u) and a
    small star (each neighbour not larger than u, and u, go to the least). Each star is written to
    the shared folder, so that its plan names its input twice, however it is made (the driver holds and
    replans it); the loop ends when a round changes nothing, after about log(n) rounds."""
    pairs = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct()
    pairs, before = materialize(pairs), None
    for _ in range(max_rounds):
        pairs = materialize(_small_star(materialize(_large_star(pairs))))
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("the components didn't settle")
    labels = pairs.groupBy("u").agg(F.min("v").alias("label")).select(F.col("u").alias("node"), "label")
    roots = labels.select(F.col("label").alias("node"), "label").distinct()
    return labels.unionByName(roots)

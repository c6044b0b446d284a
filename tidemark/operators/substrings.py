"""Which of many patterns stand in which of many texts, by an index of grams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.shared import materialize


def grams(text, size):
    """The different stretches of ``size`` characters of a text."""
    last = F.length(text) - size + 1
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.when(last >= 1, F.substring(text, i, size))))


def contained(texts: DataFrame, patterns: DataFrame, most: int = 6) -> DataFrame:
    """(text_id, pattern_id) for every pattern (pattern_id, pattern) that stands in a text (text_id, text).

    A pattern is looked up by one gram of at most ``most`` characters: the one that the fewest texts have, so that frequent stretches (``https``)
    don't bring texts and patterns together. Texts give only grams that some pattern has, in the lengths that patterns use (at most ``most`` of them,
    the only thing read on the driver). Pairs that share a gram are compared. Equal patterns are looked up once. Nulls and empty patterns match nothing."""
    texts = texts.where("text IS NOT NULL").select("text_id", "text")
    patterns = materialize(patterns.where("pattern <> ''").select("pattern_id", "pattern"))
    size = F.least(F.length("pattern"), F.lit(most))
    different = patterns.select("pattern").distinct().withColumn("size", size)
    sizes = sorted(r["size"] for r in different.select("size").distinct().collect())
    if not sizes:
        return texts.join(patterns, F.lit(False)).select("text_id", "pattern_id")
    choices = different.select("pattern", F.explode(_by_size(F.col("pattern"), sizes, F.col("size"))).alias("gram"))
    wanted = choices.select("gram").distinct()
    every = texts.select("text_id", F.explode(F.array_compact(F.concat(*(grams(F.col("text"), s) for s in sizes)))).alias("gram"))
    entries = materialize(every.join(wanted, "gram", "left_semi"))
    spread = entries.groupBy("gram").agg(F.count("*").alias("n"))
    anchors = choices.join(spread, "gram", "left").groupBy("pattern").agg(F.min_by("gram", F.struct(F.coalesce("n", F.lit(0)), F.col("gram"))).alias("gram"))
    near = entries.join(anchors, "gram").select("text_id", "pattern").join(texts, "text_id").where(F.contains("text", F.col("pattern")))
    return near.select("text_id", "pattern").join(patterns, "pattern").select("text_id", "pattern_id").distinct()


def _by_size(text, sizes, size):
    """The grams of a text in its own size, one of ``sizes``."""
    out = F
    for s in sizes:
        out = out.when(size == s, grams(text, s))
    return out

"""JSON of any shape: its objects at every depth, and values as loosely as scripts read them."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sources.shared import materialize

OBJECT, ARRAY = "map<string,variant>", "array<variant>"


def with_value(v: Column, use: Callable[[Column], Column]) -> Column:
    """use(v), with v computed once however often it is used."""
    return F.transform(F.array(v), use)[0]


def parsed(text: Column) -> Column:
    """A JSON text as a variant; null if it isn't one value. (Alone, the parser takes what stands before further values, so it reads a list of one.)"""
    one = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))), "$", ARRAY)
    return with_value(one, lambda a: F.when(F.size(a) == 1, a[0]))


def is_missing(v: Column) -> Column:
    """Absent, or JSON's null."""
    return v.isNull() | F.is_variant_null(v)


def first_given(*values: Column) -> Column:
    """The first of the values that isn't missing; else whatever the last one is."""
    return F.coalesce(*(F.when(~F.is_variant_null(v), v) for v in values[:-1]), values[-1])


def string(v: Column) -> Column:
    """A string's value; null for anything else. (Only strings can be read as bytes.)"""
    return F.try_variant_get(v, "$", "binary").cast("string")


def number(v: Column, text: Column) -> Column:
    """The number that a value is or that a string spells; null, blanks and false are 0, true is 1, everything else has no number. ``text`` is the
    value's trimmed ``string``, made in a step before, as it is looked at more than once. It may be beyond a double's range: see ``finite``."""
    number_like = text.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$")
    return F.when(F.is_variant_null(v) | (text == ""), 0.0).when(number_like, text.try_cast("double")).when(text.isNull(), F.try_variant_get(v, "$", "double"))


def finite(n: Column) -> Column:
    return F.abs(n) < float("inf")


def objects(
    df: DataFrame, value: str, keys: list[str], *, hint: Column | None = None, see: Callable[[DataFrame], DataFrame] | None = None,
    through: tuple[str, ...] | None = None, found: str | None = None, places: bool = True, levels: int = 4,
) -> DataFrame:
    """(keys, place, hint, fields): every object in a JSON value, at whatever depth, with its fields as a map.

    ``place`` orders a value's objects as a walk meets them, parents first (an object's fields by name, as variants keep them); without ``places`` there is
    none. ``hint`` goes down from a value to what it holds. With ``through``, only these fields of an object are gone into. ``see(level)`` may look at values
    (``node``) otherwise: it adds what is returned of each instead of ``fields``, as ``met`` (null: nothing), and may replace their hints. What a row
    has in the column ``found``, structs (place, hint, met), is returned, too.

    The walk goes down a level at a time. What it met goes along with a value's first part, and is written with what is left to walk after every ``levels``
    levels, until nothing is left; rows that are no JSON have none."""
    own = [*(["place"] if places else []), "hint"]
    start = [*([F.array().cast("array<int>").alias("place")] if places else []), (F.lit(None).cast("double") if hint is None else hint).alias("hint")]
    level = df.select(*keys, *start, F.col(value).alias("node"), *([F.col(found).alias("so_far")] if found else []))
    what = "met" if see else "fields"
    see = see or (lambda level: level.withColumn("met", F.try_variant_get("node", "$", OBJECT)))

    def below(level: DataFrame) -> DataFrame:
        """The parts of each node, with what was met down to it; one row without a part where it has none."""
        known = F.col("so_far") if "so_far" in level.columns else None
        level = see(level)
        new = F.when(F.col("met").isNotNull(), F.array(F.struct(*own, "met")))
        level = level.select(*keys, *own, "node", (new if known is None else F.when(known.isNull(), new).when(F.col("met").isNull(), known).otherwise(F.concat(known, new))).alias("so_far"))
        level = level.lateralJoin(df.sparkSession.tvf.variant_explode_outer(F.col("node").outer()))
        place = [F.concat("place", F.array("pos")).alias("place")] if places else []
        part = F.when(F.col("key").isNull() | F.col("key").isin(*through), F.col("value")) if through else F.col("value")
        level = level.select(*keys, *place, "hint", part.alias("node"), F.when(F.coalesce("pos", F.lit(0)) == 0, F.col("so_far")).alias("so_far"))
        return level.where("node IS NOT NULL OR so_far IS NOT NULL")

    walked = []
    while True:
        for _ in range(levels):
            level = below(level)
        level = materialize(level)
        walked.append(level.select(*keys, F.inline("so_far")).withColumnRenamed("met", what))
        level = level.where("node IS NOT NULL").drop("so_far")
        if level.isEmpty():
            return reduce(DataFrame.unionByName, walked)

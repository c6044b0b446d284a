"""Text normalisation as columns."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def squeeze(c: Column) -> Column:
    """Runs of white space become one space, ends are trimmed."""
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def slugify(c: Column) -> Column:
    """Lower-case ASCII words joined by hyphens; characters other than words, blanks and hyphens go."""
    kept = F.trim(F.regexp_replace(c, r"[^\w\s-]", ""))
    return F.regexp_replace(F.lower(kept), r"[-\s]+", "-")


@F.pandas_udf(StringType())
def decomposed(c: pd.Series) -> pd.Series:
    """Compatibility decomposition (NFKD), which Spark has no function for."""
    return c.map(lambda s: None if s is None else unicodedata.normalize("NFKD", s))


def slugify_any(c: Column) -> Column:
    """slugify for any script: only texts beyond ASCII pass through Python."""
    return slugify(F.when(c.rlike(r"[^\x00-\x7f]"), decomposed(c)).otherwise(c))


def deterministic_id(c: Column) -> Column:
    return F.concat_ws("-", slugify(c), F.left(F.sha1(c), F.lit(10)))


def text_hash(c: Column) -> Column:
    return F.sha2(F.coalesce(c, F.lit("")), 256)


def split_delimited(c: Column) -> Column:
    """Parts between commas, semicolons and bars, trimmed, without blanks; null if there are none."""
    parts = F.filter(F.transform(F.split(c, r"[,;|]+"), lambda x: F.trim(x)), lambda x: x != "")
    return F.when(F.size(parts) > 0, parts)


def without_tags(c: Column, most: int | None = None) -> Column:
    plain = squeeze(F.regexp_replace(c, r"<[^>]+>", " "))
    return plain if most is None else F.substring(plain, 1, most)


def normalize_keyword(c: Column) -> Column:
    return squeeze(F.lower(c))


def word_set(c: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.lower(c), r"\W+"), lambda x: x != ""))


def employment_code(c: Column) -> Column:
    code = F.regexp_replace(F.lower(F.trim(c)), r"[-\s]+", "_")
    return F.when(code.isin("full_time", "part_time", "contract", "intern"), code).otherwise("full_time")


def string_or_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def number_or_null(c: Column) -> Column:
    return c.try_cast("double")


def title_from_path(path: Column) -> Column:
    """The last path segment as capitalised words."""
    last = F.try_element_at(F.filter(F.split(path, "/"), lambda x: x != ""), F.lit(-1))
    return F.initcap(squeeze(F.regexp_replace(F.regexp_replace(last, r"\.[A-Za-z0-9]+$", ""), r"[-_]+", " ")))


def title_of_link(url: Column) -> Column:
    """The last segment of an address's path as words with large initials; null without one."""
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    last = F.try_element_at(F.filter(F.split(path, "/"), lambda x: x != ""), F.lit(-1))
    words = F.trim(F.regexp_replace(F.regexp_replace(last, r"[-_]+", " "), r"\.[A-Za-z]+$", ""))
    parts = F.regexp_extract_all(words, F.lit(r"(\w+|\W+)"), 1)
    return F.nullif(F.array_join(F.transform(parts, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1 << 30))), ""), F.lit(""))


def render(template: Column, values: dict[str, Column]) -> Column:
    for name, value in values.items():
        template = F.replace(template, F.lit("{" + name + "}"), F.coalesce(value.cast("string"), F.lit("")))
    return template


def placeholders(template: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(template, F.lit(r"\{(\w+)\}"), 1))

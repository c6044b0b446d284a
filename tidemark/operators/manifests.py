"""Manifests of page fixtures: what is wrong with them, what must not be found in them, and how they fare."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import nested
from tidemark.operators import substrings
from tidemark.operators.adapters import HIGH_SIGNAL

# The shapes that a fixture may claim.
SHAPES = ("many-career-path-hrefs", "other", "webflow-dom", "wordpress-careers-ish")


def _field(name: str) -> Column:
    return F.try_element_at(F.col("f"), F.lit(name))


def read(entries: DataFrame) -> DataFrame:
    """Entries (ord, entry as JSON text) with their fields: f as a map, null where an entry is no object; a list has no fields; id where it is a text that isn't blank."""
    e = entries.select("ord", nested.parsed(F.col("entry")).alias("v")).withColumn("kind", F.schema_of_variant("v"))
    f = F.when(F.col("kind").startswith("ARRAY"), F.create_map().cast(nested.OBJECT)).otherwise(F.try_variant_get("v", "$", nested.OBJECT))
    e = e.select("ord", f.alias("f"))
    return e.withColumn("id", F.when(F.trim(nested.string(_field("id"))) != "", nested.string(_field("id"))))


def errors(entries: DataFrame, files: DataFrame, folder: str) -> DataFrame:
    """(ord, error), a row for each thing wrong with an entry (ord, entry); ``files`` (name) are those in ``folder``. Of entries with one id the first
    by ``ord`` has it, later ones are duplicates; equal ids are told apart by a minimum, not by a window over them."""
    e = read(entries)
    owner = e.where("id IS NOT NULL").groupBy("id").agg(F.min("ord").alias("first"))
    there = files.select(F.col("name").alias("n")).distinct()
    e = e.join(owner, "id", "left").join(there, F.col("n") == F.concat("id", F.lit(".html")), "left")
    prefix = F.concat(F.lit("fixtures["), F.col("ord").cast("string"), F.lit("]"))
    say = lambda wrong, *text: F.when(F.coalesce(wrong, F.lit(False)), F.concat(*(F.lit(t) if isinstance(t, str) else t for t in text)))
    kind = lambda v: F.coalesce(F.schema_of_variant(v), F.lit("absent"))
    base, least, never, high = (_field(n) for n in ("base_url", "expected_min_jobs", "must_not_match", "require_high_signal"))
    own = F.col("first") == F.col("ord")
    count = F.when(kind(least).rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)"), F.try_variant_get(least, "$", "double"))
    whole = F.coalesce((count >= 0) & (count == F.floor(count)), F.lit(False))
    listed = F.try_variant_get(never, "$", nested.ARRAY)
    told = F.array(
        say(F.col("id").isNull(), prefix, ".id must be a non-empty string"),
        say(F.col("id").isNotNull() & ~own, "duplicate fixture id: ", F.col("id")),
        say(own & F.col("n").isNull(), 'missing fixture file for id "', F.col("id"), '": ', folder, "/", F.col("id"), ".html"),
        say(~F.coalesce(nested.string(_field("shape")).isin(*SHAPES), F.lit(False)), prefix, ".shape must be one of: " + ", ".join(SHAPES)),
        say(base.isNotNull() & ~F.coalesce(F.trim(nested.string(base)) != "", F.lit(False)), prefix, ".base_url must be a non-empty string when set"),
        say(~whole, prefix, ".expected_min_jobs must be a non-negative integer"),
        say(listed.isNull(), prefix, ".must_not_match must be an array of strings"),
        say(high.isNotNull() & (kind(high) != "BOOLEAN"), prefix, ".require_high_signal must be a boolean when set"),
    )
    items = F.transform(listed, lambda v, j: F.when(kind(v) != "STRING", F.concat(prefix, F.lit(".must_not_match["), j.cast("string"), F.lit("] must be a string"))))
    told = F.when(F.col("f").isNull(), F.array(F.concat(prefix, F.lit(": must be an object")))).otherwise(F.concat(told, F.coalesce(items, F.array().cast("array<string>"))))
    return e.select("ord", F.explode(F.array_compact(told)).alias("error"))


def violations(entries: DataFrame, found: DataFrame) -> DataFrame:
    """(id, url, fragment): found addresses (id, url) in which a fragment stands that the id's entry says must not. Found by the fragments of all entries at
    once, through the index of grams; then only those of the same id count."""
    fragments = read(entries).where("id IS NOT NULL").select("id", F.explode(F.try_variant_get(_field("must_not_match"), "$", nested.ARRAY)).alias("v")).select("id", nested.string(F.col("v")).alias("fragment"))
    fragments = fragments.where("fragment <> ''").distinct()
    patterns = fragments.select(F.col("fragment").alias("pattern_id"), F.col("fragment").alias("pattern")).distinct()
    urls = found.join(fragments.select("id").distinct(), "id", "left_semi").select("id", "url").distinct()
    hits = substrings.contained(urls.select(F.col("url").alias("text_id"), F.col("url").alias("text")).distinct(), patterns)
    hits = hits.select(F.col("text_id").alias("url"), F.col("pattern_id").alias("fragment"))
    return urls.join(hits, "url").join(fragments, ["id", "fragment"]).select("id", "url", "fragment")


def report(entries: DataFrame, decided: DataFrame) -> DataFrame:
    """(shape, n, hits, mismatches, weak) by the shape that a fixture's page has: its fixtures, those with listings, those that claim another shape, and those that
    must have three links to listings but have fewer. decided is (id, shape, adapter, n_links); entries without a page count under a null shape."""
    e = read(entries).where("id IS NOT NULL").select("id", nested.string(_field("shape")).alias("claimed"), F.coalesce(F.try_variant_get(_field("require_high_signal"), "$", "boolean"), F.lit(False)).alias("high"))
    each = e.join(decided.select("id", "shape", "adapter", "n_links"), "id", "left")
    return each.groupBy("shape").agg(
        F.count("*").alias("n"), F.count_if(F.col("adapter").isNotNull()).alias("hits"), F.count_if(~F.col("claimed").eqNullSafe(F.col("shape"))).alias("mismatches"),
        F.count_if(F.col("high") & (F.coalesce("n_links", F.lit(0)) < HIGH_SIGNAL)).alias("weak"),
    )

"""The ordered registry of page adapters, the path by which a page's listings are found, and what the adapters miss."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import classify, urls
from tidemark.functions.numbers import percent
from tidemark.operators import builders, markup, providers
from tidemark.sources.shared import materialize

# The order in which adapters are asked, and the name of the last one, which reads any page.
ORDER, ANY = ("shopify", "greenhouse", "lever", "notion", "wix"), "anchor-job-links"
HIGH_SIGNAL = 3


def any_page(pages: DataFrame) -> DataFrame:
    """Links by region, then JSON-LD, of pages (page_id, url, html) of whatever builder."""
    read = pages.where(~builders.not_html(F.col("html")))
    links = markup.listings(read).select("page_id", F.array(F.lit(0)).alias("place"), F.col("url").alias("link"), "title", F.lit(None).cast("string").alias("description"))
    return builders.merged([links, builders.linked_data(read)])


def registry(pages: DataFrame) -> DataFrame:
    """(page_id, adapter, url, title, description) by the first adapter, in order, whose mark a page has and that finds a listing in it.

    A page leaves by an anti-join on its number once it has a hit, so later adapters never read it. Hits are written, pages aren't: an adapter reads
    its own pages (by mark) from the source. Null texts and pages that aren't HTML have none."""
    found: list[DataFrame] = []

    def left(rows: DataFrame) -> DataFrame:
        done = [f.select("page_id") for f in found]
        return rows.join(reduce(DataFrame.unionByName, done).distinct(), "page_id", "left_anti") if done else rows

    for name in ORDER:
        mine = pages.where(F.col("html").rlike(builders.BUILDERS[name].mark))
        found.append(materialize(builders.listings(left(mine), name).withColumn("adapter", F.lit(name))))
    found.append(any_page(left(pages)).withColumn("adapter", F.lit(ANY)))
    return reduce(DataFrame.unionByName, found).select("page_id", "adapter", "url", "title", "description")


def paths(pages: DataFrame, answers: DataFrame, fallback: bool = False) -> DataFrame:
    """(page_id, path, adapter, n_listings, reason, shape, n_links) for pages (page_id, url, html) and answers (company_id, platform, slug, body): a page with an
    answer is read from that (path json, even if it holds nothing); else what isn't HTML is left; else the registry decides; with ``fallback``, pages without a
    hit that no builder made go to a model. n_listings counts those that aren't placeholders."""
    real = F.count_if(~classify.is_placeholder(F.col("title"), F.col("description")))
    told_json = providers.listings(answers).groupBy(F.col("company_id").alias("page_id")).agg(real.alias("n_json"))
    with_answer = answers.select(F.col("company_id").alias("page_id")).distinct().join(told_json, "page_id", "left").withColumn("json", F.lit(True))
    rest = pages.join(with_answer.select("page_id"), "page_id", "left_anti")
    hits = registry(rest).groupBy("page_id", "adapter").agg(real.alias("n"))
    seen = pages.select("page_id", builders.not_html(F.col("html")).alias("other"), urls.page_shape(F.col("html")).alias("shape"), urls.listing_links(F.col("html")).alias("n_links"))
    every = seen.join(with_answer, "page_id", "left").join(hits, "page_id", "left")
    path: Column = (
        F.when(F.col("json"), "json").when(F.col("other"), "xml_or_sitemap").when(F.col("adapter").isNotNull(), "adapter")
        .when(F.lit(fallback) & (F.col("shape") == "other"), "llm").otherwise("adapter_empty")
    )
    n = F.coalesce(F.when(F.col("json"), F.col("n_json")).otherwise(F.col("n")), F.lit(0))
    return every.select("page_id", path.alias("path"), "adapter", n.alias("n_listings"), F.when(path == "adapter_empty", "adapter_empty").alias("reason"), "shape", "n_links")


def headroom(decided: DataFrame) -> DataFrame:
    """Of pages without an answer (rows of ``paths``): all, hits, misses and coverage, and the misses by shape, with those that hold three
    links to listings or more. One row a shape that is missed; where nothing is missed, no row."""
    html = decided.where("path <> 'json'").select("shape", F.col("adapter").isNotNull().alias("hit"), (F.col("n_links") >= HIGH_SIGNAL).alias("high"))
    whole = html.agg(F.count("*").alias("total"), F.count_if("hit").alias("hits"))
    shapes = html.where("NOT hit").groupBy("shape").agg(F.count("*").alias("misses"), F.count_if("high").alias("high_signal"))
    rows = shapes.join(F.broadcast(whole))  # one row
    missed = F.col("total") - F.col("hits")
    return rows.select("shape", "misses", percent(F.col("misses"), missed).alias("pct_of_misses"), "high_signal", "total", "hits", percent(F.col("hits"), F.col("total")).alias("coverage_pct"))

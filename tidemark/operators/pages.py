"""Listings in pages, by column functions: links that look like listings, and postings in JSON-LD scripts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import urls
from tidemark.functions.text import squeeze

ANCHOR = r"(?is)<a\s[^>]*?href\s*=\s*[\"'][^\"']+[\"'][^>]*>.*?</a>"
SCRIPT = r"(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>"


def anchors(pages: DataFrame) -> DataFrame:
    """(page_id, url, title) of pages (page_id, url, html): links that look like listings and aren't the page of all listings, as seen
    from their page; of the links to one address the first names it."""
    tags = pages.select("page_id", F.col("url").alias("base"), F.posexplode(F.regexp_extract_all("html", F.lit(ANCHOR), 0)).alias("ord", "tag"))
    href = F.trim(F.regexp_extract("tag", r"(?i)href\s*=\s*[\"']([^\"']+)[\"']", 1))
    inner = F.regexp_replace("tag", r"(?i)^<a[^>]*>|</a>$", "")
    title = squeeze(F.regexp_replace(inner, r"<[^>]+>", " "))
    links = tags.where(urls.looks_like_listing(href)).select("page_id", "ord", urls.resolve(href, F.col("base")).alias("url"), title.alias("title"))
    kept = links.where(F.col("url").isNotNull() & ~urls.is_listing_index(urls.path(F.col("url"))))
    return kept.groupBy("page_id", "url").agg(F.min_by("title", "ord").alias("title"))


def _postings(v: Column) -> Column:
    """The objects of a script: itself, an array of them, or those of its graph."""
    many = lambda p: F.try_variant_get(v, p, "array<variant>")
    return F.coalesce(many("$['@graph']"), many("$.itemListElement"), many("$"), F.array(v))


def postings(pages: DataFrame) -> DataFrame:
    """(page_id, title, url) of the job postings in JSON-LD scripts; scripts that aren't JSON have none, one address counts once a page."""
    scripts = pages.select("page_id", F.col("url").alias("base"), F.explode(F.regexp_extract_all("html", F.lit(SCRIPT), 1)).alias("json"))
    items = scripts.select("page_id", "base", F.posexplode(_postings(F.try_parse_json("json"))).alias("ord", "item"))
    get = lambda *paths: F.coalesce(*(F.nullif(F.try_variant_get("item", p, "string"), F.lit("")) for p in paths))
    kinds = F.coalesce(F.try_variant_get("item", "$['@type']", "array<string>"), F.array(get("$['@type']")))
    found = items.where(F.array_contains(kinds, "JobPosting")).select(
        "page_id", "ord", get("$.title", "$.name").alias("title"), urls.resolve(get("$.url", "$.identifier.value"), F.col("base")).alias("url")
    )
    return found.where("url is not null").groupBy("page_id", "url").agg(F.min_by("title", "ord").alias("title")).select("page_id", "title", "url")

"""Queries over running figures, commands, files and manifests."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.operators import adapters, manifests, substrings
from tidemark.plans.adapter_plans import FOUND
from tidemark.plans.adapter_plans import tailed as _pages
from tidemark.plans.model import EVENT_STAGES, EVENTS, events, table
from tidemark.sources import files
from tidemark.sources.shared import shared_dir
from tidemark.streaming import commands, snapshots


def _folder(spark) -> str:
    return f"{shared_dir(spark)}/tidemark-{uuid.uuid4().hex}"


def run_snapshot(spark, sf_dir):
    """The event log followed as a stream; the last snapshot's counts by stage and outcome."""
    path = _folder(spark)
    events(spark, sf_dir).select("seq", "ts", "stage", "outcome").write.parquet(f"{path}/in")
    log = spark.readStream.schema("seq long, ts timestamp, stage string, outcome string").parquet(f"{path}/in")
    snapshots.follow(log, f"{path}/out", EVENT_STAGES).awaitTermination()
    return snapshots.latest(spark, f"{path}/out").select(F.col("last_at").cast("string").alias("last_at"), "total", F.explode("stages").alias("s")).select("last_at", "total", "s.*")


def control_commands(spark, sf_dir):
    """Events as commands: half of them are queued, then all; a reader comes after each."""
    path, state = _folder(spark), _folder(spark)
    stage = F.when(F.col("k") % 5 == 0, "unknown").otherwise(F.col("stage"))
    named = events(spark, sf_dir).select(F.col("seq").cast("string").alias("id"), stage.alias("stage"), F.col("ts").alias("requested_at"), "seq")
    commands.queue(named.where("seq % 2 = 0"), path)
    one = commands.consume(spark, path, state, EVENT_STAGES)
    commands.queue(named, path)
    two = commands.consume(spark, path, state, EVENT_STAGES)
    return one.select(F.lit(1).alias("reader"), "id", "stage").unionByName(two.select(F.lit(2).alias("reader"), "id", "stage"))


#: Endings of what a folder keeps of a page, by the page's number modulo 8.
KEPT = (".html", ".playwright.html", ".json", ".PDF", ".png", ".v2.html", ".careers.html", ".txt")


def _artifacts(spark, sf_dir):
    """Names of files of pages: each page's own, and one of another kind of the page before it."""
    p = table(spark, sf_dir, "pages").select("page_id", F.octet_length("html").cast("long").alias("bytes"))
    kind = F.element_at(F.array(*map(F.lit, KEPT)), (F.col("page_id") % len(KEPT) + 1).cast("int"))
    own = p.select(F.concat(F.lit("c"), F.col("page_id").cast("string"), F.lit(".html")).alias("name"), "page_id", "bytes")
    other = p.select(F.concat(F.lit("c"), (F.col("page_id") - 1).cast("string"), kind).alias("name"), "page_id", "bytes")
    return own.unionByName(other).select(F.concat(F.lit("a"), (F.col("page_id") % 5).cast("string")).alias("folder"), "name", "bytes").distinct()


def canonical_artifacts(spark, sf_dir):
    """pages of folders that are neither kept beside others nor answered by a JSON file."""
    return files.canonical_pages(_artifacts(spark, sf_dir)).select("folder", "id", "bytes")


def input_modes(spark, sf_dir):
    """How each folder is to be read."""
    return files.input_modes(_artifacts(spark, sf_dir))


def substring_hits(spark, sf_dir):
    """Stretches of pages' addresses, short and long, and the addresses that they stand in."""
    p = table(spark, sf_dir, "pages")
    start, size = (F.col("page_id") % 9 + 1).cast("int"), (F.col("page_id") % 11 + 1).cast("int")
    patterns = p.select(F.substring("url", start, size).alias("pattern")).distinct()
    hits = substrings.contained(p.select(F.col("page_id").alias("text_id"), F.col("url").alias("text")), patterns.select(F.col("pattern").alias("pattern_id"), "pattern"))
    return hits.groupBy(F.col("pattern_id").alias("pattern")).agg(F.count("*").alias("n"), F.sum("text_id").alias("ids"))


#: Entries of a manifest, by the page's number modulo 10; # is the number.
ENTRIES = (
    """{"id":"p#","shape":"other","expected_min_jobs":1,"must_not_match":["/jobs/","engineer"],"require_high_signal":true}""", """{"id":"p#","shape":"shopify","base_url":" ","expected_min_jobs":-1,"must_not_match":"x"}""",
    """{"id":" ","shape":"other","expected_min_jobs":1.5,"must_not_match":[1,"a",null],"require_high_signal":1}""", """{"id":"p1","shape":"webflow-dom","base_url":null,"expected_min_jobs":2.0,"must_not_match":["lead"]}""",
    "7", "[1]", """{"id":"gone#","shape":"other","expected_min_jobs":"1","must_not_match":[]}""", "null", """{"id":"p#","shape":"many-career-path-hrefs","expected_min_jobs":0,"must_not_match":[""],"require_high_signal":true}""",
    """{"id":"p#","shape":"other","base_url":"https://x","expected_min_jobs":3,"must_not_match":["site","reliab","/x"],"require_high_signal":false}""",
)


def _entries(spark, sf_dir):
    n, entry = F.col("page_id"), F
    for i, t in enumerate(ENTRIES):
        entry = entry.when(n % len(ENTRIES) == i, F.replace(F.lit(t), F.lit("#"), n.cast("string")))
    return table(spark, sf_dir, "pages").select(n.alias("ord"), entry.alias("entry"))


def manifest_errors(spark, sf_dir):
    """what is wrong with each entry of a manifest of pages."""
    names = table(spark, sf_dir, "pages").select(F.concat(F.lit("p"), F.col("page_id").cast("string"), F.lit(".html")).alias("name"))
    return manifests.errors(_entries(spark, sf_dir), names, "/fixtures")


def _named(df):
    return df.withColumn("id", F.concat(F.lit("p"), F.col("page_id").cast("string")))


def manifest_violations(spark, sf_dir):
    """listings that the adapters find in a fixture although its entry forbids a part of their address."""
    return manifests.violations(_entries(spark, sf_dir), _named(adapters.registry(_pages(spark, sf_dir))))


def manifest_report(spark, sf_dir):
    """Fixtures by the shape that their page has."""
    none = spark.createDataFrame([], "company_id long, platform string, slug string, body string")
    return manifests.report(_entries(spark, sf_dir), _named(adapters.paths(_pages(spark, sf_dir), none)))


_like = ", ".join(f"'{k}'" for k in KEPT)
_arts = f"""a AS (SELECT DISTINCT 'a' || (page_id % 5) AS folder, name, bytes FROM (SELECT page_id, 'c' || page_id || '.html' AS name, strlen(html) AS bytes FROM pages
  UNION ALL SELECT page_id, 'c' || (page_id - 1) || [{_like}][page_id % 8 + 1], strlen(html) FROM pages))"""
_entry = "CASE page_id % 10 " + " ".join("WHEN %d THEN replace('%s', '#', page_id::VARCHAR)" % (i, t.replace("'", "''")) for i, t in enumerate(ENTRIES)) + " END"
_e = f"""e AS (SELECT page_id AS ord, page_id % 10 AS m, 'fixtures[' || page_id || ']' AS x, ({_entry})::JSON AS v FROM pages),
i AS (SELECT *, CASE WHEN trim(v ->> '$.id') <> '' THEN v ->> '$.id' END AS id FROM e)"""
SQL = {
    "run_snapshot": f"""WITH {EVENTS}, s AS (SELECT unnest({list(EVENT_STAGES)}) AS stage), o AS (SELECT unnest({list(snapshots.OUTCOMES)}) AS outcome), c AS (SELECT stage, outcome, count(*) AS n FROM ev GROUP BY 1, 2)
SELECT (SELECT regexp_replace(max(ts)::VARCHAR, '\\.?0+$', '') FROM ev) AS last_at, (SELECT count(*) FROM ev) AS total, stage, outcome, coalesce(n, 0) AS n FROM s CROSS JOIN o LEFT JOIN c USING (stage, outcome)""",
    "control_commands": f"""WITH {EVENTS} SELECT CASE WHEN seq % 2 = 0 THEN 1 ELSE 2 END AS reader, seq::VARCHAR AS id, stage FROM ev WHERE k % 5 <> 0""",
    "canonical_artifacts": f"""WITH {_arts} SELECT folder, name[:-6] AS id, bytes FROM a WHERE name LIKE '%.html' AND len(string_split(name, '.')) = 2
  AND NOT EXISTS (SELECT 1 FROM a b WHERE b.folder = a.folder AND b.name = a.name[:-6] || '.json')""",
    "input_modes": f"""WITH {_arts} SELECT folder, CASE WHEN bool_or(name ILIKE '%.pdf') THEN 'pdf-dir' ELSE 'images' END AS mode, count(*) FILTER (name ILIKE '%.pdf') AS n_pdf, count(*) FILTER (name LIKE '%.png') AS n_image FROM a GROUP BY 1""",
    "substring_hits": """WITH t AS (SELECT DISTINCT substr(url, (page_id % 9 + 1)::INT, (page_id % 11 + 1)::INT) AS pattern FROM pages)
SELECT pattern, count(*) AS n, sum(page_id)::BIGINT AS ids FROM t JOIN pages ON contains(url, pattern) WHERE pattern <> '' GROUP BY 1""",
    "manifest_errors": f"""WITH {_e}, f AS (SELECT id, min(ord) AS own FROM i WHERE id IS NOT NULL GROUP BY 1), n AS (SELECT 'p' || page_id AS n FROM pages),
w AS (SELECT ord, unnest([CASE WHEN m IN (4, 7) THEN x || ': must be an object' END, CASE WHEN m IN (2, 5) THEN x || '.id must be a non-empty string' END, CASE WHEN i.id IS NOT NULL AND own <> ord THEN 'duplicate fixture id: ' || i.id END,
  CASE WHEN own = ord AND n IS NULL THEN 'missing fixture file for id "' || i.id || '": /fixtures/' || i.id || '.html' END, CASE WHEN m IN (1, 5) THEN x || '.shape must be one of: many-career-path-hrefs, other, webflow-dom, wordpress-careers-ish' END,
  CASE WHEN m IN (1, 3) THEN x || '.base_url must be a non-empty string when set' END, CASE WHEN m IN (1, 2, 5, 6) THEN x || '.expected_min_jobs must be a non-negative integer' END,
  CASE WHEN m IN (1, 5) THEN x || '.must_not_match must be an array of strings' END, CASE WHEN m = 2 THEN x || '.must_not_match[0] must be a string' END, CASE WHEN m = 2 THEN x || '.must_not_match[2] must be a string' END,
  CASE WHEN m = 2 THEN x || '.require_high_signal must be a boolean when set' END]) AS error FROM i LEFT JOIN f USING (id) LEFT JOIN n ON n = i.id)
SELECT ord, error FROM w WHERE error IS NOT NULL""",
    "manifest_violations": f"""{FOUND}, {_e}, l AS (SELECT DISTINCT 'p' || page_id AS id, CASE WHEN starts_with(u, '/') THEN regexp_extract(url, '^https?://[^/?#]+', 0, 'i') ELSE '' END || replace(u, '#', page_id::VARCHAR) AS url FROM pages JOIN f ON page_id % 11 = m),
g AS (SELECT DISTINCT id, unnest(CASE m WHEN 0 THEN ['/jobs/', 'engineer'] WHEN 3 THEN ['lead'] WHEN 9 THEN ['site', 'reliab', '/x'] ELSE [] END) AS fragment FROM i WHERE id IS NOT NULL)
SELECT id, url, fragment FROM l JOIN g USING (id) WHERE contains(url, fragment)""",
    "manifest_report": f"""WITH {_e}, s AS (SELECT 'p' || page_id AS id, page_id % 11 AS m, CASE page_id % 11 WHEN 0 THEN 'shopify' WHEN 1 THEN 'shopify' WHEN 2 THEN 'notion-dom' WHEN 4 THEN 'xml-sitemap-not-html' WHEN 5 THEN 'lever-embed-snippet' WHEN 6 THEN 'greenhouse-embed-snippet'
  WHEN 8 THEN 'notion-dom' WHEN 10 THEN 'greenhouse-embed-snippet' ELSE 'other' END AS shape FROM pages)
SELECT s.shape, count(*) AS n, count(*) FILTER (s.m NOT IN (4, 7, 8, 10)) AS hits, count(*) FILTER (v ->> '$.shape' IS DISTINCT FROM s.shape) AS mismatches, count(*) FILTER (i.m IN (0, 8) AND s.m IS DISTINCT FROM 8) AS weak
FROM i LEFT JOIN s USING (id) WHERE id IS NOT NULL GROUP BY 1""",
}
QUERIES = {k: globals()[k] for k in SQL}

"""Queries over the registry of page adapters and the addresses in provider answers."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import adapters, providers
from tidemark.plans.model import jobs, table

#: What is put behind a page, by the page's number modulo 11; # is the number. The sixth has an answer in place of listings.
TAILS = (
    """<link href="https://cdn.shopify.com/s.css"><a href="/pages/field-engineer-#"> Field  <b>Eng</b></a><a href="/pages/careers">c</a><a href="/pages/field-engineer-#">again</a><a href="/products/x">p</a><script type="application/ld+json">{"@type":"JobPosting","title":"LD","url":"/jobs/ld-#"}</script>""",
    """<script src="https://cdn.shopify.com/a.js"></script><a href="/pages/about">a</a><a href="https://boards.greenhouse.io/acme/jobs/#">Ops</a>""",
    """<div id="notion-app"><a href="https://acme.notion.site/site-lead_#"></a><a href="https://acme.notion.site/Careers">c</a><a href="https://www.notion.so/acme/privacy-#">Two</a><a href="/jobs/other-#">o</a></div>""",
    """<main><a href="/careers/lead-#"> Lead </a></main><script type="application/ld+json">[{"@type":"JobPosting","name":"Dup","url":"/careers/lead-#"},{"@type":"JobPosting","name":"Example Job","url":"/jobs/ld-#"}]</script>""",
    """<urlset ><a href="https://boards.greenhouse.io/acme/jobs/#">sitemap</a>""",
    """<a href="https://jobs.lever.co/beta/not-read-#">Not read</a>""",
    """<a href="https://jobs.lever.co/beta/c-#">Lever</a><a href="https://boards.greenhouse.io/acme">board</a>""",
    """<p>no listings here</p>""",
    """<p>see notion.site</p><a href="/jobs/privacy">p</a><a href="/jobs/terms">t</a><a href="/jobs/legal">l</a>""",
    """<div data-wix-x="1"></div><a href="/site-reliability-lead-#"> SRE </a><a href="/about-us">About</a>""",
    """<p>see https://boards.greenhouse.io</p>""",
)
ANSWER = """{"jobs":[{"title":"Nurse #","absolute_url":"https://x/#"},{"title":"Example Job","absolute_url":"https://x/e"}]}"""


def tailed(spark, sf_dir):
    n, tail = F.col("page_id").cast("string"), F.lit("")
    for i, t in enumerate(TAILS):
        tail = F.when(F.col("page_id") % len(TAILS) == i, F.replace(F.lit(t), F.lit("#"), n)).otherwise(tail)
    return table(spark, sf_dir, "pages").select("page_id", "url", F.concat("html", tail).alias("html"))


def _decided(spark, sf_dir, fallback):
    n = F.col("page_id")
    answers = table(spark, sf_dir, "pages").where(n % len(TAILS) == 5).select(
        n.alias("company_id"), F.lit(None).cast("string").alias("platform"), F.lit(None).cast("string").alias("slug"),
        F.when(n % 2 == 0, F.replace(F.lit(ANSWER), F.lit("#"), n.cast("string"))).otherwise("cut off {").alias("body"),
    )
    return adapters.paths(tailed(spark, sf_dir), answers, fallback)


def adapter_listings(spark, sf_dir):
    """Listings of every page by the first adapter that finds one."""
    return adapters.registry(tailed(spark, sf_dir)).select("page_id", "adapter", "url", "title")


def adapter_paths(spark, sf_dir):
    """The path by which each page's listings are found, with a model for pages that nothing else reads."""
    return _decided(spark, sf_dir, True).select("page_id", "path", "adapter", "n_listings", "reason")


def adapter_headroom(spark, sf_dir):
    """What the adapters miss, by the shape of the page."""
    return adapters.headroom(_decided(spark, sf_dir, False))


def provider_addresses(spark, sf_dir):
    """Addresses of a provider's answer for each listing, in the forms of eight providers; every fiftieth answer is cut off."""
    k = F.col("id")
    n = k.cast("string")
    forms = [(p, b) for p, b, _ in ANSWERS]
    body = F
    for i, (_, text) in enumerate(forms):
        body = body.when(k % len(forms) == i, F.replace(F.lit(text), F.lit("#"), n))
    provider = F.element_at(F.array(*(F.lit(p) for p, _ in forms)), (k % len(forms) + 1).cast("int"))
    a = jobs(spark, sf_dir).select(
        k.alias("company_id"), provider.alias("provider"), F.when(k % 3 != 0, "acme").alias("slug"), F.lit("https://Acme.example.org/careers/").alias("base"),
        F.when(k % 50 == 0, "[{").otherwise(body).alias("body"),
    )
    return providers.addresses(a)


#: A provider, its answer, and the addresses in it (those with ~ only for companies with a name at the provider); # is the listing's number.
ANSWERS = (
    ("greenhouse_api", """{"jobs":[{"absolute_url":"","url":"https://b.io:443/Jobs/#/?a=1"},null,{"title":"none"},{"absolute_url":"https://b.io/jobs/#"},{"job_url":"/x#"}]}""", ("https://b.io/jobs/#", "https://acme.example.org/x#")),
    ("lever_api", """[{"hostedUrl":"https://l.co/a/#"},{"applyUrl":"mailto:a@b.c"},{"hosted_url":"https://l.co/b/#"}]""", ("https://l.co/a/#", "https://l.co/b/#")),
    ("ashby_api", """{"jobs":[{"jobUrl":"https://a.co/#","url":"https://a.co/not"}]}""", ("https://a.co/#",)),
    ("workday_api", """{"jobPostings":[{"externalPath":"/job/#"},{"url":"https://w.co/#"}]}""", ("https://acme.example.org/job/#", "https://w.co/#")),
    ("workable_api", """{"results":[{"url":"https://k.co/#"},{"shortcode":"S#"},{"title":"none"}]}""", ("https://k.co/#", "~https://apply.workable.com/acme/j/s#")),
    ("recruitee_api", """{"offers":[{"careers_url":"https://r.co/#"}],"jobs":[{"url":"https://r.co/not"}]}""", ("https://r.co/#",)),
    ("teamtailor_api", """{"data":[{"links":{"careersite-job-url":"https://t.co/#"}},{"url":"deep/#"}]}""", ("https://t.co/#", "https://acme.example.org/careers/deep/#")),
    ("bamboohr_api", """<a href="https://h.co/#"></a><a HREF='/h#'>""", ("https://h.co/#", "https://acme.example.org/h#")),
    ("other_api", """{"jobs":[{"url":"https://o.co/#"}]}""", ()),
)

_root = "regexp_extract(url, '^https?://[^/?#]+', 0, 'i')"
_found = (
    (0, "shopify", "/pages/field-engineer-#", "Field Eng"), (0, "shopify", "/jobs/ld-#", "LD"), (1, "greenhouse", "https://boards.greenhouse.io/acme/jobs/#", "Ops"),
    (2, "notion", "https://acme.notion.site/site-lead_#", "Site Lead #"), (2, "notion", "https://www.notion.so/acme/privacy-#", "Two"), (3, "anchor-job-links", "/careers/lead-#", "Lead"),
    (3, "anchor-job-links", "/jobs/ld-#", "Example Job"), (5, "lever", "https://jobs.lever.co/beta/not-read-#", "Not read"), (6, "lever", "https://jobs.lever.co/beta/c-#", "Lever"),
    (9, "wix", "/site-reliability-lead-#", "SRE"),
)
FOUND = "WITH f(m, adapter, u, t) AS (VALUES " + ", ".join(map(str, _found)) + ")"
PATHS = """CASE page_id % 11 WHEN 5 THEN 'json' WHEN 4 THEN 'xml_or_sitemap' WHEN 7 THEN 'llm' WHEN 8 THEN 'adapter_empty' WHEN 10 THEN 'adapter_empty' ELSE 'adapter' END"""
_answers = ", ".join(f"({i}, '{u.removeprefix('~')}', {u.startswith('~')})" for i, (_, _, us) in enumerate(ANSWERS) for u in us)
SQL = {
    "adapter_listings": f"""{FOUND} SELECT page_id, adapter, CASE WHEN starts_with(u, '/') THEN {_root} ELSE '' END || replace(u, '#', page_id::VARCHAR) AS url, replace(t, '#', page_id::VARCHAR) AS title
FROM pages JOIN f ON page_id % 11 = m""",
    "adapter_paths": f"""{FOUND}, n AS (SELECT m, adapter, count(*) FILTER (t <> 'Example Job') AS n FROM f WHERE m <> 5 GROUP BY 1, 2)
SELECT page_id, {PATHS} AS path, adapter, CASE WHEN page_id % 11 = 5 THEN (page_id % 2 = 0)::BIGINT ELSE coalesce(n, 0) END AS n_listings, CASE WHEN page_id % 11 IN (8, 10) THEN 'adapter_empty' END AS reason
FROM pages LEFT JOIN n ON page_id % 11 = m""",
    "adapter_headroom": """WITH h AS (SELECT page_id % 11 AS m, CASE page_id % 11 WHEN 4 THEN 'xml-sitemap-not-html' WHEN 7 THEN 'other' WHEN 8 THEN 'notion-dom' WHEN 10 THEN 'greenhouse-embed-snippet' END AS shape FROM pages WHERE page_id % 11 <> 5),
w AS (SELECT count(*) AS total, count(*) FILTER (shape IS NULL) AS hits FROM h)
SELECT shape, count(*) AS misses, floor(count(*)::DOUBLE / any_value(total - hits) * 1000 + 0.5) / 10 AS pct_of_misses, count(*) FILTER (m = 8) AS high_signal, any_value(total) AS total, any_value(hits) AS hits,
  floor(any_value(hits)::DOUBLE / any_value(total) * 1000 + 0.5) / 10 AS coverage_pct FROM h, w WHERE shape IS NOT NULL GROUP BY 1""",
    "provider_addresses": f"""WITH a(m, u, named) AS (VALUES {_answers})
SELECT o_orderkey AS company_id, replace(u, '#', o_orderkey::VARCHAR) AS url FROM orders JOIN a ON o_orderkey % {len(ANSWERS)} = m WHERE o_orderkey % 50 <> 0 AND (NOT named OR o_orderkey % 3 <> 0)""",
}
QUERIES = {k: globals()[k] for k in SQL}

"""Queries over provider answers and the listings in pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import pages, providers
from tidemark.plans.model import TITLES, jobs, sql_pick, table


def _answers(spark, sf_dir):
    """An answer of each listing's provider, in the provider's form."""
    j = jobs(spark, sf_dir).select(F.col("id").alias("company_id"), "title", F.concat(F.lit("https://x/"), F.col("id").cast("string")).alias("u"), "relevance", (F.col("id") % 7).alias("m"))
    js = lambda *c: F.to_json(F.struct(*c))
    t, u, r = F.col("title"), F.col("u"), F.col("relevance")
    many = lambda *c: F.array(F.struct(*c))
    body = (
        F.when(F.col("m") == 0, js(many(t.alias("name"), u.alias("absolute_url"), F.struct(r.alias("name")).alias("location")).alias("jobs")))
        .when(F.col("m") == 1, F.to_json(many(t.alias("text"), u.alias("hostedUrl"), F.struct(F.array(r, F.lit("B")).alias("location")).alias("categories"))))
        .when(F.col("m") == 2, js(many(t.alias("title"), u.alias("jobUrl"), r.alias("location"), F.lit("<b>hi</b> ").alias("descriptionHtml")).alias("jobs")))
        .when(F.col("m") == 3, js(many(t.alias("jobTitle"), F.concat(F.lit("/en/job/"), F.col("company_id").cast("string")).alias("externalPath"), F.array(F.lit("a"), r).alias("bulletFields")).alias("jobPostings")))
        .when(F.col("m") == 4, js(many(t.alias("title"), F.lit("S1").alias("shortcode"), F.struct(r.alias("city"), F.lit("X").alias("country")).alias("location")).alias("results")))
        .when(F.col("m") == 5, F.to_json(many(t.alias("title"), u.alias("careers_url"), F.lit(True).alias("remote"), F.lit("perm").alias("kind"))))
        .otherwise(js(many(F.struct(t.alias("title"), r.alias("location")).alias("attributes"), F.struct(u.alias("careersite-job-url")).alias("links")).alias("data")))
    )
    base = F.when(F.col("company_id") % 2 == 0, "https://acme.wd1.myworkdayjobs.com/en-US/Careers?x=1")
    return j.select("company_id", base.alias("base"), F.lit(None).cast("string").alias("platform"), F.lit("acme").alias("slug"), F.when(F.col("company_id") % 50 == 0, "not json").otherwise(body).alias("body"))


def provider_mappers(spark, sf_dir):
    return providers.listings(_answers(spark, sf_dir)).select("company_id", "provider", "title", "url", "location", "employment_type", "description")


def _pages(spark, sf_dir):
    """Pages, and a marked form of every tenth with links to listings and a posting in a script."""
    pages = table(spark, sf_dir, "pages")
    n = F.col("page_id").cast("string")
    marked = pages.where("page_id % 10 = 0").select(
        (-1 - F.col("page_id")).alias("page_id"), "url",
        F.concat("html", F.lit("<main><a href='/careers/lead-"), n, F.lit("'> Lead <b>Eng</b></a><a href='/jobs/'>all</a><a href=\"https://jobs.lever.co/x/"), n, F.lit("#a\">Two</a><a href='/careers/lead-"), n, F.lit("'>again</a></main>"),
                 F.lit("<script type='application/ld+json'>{\"@graph\":[{\"@type\":\"JobPosting\",\"title\":\"Analyst "), n, F.lit("\",\"url\":\"/jobs/a-1\"},{\"@type\":\"Thing\"}]}</script><script type='application/ld+json'>{broken</script>")).alias("html"),
    )
    return pages.select("page_id", "url", "html").unionByName(marked)


def anchor_listings(spark, sf_dir):
    """Links of pages that look like listings, resolved, each address once a page with the text it has first."""
    return pages.anchors(_pages(spark, sf_dir))


def script_listings(spark, sf_dir):
    """Postings in the JSON-LD scripts of pages."""
    return pages.postings(_pages(spark, sf_dir))


PAGES_SQL = r"""WITH p AS (SELECT page_id, url, html FROM pages UNION ALL SELECT -1 - page_id, url, html || '<main><a href=''/careers/lead-' || page_id || '''> Lead <b>Eng</b></a><a href=''/jobs/''>all</a><a href="https://jobs.lever.co/x/' || page_id
  || '#a">Two</a><a href=''/careers/lead-' || page_id || '''>again</a></main>' FROM pages WHERE page_id % 10 = 0) """
SQL = {
    "provider_mappers": f"""WITH j AS (SELECT o_orderkey AS company_id, {sql_pick(TITLES, "o_orderkey")} AS title, 'https://x/' || o_orderkey AS u, o_orderpriority AS r, o_orderkey % 7 AS m
  FROM orders WHERE o_orderkey % 50 <> 0)
SELECT company_id, ['greenhouse', 'lever', 'ashby', 'workday', 'workable', 'recruitee', 'teamtailor'][m + 1] AS provider, title,
  CASE WHEN m = 4 THEN 'https://apply.workable.com/acme/j/S1' WHEN m <> 3 THEN u WHEN company_id % 2 = 0 THEN 'https://acme.wd1.myworkdayjobs.com/en/job/' || company_id END AS url,
  CASE m WHEN 1 THEN r || ' | B' WHEN 3 THEN NULL WHEN 4 THEN r || ', X' WHEN 5 THEN 'Remote' ELSE r END AS location, CASE WHEN m = 5 THEN 'perm' END AS employment_type,
  CASE m WHEN 2 THEN 'hi' WHEN 3 THEN 'a' || chr(10) || r END AS description FROM j""",
    "anchor_listings": PAGES_SQL + r""", a AS (SELECT page_id, url, unnest(regexp_extract_all(html, '<a\s[^>]*?href\s*=\s*["''][^"'']+["''][^>]*>.*?</a>', 0, 'is')) AS tag, generate_subscripts(regexp_extract_all(html, '<a\s[^>]*?href\s*=\s*["''][^"'']+["''][^>]*>.*?</a>', 0, 'is'), 1) AS ord FROM p),
h AS (SELECT page_id, ord, url, trim(regexp_extract(tag, 'href\s*=\s*["'']([^"'']+)["'']', 1, 'i')) AS href, trim(regexp_replace(regexp_replace(regexp_replace(tag, '^<a[^>]*>|</a>$', '', 'gi'), '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')) AS title FROM a),
l AS (SELECT *, CASE WHEN regexp_matches(href, '^https?://', 'i') THEN href WHEN href LIKE '//%' THEN regexp_extract(url, '^[a-z]+:', 0, 'i') || href WHEN href LIKE '/%' THEN regexp_extract(url, '^[a-z]+://[^/?#]+', 0, 'i') || href END AS link FROM h
  WHERE regexp_matches(lower(href), '/(jobs?|careers|career|opportunities|openings|positions|vacancies)(/|$|\?)|/careers[-_][a-z0-9]|/jobs?[-_][a-z0-9]|jobs\.lever\.|greenhouse\.io|myworkdayjobs\.com|ashbyhq\.com|job-position/|/job-opening|/jobposting|[a-z0-9.-]+\.careers/')
    AND NOT regexp_matches(lower(href), '^#|^mailto:|^javascript:|^tel:|linkedin\.com|facebook\.com|instagram\.com')),
k AS (SELECT * FROM l WHERE link IS NOT NULL AND NOT regexp_matches(regexp_replace(lower(regexp_extract(link, '^[a-z]+://[^/?#]+([^?#]*)', 1, 'i')), '/+$', ''), '^/(jobs?|careers|career|opportunities|openings|positions|vacancies)$'))
SELECT page_id, link AS url, arg_min(title, ord) AS title FROM k GROUP BY 1, 2""",
    "script_listings": PAGES_SQL + """SELECT page_id, 'Analyst ' || (-1 - page_id) AS title, regexp_extract(url, '^[a-z]+://[^/?#]+', 0, 'i') || '/jobs/a-1' AS url FROM p WHERE page_id < 0""",
}
QUERIES = {k: globals()[k] for k in SQL}

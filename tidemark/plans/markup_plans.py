"""Queries over the element trees of pages."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import markup
from tidemark.plans.model import table
from tidemark.plans.page_plans import link_test
from tidemark.sources.shared import dealt

#: What is put behind a page, by the page's number modulo 9; ~ is the number.
TAILS = (
    """<header><a href="/jobs/in-header-~">h</a></header><main><!-- <a href="/jobs/hidden">x</a> --><a href='/jobs/one-~'> First <b>one</b></a><a href="/jobs/one-~">again</a><p><a class=x href="/careers/two-~"></a></main><footer><div><a href="/jobs/foot">f</a></div></footer>""",
    """<section><a href="/openings/alone-~">alone</a></section><ul><li><a href="/openings/a-~">A</a></li><li><a href="/openings/b-~">B</a></li></ul><a href="/openings/nowhere">n</a><article><a href="/openings/c-~">C</a><div role="banner"><a href="/openings/banner">x</a></div></article>""",
    """<html data-wf-domain="x"><nav class="w-nav"><a href="/jobs/nav-1">n</a><div class="a w-dyn-item"><a href="/jobs/in-card">card</a></div></nav><div class="w-dyn-list"><a href="/lead-engineer-~">Lead</a><a href="/about-us">About</a><a href="/roles/x~">Role</a><a href="/careers#sec-~">Section</a><a href="/team/x-y">T</a><a href="/single">S</a></div><a href="/lead-designer">no card</a>""",
    """<nav><a href="/jobs/only-~">only in navigation</a></nav>""",
    """<nav><a href="/jobs/n1">1</a><a href="/jobs/n2">2</a><a href="/jobs/n3">3</a></nav><link href="/wp-content/a.css">""",
    """<main><a href="/jobs/privacy">p</a><a href="/jobs/">index</a><a href="mailto:jobs@a.b">m</a><a title="a > b" href="/jobs/quoted-~">quo<i>ted</i></a>""" + f"<a href='/jobs/long-~'>{'long title ' * 12}</a></main>",
    """<ul role="navigation"><li><a href="/openings/role-nav">r</a></ul><ol><li><a href="/openings/x-~">X</a><li><a href="/openings/y-~">Y</a></ol><ol><a href="/openings/z">Z</a></ol>""",
)


def _tailed(spark, sf_dir):
    n, tail = F.col("page_id").cast("string"), F.lit("")
    for i, t in enumerate(TAILS):
        tail = F.when(F.col("page_id") % 9 == i, F.replace(F.lit(t), F.lit("~"), n)).otherwise(tail)
    return dealt(table(spark, sf_dir, "pages"), "page_id", 500).select("page_id", "url", F.concat("html", tail).alias("html"))


#: As above, for profile pages.
PROFILES = (
    """<meta name="description" content="  We make ~ things "><header><nav><a href="/careers?x=~">Careers</a></nav></header>""",
    """<footer><a href="/work"> Join us </a><a href="/careers">now <b>hiring</b></a></footer><nav><a href="jobs">Jobs</a></nav>""",
    """<p>short</p><meta name='description' content=''><a href="https://jobs.example.org/~">~</a><a href="/careers"></a>""",
    "",
)


def _profiles(spark, sf_dir):
    """The first three pages of a site as its profile pages, in their order; every eleventh site has next to no text."""
    n, tail = F.col("page_id").cast("string"), F.lit("")
    for i, t in enumerate(PROFILES):
        tail = F.when(F.col("page_id") % 4 == i, F.replace(F.lit(t), F.lit("~"), n)).otherwise(tail)
    company = F.lower(F.regexp_extract("url", r"^https?://([^/?#:]+)", 1))
    small = F.length(company) % 11 == 0
    html = F.when(small, F.concat(F.lit("<p>hi</p>"), tail)).otherwise(F.concat("html", tail))
    pages = table(spark, sf_dir, "pages").select(company.alias("company"), "page_id", "url", html.alias("html"))
    pages = pages.withColumn("ord", F.row_number().over(Window.partitionBy("company").orderBy("page_id")))
    return pages.where("ord <= 3")


def region_listings(spark, sf_dir):
    return markup.listings(_tailed(spark, sf_dir))


def careers_hints(spark, sf_dir):
    return markup.careers_hints(_profiles(spark, sf_dir))


def profile_descriptions(spark, sf_dir):
    return markup.descriptions(_profiles(spark, sf_dir))


def _values(tails, n):
    cases = " ".join("WHEN %d THEN replace('%s', '~', page_id::VARCHAR)" % (i, t.replace("'", "''")) for i, t in enumerate(tails))
    return f"CASE page_id % {n} {cases} ELSE '' END"


_attr = lambda tag, name: f"""CASE WHEN regexp_matches({tag}, '\\s{name}\\s*=', 'is') THEN concat(regexp_extract({tag}, '\\s{name}\\s*=\\s*(?:"([^"]*)"|''([^'']*)''|([^\\s"''>]+))', 1, 'is'),
  regexp_extract({tag}, '\\s{name}\\s*=\\s*(?:"([^"]*)"|''([^'']*)''|([^\\s"''>]+))', 2, 'is'), regexp_extract({tag}, '\\s{name}\\s*=\\s*(?:"([^"]*)"|''([^'']*)''|([^\\s"''>]+))', 3, 'is')) END"""  # noqa: E731
_tree = f"""h AS (SELECT page_id, regexp_extract_all(regexp_replace(html, '<!--.*?-->|<script\\b.*?</script>|<style\\b.*?</style>|<noscript\\b.*?</noscript>', '', 'gis'), '</?[A-Za-z](?:[^>"'']+|"[^"]*"|''[^'']*'')*>|[^<]+|<') AS x FROM p),
t AS (SELECT page_id, unnest(x) AS token, generate_subscripts(x, 1) AS ord FROM h),
n AS (SELECT *, nullif(lower(regexp_extract(token, '^</?([A-Za-z][^\\s/>]*)', 1)), '') AS name, CASE WHEN starts_with(token, '</') THEN -1 ELSE 1 END AS step FROM t),
l AS (SELECT *, sum(step) OVER (PARTITION BY page_id, name ORDER BY ord) + (step < 0)::INT AS level FROM n
  WHERE name IS NOT NULL AND name NOT IN ('area', 'base', 'br', 'col', 'embed', 'hr', 'img', 'input', 'link', 'meta', 'param', 'source', 'track', 'wbr')),
e AS (SELECT page_id, ord, name, token, coalesce(lead_ord, 1099511627776) AS fin FROM (SELECT *, lead(ord) OVER (PARTITION BY page_id, name, level ORDER BY ord) AS lead_ord FROM l) WHERE step = 1),
g AS (SELECT e.page_id, e.ord, e.fin, least(fin, coalesce(lead(e.ord) OVER (PARTITION BY page_id, name ORDER BY ord), 1099511627776)) AS stop, e.name, {_attr("token", "href")} AS href FROM e WHERE name IN ('a', 'p')),
w AS (SELECT g.page_id, g.ord, any_value(name) AS name, any_value(href) AS href, trim(regexp_replace(coalesce(string_agg(token, '' ORDER BY t.ord) FILTER (NOT regexp_matches(token, '^</?[A-Za-z]')), ''), '\\s+', ' ', 'g')) AS text
  FROM g LEFT JOIN t ON t.page_id = g.page_id AND t.ord > g.ord AND t.ord < g.stop GROUP BY 1, 2),
"""


def _resolved(u, base):
    root = f"regexp_extract({base}, '^https?://[^/?#]+', 0, 'i')"
    folder = f"coalesce(nullif(regexp_extract({base}, '^https?://[^/?#]+([^?#]*/)', 1, 'i'), ''), '/')"
    return f"""CASE WHEN regexp_matches({u}, '^https?://', 'i') THEN {u} WHEN regexp_matches({u}, '^[a-z][a-z0-9+.-]*:', 'i') THEN NULL WHEN starts_with({u}, '/') THEN {root} || {u} ELSE {root} || {folder} || {u} END"""


_WORDS = "jobs?|careers|career|opportunities|openings|positions|vacancies"
_DENIED = "privacy|privacy-policy|terms|terms-of-use|terms-and-conditions|contact|blog|press|legal"
_NOCARD = "about|about-us|contact|company|team|culture|blog|news|press|events|resources|resource|pricing|faq|login|sign-in|signup|sign-up|legal|privacy|terms"
_SEGMENT = "list_filter(string_split(path, '/'), lambda x: x <> '')"
_title = """array_to_string(list_transform(regexp_extract_all(trim(regexp_replace(regexp_replace(list_filter(string_split(path, '/'), lambda x: x <> '')[-1], '[-_]+', ' ', 'g'), '\\.[A-Za-z]+$', '')), '[A-Za-z0-9_]+|[^A-Za-z0-9_]+'), lambda w: upper(w[1]) || w[2:]), '')"""
SQL = {
    "region_listings": f"""WITH p AS (SELECT page_id, url AS base, html || {_values(TAILS, 9)} AS html FROM pages),
{_tree}
c AS (SELECT *, regexp_matches(html, 'data-wf-domain', 'i') AS webflow, len(list_filter(regexp_extract_all(html, 'href\\s*=\\s*["'']([^"'']+)["'']', 1, 'i'), lambda x: {link_test("regexp_replace(x, '#.*', '')")})) AS n_links,
  len(regexp_extract_all(html, 'href\\s*=\\s*["''][^"'']*/(?:jobs?|careers)(?:/|[-_]|["''])', 0, 'i')) AS career FROM p),
r AS (SELECT page_id, ord, fin, name IN ('header', 'footer', 'nav') OR coalesce(lower({_attr("token", "role")}), '') IN ('navigation', 'banner', 'contentinfo') OR list_contains(string_split({_attr("token", "class")}, ' '), 'w-nav') AS chrome,
  len(list_intersect(string_split({_attr("token", "class")}, ' '), ['w-dyn-item', 'w-dyn-list', 'w-dyn-items'])) > 0 AS card, name IN ('main', 'article') OR {_attr("token", "role")} = 'main' AS main, name IN ('section', 'ul', 'ol') AS block FROM e),
a AS (SELECT w.page_id, w.ord, any_value(trim(href)) AS href, any_value(text) AS text, coalesce(bool_or(chrome), false) AS chrome, coalesce(bool_or(card), false) AS card, max(r.ord) FILTER (main) AS main, max(r.ord) FILTER (block) AS block
  FROM w LEFT JOIN r ON r.page_id = w.page_id AND r.ord < w.ord AND w.ord < r.fin WHERE w.name = 'a' AND href IS NOT NULL GROUP BY 1, 2),
b AS (SELECT a.*, c.* EXCLUDE (page_id), {_resolved("href", "base")} AS link FROM a JOIN c USING (page_id)),
d AS (SELECT *, regexp_extract(link, '^https?://[^/?#]+([^?#]*)', 1, 'i') AS path, regexp_replace(lower(regexp_extract(link, '^https?://[^/?#]+([^?#]*)', 1, 'i')), '/+$', '') AS low, regexp_replace(lower(href), '#.*', '') AS shown FROM b WHERE link IS NOT NULL),
f AS (SELECT *, webflow AND card AND shown <> '' AND low <> '' AND NOT regexp_matches(shown, '^mailto:|^javascript:|^tel:|(^|/)(about|contact|privacy|legal|terms|blog|resource|resources|company)(/|$)') AND
  CASE WHEN regexp_matches(low, '^/({_WORDS})$') THEN regexp_matches(href, '/(jobs?|careers?)(/)?#.+', 'i')
    WHEN regexp_matches(low, '(^|/)(about|contact|privacy|legal|terms|blog|resource|resources|company)(/|$)') THEN false
    WHEN len({_SEGMENT}) >= 2 THEN NOT regexp_matches(low, '^/({_NOCARD})/') AND regexp_matches(low, '^/[^/]*(jobs?|careers?|positions|openings|opportunities|vacancies)[^/]*/|^/(roles?|postings?)/')
    ELSE NOT regexp_matches(low, '^/({_NOCARD})$') AND regexp_matches(low, '^/[a-z0-9]+(-[a-z0-9]+)+$') END AS carded FROM d),
k AS (SELECT *, NOT chrome OR webflow AND card AS outside FROM f WHERE ({link_test("shown")} OR carded) AND (contains(html, CASE path WHEN '' THEN '/' ELSE path END) OR contains(html, link))
  AND NOT regexp_matches(low, '/({_DENIED})(\\.[a-z0-9]+)?(/|$)') AND (NOT regexp_matches(low, '^/({_WORDS})$') OR carded AND regexp_matches(link, '#.'))),
s AS (SELECT page_id, link, arg_min(text, ord) AS text, any_value(path) AS path, arg_min(struct_pack(m := main, b := block), ord) AS roots,
  bool_or(career < 4 AND n_links >= 3 AND NOT webflow AND NOT regexp_matches(html, 'greenhouse\\.io|lever\\.co|myworkdayjobs|notion|shopify') AND NOT (career >= 2 AND regexp_matches(html, 'wp-content|wordpress', 'i'))) AS dense FROM k WHERE outside GROUP BY 1, 2),
q AS (SELECT *, count(*) OVER (PARTITION BY page_id, coalesce(roots.m, roots.b)) AS n FROM s),
o AS (SELECT page_id, link, text, path FROM q WHERE NOT dense OR roots.m IS NOT NULL OR roots.b IS NOT NULL AND n >= 2),
z AS (SELECT * FROM o UNION ALL SELECT page_id, link, arg_min(text, ord), any_value(path) FROM k WHERE NOT webflow AND (n_links < 3 OR regexp_matches(html, 'wp-content|wordpress', 'i')) AND page_id NOT IN (SELECT page_id FROM o) GROUP BY 1, 2)
SELECT page_id, link AS url, coalesce(CASE WHEN length(text) > 120 THEN text[:117] || '...' ELSE nullif(text, '') END, {_title}) AS title FROM z""",
    "careers_hints": f"""WITH s AS (SELECT lower(regexp_extract(url, '^https?://([^/?#:]+)', 1)) AS company, page_id, url, html, {_values(PROFILES, 4)} AS tail FROM pages),
v AS (SELECT company, page_id, url AS base, CASE WHEN length(company) % 11 = 0 THEN '<p>hi</p>' ELSE html END || tail AS html, row_number() OVER (PARTITION BY company ORDER BY page_id) AS no FROM s),
p AS (SELECT * FROM v WHERE no <= 3),
{_tree}
a AS (SELECT w.page_id, w.ord, any_value(href) AS href, any_value(text) AS text, CASE WHEN bool_or(r.name = 'header') THEN 'header' WHEN bool_or(r.name = 'footer') THEN 'footer' WHEN bool_or(r.name = 'nav') THEN 'nav' ELSE 'body' END AS location
  FROM w LEFT JOIN e r ON r.page_id = w.page_id AND r.name IN ('header', 'footer', 'nav') AND r.ord < w.ord AND w.ord < r.fin WHERE w.name = 'a' AND href IS NOT NULL GROUP BY 1, 2),
c AS (SELECT company, no, ord, {_resolved("href", "base")} AS url, coalesce(nullif(text, ''), href) AS text, location FROM a JOIN p USING (page_id)
  WHERE regexp_matches(href, 'careers?|jobs?|join[- ]us|work[- ]with[- ]us|hiring|open[- ]roles', 'i') OR regexp_matches(text, 'careers?|jobs?|join[- ]us|work[- ]with[- ]us|hiring|open[- ]roles', 'i'))
SELECT company, url, first(text ORDER BY no, ord) AS text, first(location ORDER BY no, ord) AS location FROM c WHERE url IS NOT NULL GROUP BY 1, 2""",
    "profile_descriptions": f"""WITH s AS (SELECT lower(regexp_extract(url, '^https?://([^/?#:]+)', 1)) AS company, page_id, url, html, {_values(PROFILES, 4)} AS tail FROM pages),
v AS (SELECT company, page_id, url AS base, CASE WHEN length(company) % 11 = 0 THEN '<p>hi</p>' ELSE html END || tail AS html, row_number() OVER (PARTITION BY company ORDER BY page_id) AS no FROM s),
p AS (SELECT * FROM v WHERE no <= 3),
{_tree}
m AS (SELECT page_id, nullif(trim(arg_min({_attr("token", "content")}, ord)), '') AS meta FROM n WHERE name = 'meta' AND {_attr("token", "name")} = 'description' GROUP BY 1),
g2 AS (SELECT page_id, arg_min(text, ord) AS paragraph FROM w WHERE name = 'p' AND length(text) > 80 GROUP BY 1),
b AS (SELECT page_id, strlen(trim(regexp_replace(string_agg(token, '' ORDER BY ord) FILTER (name IS NULL), '\\s+', ' ', 'g'))) AS size FROM n GROUP BY 1)
SELECT company, first(coalesce(meta, paragraph) ORDER BY no) FILTER (coalesce(meta, paragraph) IS NOT NULL) AS description, max(coalesce(size, 0)) < 200 AS render
FROM p LEFT JOIN m USING (page_id) LEFT JOIN g2 USING (page_id) LEFT JOIN b USING (page_id) GROUP BY 1""",
}
QUERIES = {k: globals()[k] for k in SQL}

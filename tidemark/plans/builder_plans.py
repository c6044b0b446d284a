"""Queries over listings in the script JSON of site builders' pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import builders
from tidemark.plans.model import table

#: What is put behind a page, by the page's number modulo 7; # is the number.
TAILS = (
    """<a href="https://boards.greenhouse.io/acme/jobs/#">Lead <b>Eng</b> </a><a href='https://boards.greenhouse.io/acme'>all</a><script type="application/json">{"a":{"jobs":[{"absolute_url":"https://boards.greenhouse.io/acme/jobs/#","title":"Dup"},{"absolute_url":"https://boards.greenhouse.io/acme/jobs/1#","name":" Data   Eng ","content":"c#"},{"absolute_url":7},[{"deep":{"absolute_url":"https://boards.greenhouse.io/acme/jobs/2#-fine_role","title":8}}]]}}</script><script>var a = {"absolute_url":"https://boards.greenhouse.io/x/jobs/3"}</script>""",
    """<script type="application/json">[{"hostedUrl":"https://jobs.lever.co/beta/a-#","text":"One"},{"hosted_url":"","applyUrl":"https://jobs.lever.co/beta/b-#/apply","title":"","name":"Two","descriptionPlain":"plain"},{"hostedUrl":"https://jobs.lever.co/beta","text":"board"}]</script><a href="https://jobs.lever.co/beta/c-#"></a>""",
    """<div data-wix-x="1"></div><a href="/site-reliability-lead-#"> SRE </a><a href="/about-us">About</a><a href="mailto:a@b.c">m</a><script>{"menu":[{"link":"/job/wix-#","title":" Wix  Role ","description":"d"},{"jobUrl":"/careers"},{"pages":{"one":{"postingUrl":"https://else.example.org/x/y","url":"/positions/p-#"}}}]}</script>""",
    """<p>see https://boards.greenhouse.io</p><script type="application/ld+json">{"@graph":[{"@type":["Thing","JobPosting"],"title":"Graph","url":{"@id":"/jobs/graph-#"}},{"@type":"ItemList","itemListElement":[{"item":{"@type":"JobPosting","identifier":[{"value":"x"},{"value":"/jobs/id-#"}],"description":"ld"}}]},{"@type":"WebPage","mainEntity":[{"@type":"JobPosting","name":"Main","mainEntityOfPage":"/jobs/main-#"}],"about":{"@type":"JobPosting","url":"/jobs/not-reached"}},{"@type":"JobPosting","title":"Index","url":"/jobs/"}]}</script>""",
    """<?xml <urlset > greenhouse.io <a href="https://boards.greenhouse.io/acme/jobs/5">sitemap</a>""",
)


def _pages(spark, sf_dir):
    n = F.col("page_id").cast("string")
    tail = F.lit("")
    for i, t in enumerate(TAILS):
        tail = F.when(F.col("page_id") % 7 == i, F.replace(F.lit(t), F.lit("#"), n)).otherwise(tail)
    return table(spark, sf_dir, "pages").select("page_id", "url", F.concat("html", tail).alias("html"))


def greenhouse_listings(spark, sf_dir):
    """Links to boards, objects with absolute_url at any depth, JSON-LD."""
    return builders.listings(_pages(spark, sf_dir), "greenhouse")


def lever_listings(spark, sf_dir):
    """Links to postings, objects with hostedUrl or its like, JSON-LD."""
    return builders.listings(_pages(spark, sf_dir), "lever")


def wix_listings(spark, sf_dir):
    """Links to postings, and any field of an object whose name is that of an address."""
    return builders.listings(_pages(spark, sf_dir), "wix")


_cases = " ".join("WHEN %d THEN replace('%s', '#', page_id::VARCHAR)" % (i, t.replace("'", "''")) for i, t in enumerate(TAILS))
PAGES = f"""WITH RECURSIVE p AS (SELECT page_id, url AS base, html || CASE page_id % 7 {_cases} ELSE '' END AS html FROM pages),
a AS (SELECT page_id, base, html, unnest(regexp_extract_all(html, '<a\\s[^>]*?href\\s*=\\s*["''][^"'']+["''][^>]*>.*?</a>', 0, 'is')) AS tag,
  generate_subscripts(regexp_extract_all(html, '<a\\s[^>]*?href\\s*=\\s*["''][^"'']+["''][^>]*>.*?</a>', 0, 'is'), 1) AS ord FROM p),
s AS (SELECT page_id, base, html, unnest(regexp_extract_all(html, '<script[^>]*>(.*?)</script>', 1, 'is')) AS j, generate_subscripts(regexp_extract_all(html, '<script[^>]*>(.*?)</script>', 1, 'is'), 1) AS ord FROM p),
t AS (SELECT s.page_id, s.base, s.html, s.ord, e.id, e.value AS v FROM (SELECT * FROM s WHERE json_valid(trim(j))) s, json_tree(trim(s.j)) e WHERE e.type = 'OBJECT'),
ls AS (SELECT page_id, base, html, unnest(regexp_extract_all(html, '<script[^>]*type\\s*=\\s*["'']application/ld\\+json["''][^>]*>(.*?)</script>', 1, 'is')) AS j FROM p),
ln(page_id, base, html, path, v) AS (SELECT page_id, base, html, '', j::JSON FROM ls WHERE json_valid(trim(j))
  UNION ALL SELECT page_id, base, html, path || '/' || k, w FROM (SELECT page_id, base, html, path, unnest(CASE json_type(v) WHEN 'ARRAY' THEN json_extract(v, '$[*]')
    ELSE list_filter([v -> '$."@graph"', v -> '$.itemListElement', v -> '$.item', v -> '$.mainEntity'], lambda x: x IS NOT NULL) END) AS w,
    unnest(range(20)[:CASE json_type(v) WHEN 'ARRAY' THEN json_array_length(v) ELSE 4 END]) AS k FROM ln WHERE json_type(v) IN ('ARRAY', 'OBJECT')) WHERE w IS NOT NULL),
lj AS (SELECT *, coalesce(v ->> '$.url."@id"', CASE WHEN json_type(v, '$.url') = 'VARCHAR' THEN v ->> '$.url' END, list_filter(json_extract_string(v, '$.identifier[*].value'), lambda x: starts_with(x, '/'))[1], v ->> '$.mainEntityOfPage') AS raw FROM ln
  WHERE json_type(v) = 'OBJECT' AND CASE json_type(v, '$."@type"') WHEN 'ARRAY' THEN list_contains(json_extract_string(v, '$."@type"[*]'), 'JobPosting') ELSE v ->> '$."@type"' = 'JobPosting' END),
"""


def _resolved(u: str) -> str:
    root = "regexp_extract(base, '^https?://[^/?#]+', 0, 'i')"
    return f"""CASE WHEN regexp_matches({u}, '^https?://', 'i') THEN {u} WHEN regexp_matches({u}, '^[a-z][a-z0-9+.-]*:', 'i') THEN NULL WHEN starts_with({u}, '/') THEN {root} || {u} END"""


_title = """array_to_string(list_transform(regexp_extract_all(trim(regexp_replace(regexp_replace(list_filter(string_split(regexp_extract(link, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/'), lambda x: x <> '')[-1], '[-_]+', ' ', 'g'), '\\.[A-Za-z]+$', '')), '[A-Za-z0-9_]+|[^A-Za-z0-9_]+'), lambda w: upper(w[1]) || w[2:]), '')"""
_path = "regexp_extract(link, '^[a-z]+://[^/?#]*([^?#]*)', 1)"


def _sql(mark, posting, raw, title, description, wide, linked):
    """The rule of a builder: links, objects of scripts, JSON-LD; the first of an address stands."""
    index = r"regexp_matches(lower(regexp_replace(" + _path + r", '/+$', '')), '^/(jobs?|careers|career|opportunities|openings|positions|vacancies)$')"
    return PAGES + f"""f AS (
  SELECT page_id, base, html, 0 AS kind, ord, 0 AS sub, h AS raw, CASE WHEN length(x) > 120 THEN x[:117] || '...' ELSE nullif(x, '') END AS title, CAST(NULL AS VARCHAR) AS description FROM (
    SELECT *, trim(regexp_extract(tag, 'href\\s*=\\s*["'']([^"'']+)["'']', 1, 'i')) AS h, trim(regexp_replace(regexp_replace(regexp_replace(tag, '^<a[^>]*>|</a>$', '', 'gi'), '<[^>]+>', '', 'g'), '\\s+', ' ', 'g')) AS x FROM a) WHERE NOT starts_with(h, '#')
  UNION ALL SELECT page_id, base, html, 1, ord, id, {raw}, nullif({'trim' if wide else ''}(substr(trim(regexp_replace({title}, '\\s+', ' ', 'g')), 1, 120)), ''), substr({description}, 1, 500) FROM t
  {"UNION ALL SELECT page_id, base, html, 2, 0, 0, raw, coalesce(v ->> '$.title', v ->> '$.name'), v ->> '$.description' FROM lj" if linked else ""}),
g AS (SELECT *, {_resolved("raw")} AS link FROM f WHERE raw IS NOT NULL AND regexp_matches(html, '{mark}', 'i') AND NOT regexp_matches(html, '<urlset\\s', 'i')),
k AS (SELECT *, {_path} AS path FROM g WHERE link IS NOT NULL AND CASE WHEN kind = 2 THEN NOT {index} ELSE {posting} END AND (contains(html, raw) OR contains(html, link) OR contains(html, {_path}) AND kind <> 1))
SELECT page_id, link AS url, first(coalesce(title, {_title}) ORDER BY kind, ord, sub) AS title, first(description ORDER BY kind, ord, sub) AS description FROM k GROUP BY page_id, link"""


_text = lambda *names: "coalesce(" + ", ".join(f"nullif(CASE WHEN json_type(v, '$.{n}') = 'VARCHAR' THEN v ->> '$.{n}' END, '')" for n in names) + ")"
_host = "regexp_extract(link, '^[a-z]+://([^/?#:]+)', 1, 'i')"
SQL = {
    "greenhouse_listings": _sql(r"greenhouse\.io", rf"{_host} LIKE '%greenhouse.io' AND (regexp_matches({_path}, '/jobs/[0-9]+') OR regexp_matches(link, '[?&]gh_jid='))", _text("absolute_url"), _text("title", "name"), _text("content"), False, True),
    "lever_listings": _sql(r"lever\.co|jobs\.lever", rf"{_host} LIKE '%lever.co' AND len(list_filter(string_split({_path}, '/'), lambda x: x <> '')) >= 2", _text("hostedUrl", "hosted_url", "applyUrl"), _text("text", "title", "name"), _text("descriptionPlain"), False, True),
    "wix_listings": _sql(
        r"static\.wixstatic\.com|parastorage\.com|data-wix-|wix-warmup-data|wix-code",
        rf"""regexp_matches({_path}, '/(job|jobs|position|positions|opening|openings|vacancy|vacancies|career-opportunities)\b', 'i')
          AND NOT regexp_matches(lower(regexp_replace({_path}, '/+$', '')), '^/(jobs?|careers|career|opportunities|openings|positions|vacancies)$')
        OR {_host} = regexp_extract(base, '^[a-z]+://([^/?#:]+)', 1, 'i') AND len(list_filter(string_split({_path}, '/'), lambda x: x <> '')) < 2 AND {_path} <> ''
          AND NOT regexp_matches(lower({_path}), '^/(jobs?|careers|career|opportunities|openings|positions|vacancies)/*$')
          AND (contains({_path}, '-') AND NOT regexp_matches({_path}, 'privacy|terms|cookie|about|contact|legal|policy|disclaimer|settings', 'i')
            OR regexp_matches({_path}, 'engineer|developer|manager|intern|technician|specialist|analyst|operator|designer|director|consultant|architect', 'i'))
        OR {_host} = regexp_extract(base, '^[a-z]+://([^/?#:]+)', 1, 'i') AND len(list_filter(string_split({_path}, '/'), lambda x: x <> '')) >= 2 AND regexp_matches({_path}, 'careers|career|opportunities|openings|vacancies', 'i')""",
        "unnest(list_filter(list_transform(json_keys(v), lambda k: CASE WHEN regexp_matches(k, '(url|link)$', 'i') THEN json_extract_string(v, '$.\"' || k || '\"') END), lambda x: x IS NOT NULL))",
        _text("title", "name", "role"), _text("description"), True, False,
    ),
}
QUERIES = {k: globals()[k] for k in SQL}

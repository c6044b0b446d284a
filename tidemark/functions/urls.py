"""URLs as columns: normal form, signatures, platforms and page paths."""

from __future__ import annotations

from functools import reduce
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

_PARTS = r"^(?i:(https?))://(?:[^/?#@]*@)?([^/?#:]+)(?::\d+)?([^?#]*)"

# Marks of applicant systems in a page and in a url, in order of precedence.
PAGE_MARKS = (
    ("greenhouse", r"boards\.greenhouse\.io|greenhouse-io|id\s*=\s*\"grnhse_app\""),
    ("lever", r"jobs\.lever\.co"),
    ("ashby", r"jobs\.ashbyhq\.com|ashby-job-posting"),
    ("workday", r"myworkdayjobs\.com"),
    ("rippling", r"app\.rippling\.com/jobs|rippling-ats"),
    ("jobvite", r"jobs\.jobvite\.com|jobvite-widget"),
    ("icims", r"icims\.com|careers\.icims"),
    ("smartrecruiters", r"jobs\.smartrecruiters\.com|smartrecruiters-widget"),
    ("workable", r"apply\.workable\.com"),
    ("recruitee", r"\.recruitee\.com"),
    ("teamtailor", r"teamtailor\.com"),
    ("bamboohr", r"\.bamboohr\.com"),
)
URL_MARKS = (
    ("greenhouse", r"greenhouse\.io"),
    ("lever", r"jobs\.lever\.co"),
    ("ashby", r"ashby\.com"),
    ("workday", r"myworkdayjobs\.com"),
    ("icims", r"icims\.com"),
)
# Path segments of pages that are no listings.
DENIED_SEGMENTS = ("privacy", "privacy-policy", "terms", "terms-of-use", "terms-and-conditions", "contact", "blog", "press", "legal")
LISTING_WORDS = "jobs?|careers|career|opportunities|openings|positions|vacancies"
# What a link to a listing looks like, and what never is one.
NO_LISTING = (r"^#|^mailto:|^javascript:|^tel:", r"linkedin\.com|facebook\.com|instagram\.com")
LISTING_LINKS = (
    r"greenhouse\.io|boards\.greenhouse", r"jobs\.lever\.|\.lever\.co/jobs", r"myworkdayjobs\.com", r"ashbyhq\.com",
    r"[a-z0-9.-]+\.careers/", r"/careers[-_][a-z0-9]", r"/jobs?[-_][a-z0-9]", rf"/({LISTING_WORDS})(/|$|\?)",
    r"job-position/|/job-opening|/jobposting",
)
# Shapes of pages in order of precedence; the counts are of links to careers pages.
GENERATOR = r"(?i)<meta[^>]*name\s*=\s*[\"']generator[\"'][^>]*content\s*=\s*[\"']([^\"']*)[\"']"
CAREER_LINK = r"(?i)href\s*=\s*[\"'][^\"']*/(?:jobs?|careers)(?:/|[-_]|[\"'])"
LINK = r"(?i)href\s*=\s*[\"']([^\"']+)[\"']"
# What a page says that a visitor is kept from.
BLOCKED = r"captcha|please enable cookies|access denied|cookie consent|you are being redirected"


def absolute(c: Column) -> Column:
    """A base address: https is put before one without a scheme."""
    return F.when(c.rlike(r"^(?i)https?://"), c).otherwise(F.concat(F.lit("https://"), c))


def host(c: Column) -> Column:
    return F.nullif(F.lower(F.regexp_extract(c, _PARTS, 2)), F.lit(""))


def path(c: Column) -> Column:
    return F.when(host(c).isNotNull(), F.regexp_extract(c, _PARTS, 3))


def normalize(c: Column) -> Column:
    """Scheme, lower-case host and path without trailing slashes; no port, user, query or fragment. Null for
    what isn't an absolute http(s) address."""
    tail = F.regexp_replace(F.lower(F.regexp_extract(c, _PARTS, 3)), r"/+$", "")
    return F.when(
        host(c).isNotNull(),
        F.concat(F.lower(F.regexp_extract(c, _PARTS, 1)), F.lit("://"), host(c), F.when(tail == "", "/").otherwise(tail)),
    )


def resolve(url: Column, base: Column) -> Column:
    """A link as seen from its page; null if it leads to no http(s) address. Dots in a path are followed by Python only where they occur."""
    u = F.trim(url)
    root, folder = F.regexp_extract(base, r"^(?i)(https?://[^/?#]+)", 1), F.regexp_extract(base, r"^(?i)https?://[^/?#]+([^?#]*/)", 1)
    page = F.regexp_extract(base, r"^([^#]*)", 1)
    plain = (
        F.when(u.rlike("^(?i)https?://"), u)
        .when(u.rlike(r"^(?i)[a-z][a-z0-9+.-]*:"), F.lit(None))
        .when(root == "", F.lit(None))
        .when(u == "", base)
        .when(u.startswith("//"), F.concat(F.regexp_extract(root, "^([^/]+)", 1), u))
        .when(u.startswith("/"), F.concat(root, u))
        .when(u.startswith("#"), F.concat(page, u))
        .when(u.startswith("?"), F.concat(F.regexp_extract(base, r"^([^?#]*)", 1), u))
        .otherwise(F.concat(root, F.when(folder == "", "/").otherwise(folder), u))
    )
    dots = u.rlike(r"(^|/)\.{1,2}(/|$|[?#])")
    return F.when(dots, _joined(url, base)).otherwise(plain)


@F.pandas_udf(StringType())
def _joined(url: pd.Series, base: pd.Series) -> pd.Series:
    def one(u, b):
        try:
            out = urljoin(b or "", (u or "").strip())
        except ValueError:
            return None
        return out if out.startswith(("http://", "https://")) else None

    return pd.Series([one(u, b) for u, b in zip(url, base)], dtype=object)


def signature(urls: Column) -> Column:
    """Hash of the sorted distinct normal forms of an array of addresses."""
    known = F.filter(F.transform(urls, normalize), lambda x: x.isNotNull())
    return F.sha2(F.array_join(F.array_sort(F.array_distinct(known)), "\n"), 256)


def domain_imported(c: Column) -> Column:
    """The domain of an imported table row: no scheme, no last slash, no trailing quotes or commas."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(c), r"^https?://", ""), r"/$", "")
    return F.lower(F.regexp_replace(bare, r"[\",;\s]+$", ""))


def domain_probed(c: Column) -> Column:
    return F.lower(F.regexp_replace(F.regexp_replace(F.trim(c), r"(?i)^https?://", ""), r"/$", ""))


def domain_ingested(c: Column) -> Column:
    """Without scheme, path, query and fragment; the case is kept; null if nothing is left."""
    return F.nullif(F.regexp_replace(F.regexp_replace(F.trim(c), r"(?i)^https?://", ""), r"[/?#].*$", ""), F.lit(""))


def _first(c: Column, marks) -> Column:
    return reduce(lambda out, m: out.when(c.rlike(m[1]), m[0]), marks, F)


def platform_of_page(html: Column) -> Column:
    return _first(F.lower(html), PAGE_MARKS).otherwise(F.lit(None))


def platform_of_url(url: Column) -> Column:
    return F.when(url.isNotNull() & (url != ""), _first(F.lower(url), URL_MARKS).otherwise("custom"))


def slug_of_url(url: Column) -> Column:
    """The company's name at its applicant system: a path segment, or the first label of the host."""
    h = host(url)
    parts = F.filter(F.split(path(url), "/"), lambda x: x != "")
    at = lambda n: F.when(F.size(parts) > 0, F.element_at(parts, n))
    return (
        F.when(h.rlike("greenhouse|lever"), at(1))
        .when(h.contains("ashby"), at(-1))
        .when(h.contains("workable.com"), at(1))
        .when(h.rlike(r"\.(recruitee|teamtailor|bamboohr)\.com$"), F.split(h, r"\.")[0])
        .otherwise(at(1))
    )


def system_slugs(url: Column) -> dict[str, Column]:
    """The company's name at each of eight applicant systems, null where an address isn't of that system."""
    h, p = host(url), path(url)
    labels, parts = F.split(h, r"\."), F.filter(F.split(p, "/"), lambda x: x != "")
    some = lambda c: F.nullif(c, F.lit(""))
    first, last, label = F.try_element_at(parts, F.lit(1)), F.try_element_at(parts, F.lit(-1)), labels[0]
    under = lambda domain: F.when(h.endswith(domain), label)
    asked = some(F.try_url_decode(F.regexp_extract(url, r"^[^#]*?[?&]organizationHostedJobsPageName=([^&#]*)", 1)))
    own = (F.size(labels) >= 3) & (labels[1] == "greenhouse") & (F.try_element_at(labels, F.lit(3)) == "io")
    workday = h.contains("myworkdayjobs.com") | h.contains("workday.com") | (h.contains("wd") & h.contains("workday"))
    scheme = F.lower(F.regexp_extract(url, r"^(?i)(https?)://", 1))
    return {
        "greenhouse": F.coalesce(F.when(h.isNotNull() & url.contains("boards.greenhouse.io"), some(F.regexp_extract(p, "^/([^/]+)", 1))), F.when(own, label)),
        "lever": F.when(h.contains("lever.co"), F.coalesce(some(F.regexp_extract(p, "^/(?:postings/)?([^/]+)(?:/|$)", 1)), F.when(label != "www", label))),
        "ashby": F.when(h.contains("ashbyhq.com"), F.coalesce(asked, last, F.when(F.size(labels) >= 3, label))),
        "workday": F.when(workday, first),
        "workday_base": F.when(workday & first.isNotNull(), F.concat(scheme, F.lit("://"), h)),
        "workable": F.when(h.contains("workable.com"), first),
        "recruitee": under(".recruitee.com"),
        "teamtailor": under(".teamtailor.com"),
        "bamboohr": under(".bamboohr.com"),
    }


def is_listing_index(p: Column) -> Column:
    return F.coalesce(F.regexp_replace(F.lower(p), r"/+$", "").rlike(rf"^/({LISTING_WORDS})$"), F.lit(False))


def is_denied_path(p: Column) -> Column:
    segments = F.transform(F.filter(F.split(F.lower(p), "/"), lambda x: x != ""), lambda x: F.regexp_replace(x, r"\.[a-z0-9]+$", ""))
    return F.coalesce(F.exists(segments, lambda x: x.isin(*DENIED_SEGMENTS)), F.lit(False))


def looks_like_listing(href: Column) -> Column:
    u = F.lower(F.trim(href))
    career_host = u.rlike(r"careers?\.") & u.rlike(r"/p/|/jobs?/|/job/")
    no = reduce(lambda a, p: a | u.rlike(p), NO_LISTING, u == "")
    return F.coalesce(~no & (reduce(lambda a, p: a | u.rlike(p), LISTING_LINKS, F.lit(False)) | career_host), F.lit(False))


def listing_links(html: Column) -> Column:
    return F.size(F.filter(F.regexp_extract_all(html, F.lit(LINK), 1), looks_like_listing))


def page_shape(html: Column) -> Column:
    """What a page was made by, or what it mostly holds."""
    low = F.lower(html)
    generator = F.lower(F.regexp_extract(html, GENERATOR, 1))
    career = F.regexp_count(html, F.lit(CAREER_LINK))
    return (
        F.when(F.trim(F.substring(html, 1, 200)).rlike(r"(?i)^\s*<\?xml\s") | html.rlike(r"(?i)<urlset\s"), "xml-sitemap-not-html")
        .when(generator.contains("notion"), "notion-generator-meta")
        .when(generator.contains("webflow"), "webflow-generator-meta")
        .when(low.rlike(r"id\s*=\s*[\"']notion-app[\"']|notion\.site|notion\.so"), "notion-dom")
        .when(low.rlike(r"data-wf-domain|website-files\.com/[^\"']*\.webflow\."), "webflow-dom")
        .when(low.rlike(r"cdn\.shopify\.com|shopify\.theme"), "shopify")
        .when(career >= 4, "many-career-path-hrefs")
        .when(low.rlike(r"greenhouse\.io|boards\.greenhouse"), "greenhouse-embed-snippet")
        .when(low.rlike(r"lever\.co|jobs\.lever"), "lever-embed-snippet")
        .when(low.rlike(r"myworkdayjobs\.com|workday\.com/wday"), "workday-embed-snippet")
        .when(low.rlike(r"wp-content|wordpress") & (career >= 2), "wordpress-careers-ish")
        .otherwise("other")
    )


def is_suspicious(html: Column, status: Column, content_type: Column) -> Column:
    """A page that must be rendered: an error, too small, no HTML, or a shell without links; blocked pages aren't."""
    size = F.octet_length(html)
    blocked = F.lower(html).rlike(BLOCKED)
    shell = (size > 5120) & (F.regexp_count(html, F.lit(r"(?i)<a\s[^>]*href")) < 4)
    return ~blocked & (status.between(400, 499) | (size < 5120) | ~F.coalesce(content_type.contains("text/html"), F.lit(False)) | shell)

"""Listings in pages of five site builders: links to postings, objects in script JSON, and JSON-LD, merged by address."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import nested, urls
from tidemark.functions.text import squeeze, title_of_link
from tidemark.operators.pages import ANCHOR

SCRIPT = r"(?is)<script[^>]*>(.*?)</script>"
# What a builder's page holds, how its postings' addresses look, and what its objects call things.
POSTING = r"(?i)/(job|jobs|position|positions|opening|openings|vacancy|vacancies|career-opportunities)\b"
NO_POSTING = r"(?i)(privacy|terms|cookie|about|contact|legal|policy|disclaimer|settings)"
ROLES = r"(?i)(engineer|developer|manager|intern|technician|specialist|analyst|operator|designer|director|consultant|architect)"
URL_KEYS = r"(?i)(url|joburl|job_url|link|applicationurl|application_url|postingurl|posting_url)$"
WIX_MARKS = r"(?i)static\.wixstatic\.com|parastorage\.com|data-wix-|wix-warmup-data|wix-code|<meta[^>]*name\s*=\s*[\"']generator[\"'][^>]*content\s*=\s*[\"'][^\"']*wix[^\"']*[\"']"
SHOP_NO_PAGES = (
    "privacy-policy", "privacy", "terms", "terms-of-service", "contact", "about", "faq", "shipping", "returns", "cookie-policy", "legal", "careers", "jobs",
)
NOTE_NO_PAGES = ("privacy", "privacy-policy", "terms", "terms-of-service", "legal", "about", "cookies", "cookie-policy", "careers", "jobs", "home")
NOTE_MARKS = r"(?i)id\s*=\s*[\"']notion-app[\"']|notion\.site|notion\.so|<meta[^>]*name\s*=\s*[\"']generator[\"'][^>]*content\s*=\s*[\"'][^\"']*notion[^\"']*[\"']"


def _segments(url: Column) -> Column:
    return F.filter(F.split(urls.path(url), "/"), lambda x: x != "")


def _shopify(url: Column, base: Column) -> Column:
    parts = _segments(url)
    return F.coalesce((F.size(parts) >= 2) & (F.get(parts, F.lit(0)) == "pages") & ~F.lower(F.try_element_at(parts, F.lit(-1))).isin(*SHOP_NO_PAGES), F.lit(False))


def _notion(url: Column, base: Column) -> Column:
    parts, host = _segments(url), urls.host(url)
    public = host.isin("notion.so", "www.notion.so") | host.endswith(".notion.site")
    return F.coalesce(public & ((F.size(parts) > 1) | ((F.size(parts) == 1) & ~F.lower(F.get(parts, F.lit(0))).isin(*NOTE_NO_PAGES))), F.lit(False))


def _greenhouse(url: Column, base: Column) -> Column:
    return urls.host(url).rlike(r"greenhouse\.io|boards\.greenhouse") & (urls.path(url).rlike(r"(?i)/jobs/\d+") | url.rlike(r"(?i)^[^#]*[?&]gh_jid="))


def _lever(url: Column, base: Column) -> Column:
    return urls.host(url).endswith("lever.co") & (F.size(F.filter(F.split(urls.path(url), "/"), lambda x: x != "")) >= 2)


def _wix(url: Column, base: Column) -> Column:
    path = urls.path(url)
    single = F.lower(F.regexp_replace(path, "^/+", ""))
    one = F.size(F.filter(F.split(path, "/"), lambda x: x != "")) < 2
    slug = (single.contains("-") & ~single.rlike(NO_POSTING)) | single.rlike(ROLES)
    likely = ~urls.is_listing_index(path) & (path.rlike(POSTING) | F.when(one, slug).otherwise(path.rlike(r"(?i)(careers|career|opportunities|openings|vacancies)")))
    own = url.rlike(r"(?i)^[^#]*[?&](gh_jid|lever-via|workday|jobid|job_id)=") | path.rlike(POSTING) | (urls.host(url) == urls.host(base))
    return (path != "") & likely & own


@dataclass(frozen=True)
class Builder:
    """mark: of its pages; posting(address, base): whether an address is a posting's; links(fields): an object's addresses, each with its place
    in the object; titles, description: names of its fields; linked_data: whether JSON-LD is read as well; scripts: whether objects of scripts are; href: what a link
    must hold as it is written."""

    name: str
    mark: str
    posting: Callable[[Column, Column], Column]
    url_fields: tuple[str, ...]
    titles: tuple[str, ...]
    description: str
    longest: int | None = 120
    linked_data: bool = True
    scripts: bool = True
    href: str = ""


BUILDERS = {
    b.name: b
    for b in (
        Builder("greenhouse", r"(?i)greenhouse\.io|boards\.greenhouse", _greenhouse, ("absolute_url",), ("title", "name"), "content"),
        Builder("lever", r"(?i)lever\.co|jobs\.lever", _lever, ("hostedUrl", "hosted_url", "applyUrl"), ("text", "title", "name"), "descriptionPlain"),
        Builder("wix", WIX_MARKS, _wix, (), ("title", "name", "role"), "description", None, False),
        Builder("shopify", r"(?i)cdn\.shopify\.com|shopify\.theme", _shopify, (), (), "", scripts=False, href="/pages/"),
        Builder("notion", NOTE_MARKS, _notion, (), (), "", scripts=False, linked_data=False),
    )
}


def not_html(html: Column) -> Column:
    return F.trim(F.substring(html, 1, 800)).rlike(r"(?i)^<\?xml\s") | html.rlike(r"(?i)<urlset\s")


def page_has(html: Column, url: Column) -> Column:
    """Whether a page spells an address or its path."""
    path = F.when(urls.path(url) == "", "/").otherwise(urls.path(url))
    return F.contains(html, path) | F.contains(html, url)


def once(link: Column) -> Column:
    """An address as a column of its own: conditions on it don't repeat what it is made by."""
    return F.explode(F.array(link)).alias("link")


def truthy(v: Column) -> Column:
    """v where a script takes it for true: not missing, not false, 0 or an empty string."""
    return nested.with_value(v, lambda x: F.when(~nested.is_missing(x) & ~F.to_json(x).isin('""', "0", "false"), x))


def links(pages: DataFrame, builder: Builder) -> DataFrame:
    tags = pages.select("page_id", F.col("url").alias("base"), "html", F.posexplode(F.regexp_extract_all("html", F.lit(ANCHOR), 0)).alias("ord", "tag"))
    href = F.trim(F.regexp_extract("tag", r"(?i)href\s*=\s*[\"']([^\"']+)[\"']", 1))
    text = squeeze(F.regexp_replace(F.regexp_replace("tag", r"(?i)^<a[^>]*>|</a>$", ""), r"<[^>]+>", ""))
    title = F.when(F.length(text) > 120, F.concat(F.substring(text, 1, 117), F.lit("..."))).otherwise(F.nullif(text, F.lit("")))
    found = tags.where(~href.startswith("#") & href.contains(builder.href)).select("page_id", "base", "html", "ord", once(urls.resolve(href, F.col("base"))), title.alias("title"))
    found = found.where(builder.posting(F.col("link"), F.col("base")) & page_has(F.col("html"), F.col("link")))
    return found.select("page_id", F.array("ord").alias("place"), "link", F.coalesce("title", title_of_link(F.col("link"))).alias("title"), F.lit(None).cast("string").alias("description"))


def objects(pages: DataFrame, builder: Builder) -> DataFrame:
    """Postings among the objects of scripts that are JSON, at any depth."""
    scripts = pages.select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit(SCRIPT), 1)).alias("script", "json"))
    values = scripts.select("page_id", "script", nested.parsed(F.trim("json")).alias("v"))
    found = nested.objects(values, "v", ["page_id", "script"]).join(pages.select("page_id", F.col("url").alias("base"), "html"), "page_id")
    f = F.col("fields")
    if builder.url_fields:
        link = F.coalesce(*(truthy(F.try_element_at(f, F.lit(n))) for n in builder.url_fields))
        urls_of = F.array(nested.string(link))
    else:
        named = F.filter(F.map_entries(f), lambda e: e["key"].rlike(URL_KEYS))
        urls_of = F.transform(named, lambda e: nested.string(e["value"]))
    title = nested.string(F.coalesce(*(truthy(F.try_element_at(f, F.lit(n))) for n in builder.titles)))
    title = squeeze(title) if builder.longest is None else F.substring(squeeze(title), 1, builder.longest)
    description = F.substring(nested.string(F.try_element_at(f, F.lit(builder.description))), 1, 500)
    rows = found.select("page_id", "base", "html", F.concat(F.array("script"), "place").alias("at"), title.alias("title"), description.alias("description"), F.posexplode(urls_of).alias("k", "raw"))
    rows = rows.where("raw IS NOT NULL").select("*", once(urls.resolve(F.col("raw"), F.col("base"))))
    kept = rows.where(builder.posting(F.col("link"), F.col("base")) & (F.contains("html", F.col("raw")) | F.contains("html", F.col("link"))))
    place = F.concat("at", F.array("k"))
    return kept.select("page_id", place.alias("place"), "link", F.coalesce(F.nullif("title", F.lit("")), title_of_link(F.col("link"))).alias("title"), "description")


def linked_data(pages: DataFrame) -> DataFrame:
    """Postings in JSON-LD scripts: the nodes that a script holds, those of its graph, lists, items and main entities, at any depth."""
    typed = r"(?is)<script[^>]*type\s*=\s*[\"']application/ld\+json[\"'][^>]*>(.*?)</script>"
    scripts = pages.select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit(typed), 1)).alias("script", "json"))
    bare = F.trim(F.regexp_replace(F.regexp_replace(F.trim("json"), r"(?i)^<!\[CDATA\[", ""), r"\]\]>$", ""))
    values = scripts.select("page_id", "script", nested.parsed(bare).alias("v"))
    found = nested.objects(values, "v", ["page_id", "script"], through=("@graph", "itemListElement", "item", "mainEntity"))
    found = found.join(pages.select("page_id", F.col("url").alias("base"), "html"), "page_id")
    at = lambda v, *names: reduce(lambda v, n: F.try_variant_get(v, "$['%s']" % n, "variant"), names, v)
    f = F.col("fields")
    own = lambda n: F.try_element_at(f, F.lit(n))
    named = lambda v: F.coalesce(nested.string(v), nested.string(at(v, "@id")), nested.string(at(v, "url")))
    address = lambda v: nested.with_value(F.trim(nested.string(v)), lambda s: F.when(s.rlike(r"(?i)^https?://") | s.startswith("/"), s))
    identified = lambda v: F.coalesce(address(v), address(at(v, "value")), address(at(v, "@id")))
    first = lambda v, rule: F.coalesce(rule(v), F.filter(F.transform(F.try_variant_get(v, "$", nested.ARRAY), rule), lambda x: x.isNotNull())[0])
    some = lambda c: F.nullif(c, F.lit(""))
    self_id = nested.string(own("@id"))
    link = F.coalesce(
        some(named(own("url"))), first(own("identifier"), identified), some(named(own("mainEntityOfPage"))),
        F.when(self_id.rlike(r"(?i)^https?://"), self_id),
        first(own("potentialAction"), lambda v: F.coalesce(some(named(at(v, "target"))), some(named(at(v, "url"))))), some(named(at(own("hiringOrganization"), "sameAs"))),
    )
    kinds = F.coalesce(F.try_variant_get(own("@type"), "$", "array<string>"), F.array(nested.string(own("@type"))))
    title = squeeze(F.try_variant_get(F.coalesce(truthy(own("title")), truthy(own("name"))), "$", "string"))
    rows = found.where(F.exists(kinds, lambda k: F.contains(F.lower(k), F.lit("jobposting")))).select(
        "page_id", "html", F.concat(F.array("script"), "place").alias("place"), F.explode(F.array(link)).alias("raw"), "base", title.alias("title"),
        F.substring(nested.string(own("description")), 1, 500).alias("description"),
    )
    rows = rows.where("raw IS NOT NULL").select("*", once(urls.resolve(F.col("raw"), F.col("base"))))
    path = urls.path(F.col("link"))
    kept = rows.where((page_has(F.col("html"), F.col("link")) | F.contains("html", F.col("raw"))) & ~urls.is_listing_index(path) & ~urls.is_denied_path(path))
    return kept.select("page_id", "place", "link", F.coalesce("title", title_of_link(F.col("link"))).alias("title"), "description")


def listings(pages: DataFrame, name: str) -> DataFrame:
    """(page_id, url, title, description) of a builder's pages (page_id, url, html): of several finds of an address on a page
    the first stands, links before objects before JSON-LD. Scripts that aren't JSON have none; pages of others have none."""
    builder = BUILDERS[name]
    mine = pages.where(F.col("html").rlike(builder.mark) & ~not_html(F.col("html")))
    found = [links(mine, builder), *([objects(mine, builder)] if builder.scripts else []), *([linked_data(mine)] if builder.linked_data else [])]
    return merged(found)


def merged(found: list[DataFrame]) -> DataFrame:
    """Finds (page_id, place, link, title, description) of several kinds: of an address the first stands, by kind, then by place."""
    every = reduce(DataFrame.unionByName, [f.withColumn("kind", F.lit(i)) for i, f in enumerate(found)])
    first = every.groupBy("page_id", "link").agg(F.min_by(F.struct("title", "description"), F.struct("kind", "place")).alias("s"))
    return first.select("page_id", F.col("link").alias("url"), "s.title", "s.description")

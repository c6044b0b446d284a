"""A page's elements as nested intervals over its tokens, by column functions and windows over a page.

A page becomes tokens (tags and texts) with their places. An element reaches from its opening tag to the closing tag of its name at the same level, where
levels are running sums over the tags of that name; what is never closed reaches to the page's end. What a place lies in follows from
levels too, so no pairs of places and elements are made. Comments, scripts and styles are no tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import urls
from tidemark.functions.text import squeeze, title_of_link
from tidemark.operators.builders import once, page_has
from tidemark.sources.shared import materialize

LEFT_OUT = r"(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>|<noscript\b.*?</noscript>"
TOKEN = r"</?[A-Za-z](?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^<]++|<"
END = 1 << 40
# Elements without an end, and marks of a page's regions.
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")
CHROME_ROLES, CHROME_CLASS = ("navigation", "banner", "contentinfo"), "w-nav"
CARD_CLASSES = ("w-dyn-item", "w-dyn-list", "w-dyn-items")
CARD_NO_WORDS = r"(^|/)(about|contact|privacy|legal|terms|blog|resource|resources|company)(/|$)"
CARD_NO_SEGMENTS = (
    "about", "about-us", "contact", "company", "team", "culture", "blog", "news", "press", "events", "resources", "resource", "pricing", "faq", "login",
    "sign-in", "signup", "sign-up", "legal", "privacy", "terms",
)
CAREERS = r"(?i)careers?|jobs?|join[- ]us|work[- ]with[- ]us|hiring|open[- ]roles"
SMALL_PAGE, LONG_TEXT = 200, 80


def attribute(tag: Column, name: str) -> Column:
    """An attribute's value; null without it."""
    there = rf"(?is)\s{name}\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"
    return F.when(tag.rlike(there), F.concat(*(F.regexp_extract(tag, there, i) for i in (1, 2, 3))))


def tokens(pages: DataFrame) -> DataFrame:
    """(page_id, ord, token, name, closes): name and closes are null for texts."""
    text = F.regexp_replace("html", LEFT_OUT, "")
    every = pages.select("page_id", F.posexplode(F.regexp_extract_all(text, F.lit(TOKEN), 0)).alias("ord", "token"))
    name = F.nullif(F.lower(F.regexp_extract("token", r"^</?([A-Za-z][^\s/>]*)", 1)), F.lit(""))
    return every.select("page_id", F.col("ord").cast("long").alias("ord"), "token", name.alias("name"), F.when(name.isNotNull(), F.col("token").startswith("</")).alias("closes"))


def _levels(events: DataFrame, keys: list[str]) -> DataFrame:
    """Events (step 1, -1, 0) with the level that they open, close or lie in."""
    running = F.sum("step").over(Window.partitionBy(*keys).orderBy("ord").rowsBetween(Window.unboundedPreceding, 0))
    return events.withColumn("level", running + F.when(F.col("step") == -1, 1).otherwise(0))


def elements(every: DataFrame) -> DataFrame:
    """(page_id, ord, end, name, tag) of the elements; void ones have none."""
    tags = every.where(F.col("name").isNotNull() & ~F.col("name").isin(*VOID))
    levels = _levels(tags.withColumn("step", F.when(F.col("closes"), -1).otherwise(1)), ["page_id", "name"])
    after = F.lead("ord").over(Window.partitionBy("page_id", "name", "level").orderBy("ord"))
    return levels.withColumn("end", F.coalesce(after, F.lit(END))).where("step = 1").select("page_id", "ord", "end", "name", F.col("token").alias("tag"))


def around(places: DataFrame, regions: DataFrame) -> DataFrame:
    """(page_id, ord, kind, region) for places (page_id, ord) and regions (page_id, kind, ord, end): the nearest region of each kind that a place
    lies in; nothing where it lies in none."""
    kinds = regions.select("page_id", "kind").distinct()
    opens = regions.select("page_id", "kind", "ord", F.lit(1).alias("step"))
    closes = regions.where(F.col("end") < END).select("page_id", "kind", F.col("end").alias("ord"), F.lit(-1).alias("step"))
    asked = places.select("page_id", "ord").join(kinds, "page_id").select("page_id", "kind", "ord", F.lit(0).alias("step"))
    levels = _levels(opens.unionByName(closes).unionByName(asked), ["page_id", "kind"])
    before = Window.partitionBy("page_id", "kind", "level").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    nearest = F.last(F.when(F.col("step") == 1, F.col("ord")), ignorenulls=True).over(before)
    return levels.withColumn("region", nearest).where("step = 0 AND level > 0 AND region IS NOT NULL").select("page_id", "ord", "kind", "region")


def texts(every: DataFrame, parts: DataFrame) -> DataFrame:
    """(page_id, ord, text) of elements (page_id, ord, end) that don't nest; one ends where the next begins."""
    nxt = F.lead("ord").over(Window.partitionBy("page_id").orderBy("ord"))
    parts = parts.select("page_id", "ord", F.least("end", F.coalesce(nxt, F.lit(END))).alias("end"))
    marked = parts.select("page_id", "ord", F.struct("ord", "end").alias("part"), F.lit(None).cast("string").alias("token"))
    words = every.where("name IS NULL").select("page_id", "ord", F.lit(None).cast("struct<ord:long,end:long>").alias("part"), "token")
    before = Window.partitionBy("page_id").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    within = marked.unionByName(words).withColumn("in", F.last("part", ignorenulls=True).over(before))
    within = within.where(F.col("in").isNotNull() & (F.col("ord") < F.col("in.end"))).groupBy("page_id", F.col("in.ord").alias("ord"))
    spelled = F.transform(F.array_sort(F.collect_list(F.when(F.col("token").isNotNull(), F.struct("ord", "token")))), lambda x: x["token"])
    return within.agg(squeeze(F.array_join(spelled, "")).alias("text"))


def anchors(pages: DataFrame, kinds: dict[str, Column]) -> DataFrame:
    """(page_id, ord, href, text, kinds as the places of the nearest such elements or null) of links; kinds are conditions on name and tag."""
    every = materialize(tokens(pages))  # links, regions and texts read the tokens and elements that are cut once
    found = materialize(elements(every))
    links = found.where("name = 'a'").withColumn("href", attribute(F.col("tag"), "href")).where("href IS NOT NULL")
    several = F.array_compact(F.array(*(F.when(c, F.lit(k)) for k, c in kinds.items())))
    regions = found.select("page_id", F.explode(several).alias("kind"), "ord", "end")
    near = around(links, regions).groupBy("page_id", "ord").agg(*(F.max(F.when(F.col("kind") == k, F.col("region"))).alias(k) for k in kinds))
    named = texts(every, found.where("name = 'a'"))
    return links.select("page_id", "ord", "href").join(named, ["page_id", "ord"], "left").join(near, ["page_id", "ord"], "left")


def has_class(tag: Column, *names: str) -> Column:
    return F.coalesce(F.arrays_overlap(F.split(attribute(tag, "class"), r"\s+"), F.array(*map(F.lit, names))), F.lit(False))


def role(tag: Column) -> Column:
    return F.coalesce(F.lower(attribute(tag, "role")), F.lit(""))


def card_link(href: Column, link: Column) -> Column:
    """whether a link in a card of a collection leads to a posting, by its path alone."""
    shown, path = F.lower(F.regexp_replace(F.trim(href), "(?s)#.*", "")), F.regexp_replace(F.lower(urls.path(link)), "/+$", "")
    index, section = urls.is_listing_index(path), F.trim(href).rlike(r"(?i)/(jobs?|careers?)(/)?#.+")
    segments = F.filter(F.split(path, "/"), lambda x: x != "")
    first = segments[0]
    several = ~first.isin(*CARD_NO_SEGMENTS) & first.rlike("(jobs?|careers?|positions|openings|opportunities|vacancies)|^(roles?|postings?)$")
    single = ~first.isin(*CARD_NO_SEGMENTS) & ~index & first.rlike("^[a-z0-9]+(-[a-z0-9]+)+$")
    listed = F.when(F.size(segments) >= 2, several).when(F.size(segments) == 1, single)
    good = (shown != "") & ~shown.rlike("^mailto:|^javascript:|^tel:") & ~shown.rlike(CARD_NO_WORDS) & (path != "")
    return F.coalesce(good & F.when(index, section).otherwise(~path.rlike(CARD_NO_WORDS) & listed), F.lit(False))


def listings(pages: DataFrame) -> DataFrame:
    """(page_id, url, title) of links to postings in pages (page_id, url, html).

    Links in headers, footers and navigation are left out (but for cards of a collection); on plain pages with many such links, a link counts only in
    a main part, or where its list or section has two addresses. Pages that then have none, and few such links or a blog's marks, are
    read once more without regard to regions. The first link to an address names it."""
    tag, name = F.col("tag"), F.col("name")
    kinds = {
        "chrome": name.isin("header", "footer", "nav") | role(tag).isin(*CHROME_ROLES) | has_class(tag, CHROME_CLASS),
        "card": has_class(tag, *CARD_CLASSES),
        "main": name.isin("main", "article") | (role(tag) == "main"),
        "block": name.isin("section", "ul", "ol"),
    }
    html = F.col("html")
    generator = F.lower(F.regexp_extract(html, urls.GENERATOR, 1))
    n_links = urls.listing_links(html)
    flagged = pages.select(
        "page_id", F.col("url").alias("base"), "html",
        (generator.contains("webflow") | html.rlike(r"(?i)data-wf-domain|website-files\.com/[^\"']*\.webflow\.")).alias("webflow"),
        ((urls.page_shape(html) == "other") & (n_links >= 3)).alias("dense"), ((n_links < 3) | html.rlike("(?i)wp-content|wordpress")).alias("again"),
    )
    found = anchors(pages, kinds).join(flagged, "page_id")
    href = F.trim("href")
    rows = found.select("*", once(urls.resolve(href, F.col("base"))), urls.looks_like_listing(F.regexp_replace(href, "(?s)#.*", "")).alias("plain"))
    rows = rows.withColumn("carded", F.col("webflow") & F.col("card").isNotNull() & card_link(href, F.col("link")))
    path = urls.path(F.col("link"))
    section = F.col("carded") & F.col("link").rlike("#.")
    fits = (F.col("plain") | F.col("carded")) & F.col("link").isNotNull() & page_has(html, F.col("link"))
    fits = fits & ~urls.is_denied_path(path) & (~urls.is_listing_index(path) | section)
    outside = F.col("chrome").isNull() | (F.col("webflow") & F.col("card").isNotNull())
    rows = rows.where(fits).select("page_id", "ord", "link", "text", "dense", "webflow", "again", outside.alias("outside"), "main", "block")
    first = lambda df: df.groupBy("page_id", "link").agg(F.min_by(F.struct("ord", "text", "dense", "main", "block"), "ord").alias("s")).select("page_id", "link", "s.*")
    strict = first(rows.where("outside")).withColumn("root", F.coalesce("main", "block"))
    together = F.count("*").over(Window.partitionBy("page_id", "root"))
    strict = strict.withColumn("n", together).where("NOT dense OR root IS NOT NULL AND (main IS NOT NULL OR n >= 2)").drop("root", "n")
    rest = rows.where("again AND NOT webflow").join(strict.select("page_id").distinct(), "page_id", "left_anti")
    text = F.when(F.length("text") > 120, F.concat(F.substring("text", 1, 117), F.lit("..."))).otherwise(F.nullif("text", F.lit("")))
    return strict.unionByName(first(rest)).select("page_id", F.col("link").alias("url"), F.coalesce(text, title_of_link(F.col("link"))).alias("title"))


def careers_hints(pages: DataFrame) -> DataFrame:
    """(company, url, text, location) of links that speak of careers in profile pages (company, page_id, ord, url, html): of several links
    to an address the first stands, by the order of a company's pages, then of the page. The location is the header, else the footer, else the
    navigation that a link lies in, else the body."""
    where = {k: F.col("name") == k for k in ("header", "footer", "nav")}
    links = anchors(pages.select("page_id", "html"), where).withColumnRenamed("ord", "place")
    links = links.where(F.col("href").rlike(CAREERS) | F.col("text").rlike(CAREERS)).join(pages.select("company", "page_id", "ord", F.col("url").alias("base")), "page_id")
    location = F.coalesce(*(F.when(F.col(k).isNotNull(), k) for k in where), F.lit("body"))
    found = links.select("company", "ord", "place", once(urls.resolve(F.col("href"), F.col("base"))), F.coalesce(F.nullif("text", F.lit("")), F.col("href")).alias("text"), location.alias("location"))
    first = found.where("link IS NOT NULL").groupBy("company", "link").agg(F.min_by(F.struct("text", "location"), F.struct("ord", "place")).alias("s"))
    return first.select("company", F.col("link").alias("url"), "s.text", "s.location")


def descriptions(pages: DataFrame) -> DataFrame:
    """(company, description, render) of profile pages (company, page_id, ord, url, html): a page's meta description, else its first
    paragraph of more than 80 characters; the first page with one stands. render: none of a company's pages has 200 bytes of text, so they must be
    rendered first."""
    every = tokens(pages)
    meta = every.where((F.col("name") == "meta") & (attribute(F.col("token"), "name") == "description")).groupBy("page_id").agg(F.min_by("token", "ord").alias("token"))
    meta = meta.select("page_id", F.nullif(F.trim(attribute(F.col("token"), "content")), F.lit("")).alias("meta"))
    paragraphs = texts(every, elements(every).where("name = 'p'")).where(F.length("text") > LONG_TEXT)
    paragraph = paragraphs.groupBy("page_id").agg(F.min_by("text", "ord").alias("paragraph"))
    shown = every.where("name IS NULL").groupBy("page_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "token"))), lambda x: x["token"]), "").alias("shown"))
    named = pages.select("company", "page_id", "ord").join(meta, "page_id", "left").join(paragraph, "page_id", "left").join(shown, "page_id", "left")
    named = named.select("company", "ord", F.coalesce("meta", "paragraph").alias("d"), F.coalesce(F.octet_length(squeeze(F.col("shown"))), F.lit(0)).alias("size"))
    return named.groupBy("company").agg(F.min_by("d", F.when(F.col("d").isNotNull(), F.col("ord"))).alias("description"), (F.max("size") < SMALL_PAGE).alias("render"))

"""Listings out of the JSON answers of applicant systems, on VARIANT values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import nested, urls

# Where each provider keeps its listings, and the paths of a listing's fields in order of preference.
LISTS = {
    "greenhouse": ("$.jobs", "$"), "lever": ("$", "$.jobs"), "ashby": ("$.jobs",), "workday": ("$.jobPostings",),
    "workable": ("$.results",), "recruitee": ("$", "$.offers"), "teamtailor": ("$", "$.data", "$.jobs"),
}
FIELDS = {
    "greenhouse": {"title": ("title", "name"), "url": ("absolute_url", "absoluteUrl", "url", "apply_url", "job_url"),
                   "location": ("location.name", "location.city", "location"), "description": ("content", "description")},
    "lever": {"title": ("text", "title", "name"), "url": ("hostedUrl", "hostedurl", "hosted_url"),
              "location": ("categories.location",), "description": ("descriptionPlain", "description")},
    "ashby": {"title": ("title", "name"), "url": ("jobUrl", "hostedUrl", "url"), "location": ("location.name", "location.city", "location"),
              "employment_type": ("employmentType", "employment_type"), "description": ("descriptionHtml", "descriptionPlain")},
    "workday": {"title": ("title", "jobTitle"), "url": ("externalPath",), "location": ("locationsText", "location"),
                "employment_type": ("employmentType", "employment_type"), "description": ("description", "jobDescription")},
    "workable": {"title": ("title",), "url": ("url",), "location": ("location",), "employment_type": ("employment_type",),
                 "description": ("description",)},
    "recruitee": {"title": ("title",), "url": ("url", "careers_url"), "employment_type": ("kind",), "description": ("description",)},
    "teamtailor": {"title": ("title", "attributes.title"), "url": ("url", "links['careersite-job-url']"), "location": ("location", "attributes.location")},
}

# Where an answer's list is, and its items' addresses in order of preference.
ADDRESSES = {
    "greenhouse_api": (("$.jobs",), ("absolute_url", "url", "apply_url", "job_url")),
    "lever_api": (("$",), ("hostedUrl", "hosted_url", "url", "applyUrl")),
    "ashby_api": (("$.jobs",), ("jobUrl", "hostedUrl", "url")),
    "workday_api": (("$.jobPostings",), ("externalPath", "url")),
    "workable_api": (("$.results",), ("url",)),
    "recruitee_api": (("$", "$.offers"), ("url", "careers_url")),
    "teamtailor_api": (("$", "$.data", "$.jobs"), ("url", "links['careersite-job-url']")),
}
PAGE_PROVIDER = "bamboohr_api"


def _text(item: Column, *paths: str) -> Column:
    """The first non-blank text at one of the paths."""
    got = [F.nullif(F.try_variant_get(item, f"$.{p}", "string"), F.lit("")) for p in paths]
    return F.coalesce(*[F.when(~g.startswith("{"), g) for g in got])


def _list(body: Column, paths: tuple[str, ...]) -> Column:
    return F.coalesce(*[F.try_variant_get(body, p, "array<variant>") for p in paths])


def provider_of(body: Column, platform: Column) -> Column:
    """The mapper for an answer: its platform decides, then its form."""
    has = lambda p: F.try_variant_get(body, p, "array<variant>").isNotNull()
    first = lambda *ps: F.coalesce(*[F.try_variant_get(body, f"$[0].{p}", "string") for p in ps]).isNotNull()
    p = F.lower(F.coalesce(platform, F.lit("")))
    return (
        F.when((p == "workable") | has("$.results"), "workable")
        .when((p == "teamtailor") | has("$.data"), "teamtailor")
        .when(p == "recruitee", "recruitee")
        .when(F.try_variant_get(body, "$.jobs[0].jobUrl", "string").isNotNull(), "ashby")
        .when(has("$.jobPostings"), "workday")
        .when(has("$.jobs"), "greenhouse")
        .when(has("$") & first("kind", "country_code", "remote"), "recruitee")
        .when(has("$"), "lever")
    )


def _fields(item: Column, provider: str) -> Column:
    paths = FIELDS[provider]
    get = lambda name: _text(item, *paths[name]) if name in paths else F.lit(None).cast("string")
    url, location, description = get("url"), get("location"), get("description")
    part = lambda p: F.nullif(F.try_variant_get(item, f"$.{p}", "string"), F.lit(""))
    blank_null = lambda c: F.nullif(c, F.lit(""))
    if provider == "lever":
        many = F.try_variant_get(item, "$.categories.location", "array<string>")
        location = F.coalesce(F.array_join(many, " | "), location)
    if provider == "ashby":
        description = F.trim(F.regexp_replace(description, r"<[^>]+>", " "))
    if provider == "workday":
        bullets = F.try_variant_get(item, "$.bulletFields", "array<string>")
        description = F.coalesce(blank_null(F.array_join(bullets, "\n")), description)
        url = urls.resolve(url, F.col("base"))
    if provider == "workable":
        place = blank_null(F.concat_ws(", ", part("location.city"), part("location.region"), part("location.country")))
        location = F.coalesce(place, location)
        code = part("shortcode")
        made = F.concat(F.lit("https://apply.workable.com/"), F.col("slug"), F.lit("/j/"), code)
        url, description = F.coalesce(url, made), F.substring(description, 1, 500)
    if provider == "recruitee":
        remote = F.coalesce(F.try_variant_get(item, "$.remote", "boolean"), F.lit(False))
        location = F.when(remote, "Remote").otherwise(blank_null(F.concat_ws(", ", part("city"), part("country_code"))))
        description = F.substring(F.regexp_replace(description, r"<[^>]+>", ""), 1, 500)
    return F.struct(
        get("title").alias("title"), url.alias("url"), location.alias("location"), get("employment_type").alias("employment_type"), description.alias("description")
    )


def listings(answers: DataFrame) -> DataFrame:
    """(company_id, provider, ord, title, url, location, employment_type, description) of answers (company_id,
    platform, slug, body, and base, the page that Workday's relative addresses are seen from). A body that isn't JSON, or of no known form, has none."""
    answers = answers if "base" in answers.columns else answers.withColumn("base", F.lit(None).cast("string"))
    a = answers.withColumn("v", nested.parsed(F.col("body")))
    a = a.withColumn("provider", provider_of(F.col("v"), F.col("platform")))
    items = F
    for name, paths in LISTS.items():
        items = items.when(F.col("provider") == name, _list(F.col("v"), paths))
    a = a.select("company_id", "slug", "base", "provider", F.posexplode(items).alias("ord", "item"))
    fields = F
    for name in FIELDS:
        fields = fields.when(F.col("provider") == name, _fields(F.col("item"), name))
    return a.select("company_id", "provider", "ord", fields.alias("f")).select("company_id", "provider", "ord", "f.*")


def _address(provider: str, names: tuple[str, ...]):
    made = F.concat(F.lit("https://apply.workable.com/"), F.nullif(F.col("slug"), F.lit("")), F.lit("/j/"))
    if provider == "workable_api":
        return lambda item: F.coalesce(_text(item, *names), F.concat(made, _text(item, "shortcode")))
    return lambda item: _text(item, *names)


def addresses(answers: DataFrame) -> DataFrame:
    """(company_id, url): each normal address that a provider's answer (company_id, provider, slug, base, body) lists, once. Relative ones are seen from
    ``base``. A body that isn't JSON, has another form or is of another provider has none; one provider answers with a page, whose links are read."""
    a = answers.withColumn("v", nested.parsed(F.when(F.col("provider") != PAGE_PROVIDER, F.col("body"))))
    raw = F
    for name, (lists, names) in ADDRESSES.items():
        raw = raw.when(F.col("provider") == name, F.transform(_list(F.col("v"), lists), _address(name, names)))
    raw = raw.when(F.col("provider") == PAGE_PROVIDER, F.regexp_extract_all("body", F.lit(urls.LINK), 1))
    rows = a.select("company_id", "base", F.explode(raw).alias("raw")).where("raw IS NOT NULL")
    rows = rows.select("company_id", F.explode(F.array(urls.resolve(F.col("raw"), F.col("base")))).alias("link"))
    return rows.select("company_id", urls.normalize(F.col("link")).alias("url")).where("url IS NOT NULL").distinct()

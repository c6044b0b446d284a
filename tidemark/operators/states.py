"""What a stage's result does to a company or a listing: gates before it, columns after it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import classify, urls
from tidemark.functions.lifecycle import blank

# What a model may answer for a listing's relevance, and where a run keeps its count and its addresses, in order.
RELEVANCES = ("low", "medium", "high")
COUNTS = ("job_count", "count", "jobs_count")
COUNTED = ("jobs", "job_urls", "seen_urls", "found_jobs", "urls", "found_urls")
SEEN = ("seen_urls", "job_urls", "jobs", "found_urls", "found_jobs", "urls")
# The columns that each stage writes, all of which a reset clears.
STAGE_COLUMNS = (
    "careers_page_url", "careers_page_reachable", "careers_page_discovery_method", "careers_page_failure_reason", "ats_platform", "llm_attempted",
    "llm_error", "fingerprint_attempted_at", "ats_detection_source", "ats_slug", "last_scraped_at", "last_extracted_at", "climate_tech_category",
    "primary_sector", "opportunity_area", "category_confidence", "category_error",
)
# Ends of company names that an applicant system's short name leaves out.
SUFFIXES = r"\s+(inc\.?|corp\.?|llc\.?|ltd\.?|co\.?|company|technologies|tech|solutions|group|systems|energy|power|labs?|holdings?)\z"
SIGNAL_LENGTH = 80


def validated(companies: DataFrame) -> DataFrame:
    """Companies with a name that aren't the example; an error if none is left (this counts at once)."""
    kept = companies.where(
        (F.trim(F.coalesce("name", F.lit(""))) != "") & (F.lower(F.trim(F.coalesce(F.col("id").cast("string"), F.lit("")))) != "example") & (F.lower("name") != "example")
    )
    if kept.isEmpty():
        raise ValueError("no valid companies")
    return kept


def targeted(companies: DataFrame, names: list[str], limit: int | None = None) -> DataFrame:
    """Companies by name, whatever its case, or by id; the first ones by id if there is a limit."""
    wanted = [n.strip().lower() for n in names]
    found = companies.where(F.lower(F.coalesce("name", F.lit(""))).isin(wanted) | F.col("id").cast("string").isin(wanted)) if wanted else companies
    return found.orderBy("id").limit(limit) if limit else found


def needs_discovery(c: dict[str, Column], force: Column) -> Column:
    """With a domain, and not known to be reachable at an address."""
    return ~blank(c["domain"]) & (force | blank(c["careers_url"]) | ~c["reachable"].eqNullSafe(F.lit(True)))


def discovery_gate(domain: Column, careers_url: Column, reachable: Column, force: Column) -> Column:
    """Why a company isn't searched again; null if it is."""
    return F.when(blank(domain), "no-domain").when(~force & ~blank(careers_url) & F.coalesce(reachable, F.lit(False)), "already-reachable")


def has_signal(has_job: Column, profile: Column, description: Column, n_spaces: Column, n_verticals: Column, code: Column) -> Column:
    """Whether there is anything to tell a company's category by."""
    long = lambda c: F.length(F.trim(F.coalesce(c, F.lit("")))) >= SIGNAL_LENGTH
    more = lambda n: F.coalesce(n, F.lit(0)) > 0
    return F.coalesce(has_job, F.lit(False)) | long(profile) | long(description) | more(n_spaces) | more(n_verticals) | ~blank(code)


def scrape_outcome(skipped: Column, success: Column) -> Column:
    """(outcome, company_outcome) of a scrape: an equal signature comes before success."""
    yes = lambda c: F.coalesce(c, F.lit(False))
    outcome = F.when(yes(skipped), "skipped").when(yes(success), "success").otherwise("no_result")
    return F.struct(outcome.alias("outcome"), F.when(outcome == "skipped", "skipped_signature_match").otherwise(outcome).alias("company_outcome"))


def categorize_outcome(category: Column) -> Column:
    return F.when(~blank(category) & (category != "None"), "success").otherwise("no_result")


def first_present(c: dict[str, Column], names: tuple[str, ...]) -> Column:
    """The first array that there is, empty or not."""
    return F.coalesce(*(c[n] for n in names))


def run_job_count(c: dict[str, Column]) -> Column:
    """Listings of a run, from the first of its counts, else the size of its first array, else 0."""
    return F.coalesce(*(c[n] for n in COUNTS), *(F.when(c[n].isNotNull(), F.size(c[n])).cast("long") for n in COUNTED), F.lit(0))


def seen_urls(c: dict[str, Column]) -> Column:
    """Addresses of a run: its first array that isn't empty, else none."""
    return F.coalesce(*(F.when(F.size(c[n]) > 0, c[n]) for n in SEEN), F.array().cast("array<string>"))


def active_urls(stored: DataFrame, new: DataFrame) -> DataFrame:
    """(company_id, url): normal addresses of the listings that aren't removed; of a listing that is in both, the new form counts."""
    both = stored.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    last = both.groupBy("company_id", "id").agg(F.max_by(F.struct("url", "removed_at"), F.struct("_new", "ord")).alias("r"))
    url = urls.normalize(F.col("r.url"))
    return last.where(F.col("r.removed_at").isNull()).select("company_id", url.alias("url")).where("url is not null").distinct()


def failure_reason(steps: Column) -> Column:
    """Why a search failed: a timeout in one of its steps comes before a name that wasn't found."""
    says = lambda w: F.exists(steps, lambda s: s.contains(w))
    return F.when(says("timeout"), "timeout").when(says("dns"), "dns_error").otherwise("all_miss")


def discovery_updates(results: DataFrame) -> DataFrame:
    """The columns that a search leaves, of (id, found, url, method, hint_location, steps)."""
    found = F.coalesce("found", F.lit(False))
    on = lambda c: F.when(found, c)
    return results.select(
        "id", on(F.col("url")).alias("careers_url"), found.alias("reachable"),
        F.when(found, F.col("method")).otherwise(F.coalesce(F.nullif("method", F.lit("")), F.lit("not_found"))).alias("method"),
        on(urls.platform_of_url(F.col("url"))).alias("platform"), F.when(~found, failure_reason(F.col("steps"))).alias("failure_reason"),
        F.when(found & (F.col("method") == "profile_hint"), F.col("hint_location")).alias("hint_location"),
    )


def slug_candidates(domain: Column, name: Column) -> Column:
    """Short names that an applicant system may know a company by: of its domain, its name, its name without its last word; three at most."""
    hyphens = lambda c: F.nullif(F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), "^-|-$", ""), F.lit(""))
    base = F.nullif(F.split(F.regexp_replace(urls.domain_probed(domain), r"^www\.", ""), r"\.")[0], F.lit(""))
    short = hyphens(F.trim(F.regexp_replace(F.lower(F.trim(name)), SUFFIXES, "")))
    return F.slice(F.array_distinct(F.array_compact(F.array(base, hyphens(F.trim(name)), short))), 1, 3)


def fingerprints(companies: DataFrame) -> DataFrame:
    """The applicant system of companies (id, domain, careers_url, platform, slug, homepage, careers_page) as their pages tell it.

    The home page comes before the careers page, which is read only if it is another address; a known platform is kept; a
    slug is only added."""
    plain = lambda u: F.lower(F.regexp_replace(u, r"/+$", ""))
    home_url = F.when(~blank(F.col("domain")), F.concat(F.lit("https://"), F.regexp_replace("domain", r"^https?://", ""), F.lit("/")))
    from_home = urls.platform_of_page(F.col("homepage"))
    other = ~blank(F.col("careers_url")) & ~plain(F.col("careers_url")).eqNullSafe(plain(home_url))
    from_careers = F.when(from_home.isNull() & other, urls.platform_of_page(F.col("careers_page")))
    seen = F.coalesce(from_home, from_careers)
    open_ = blank(F.col("platform")) | (F.col("platform") == "custom")
    platform = F.when(open_ & seen.isNotNull(), seen).otherwise(F.col("platform"))
    slug = F.when(~blank(F.col("careers_url")), urls.slug_of_url(F.col("careers_url")))
    new_slug = F.when(blank(F.col("slug")), slug)
    confirmed = F.lower(F.coalesce("careers_url", F.lit(""))).contains(F.lower(F.coalesce(platform, F.lit("?"))))
    return companies.select(
        "id", platform.alias("platform"), F.when(from_home.isNotNull(), "homepage").when(from_careers.isNotNull(), "careers_page").alias("source"),
        F.when(seen.isNotNull(), F.when(confirmed, "url").otherwise("html")).alias("confidence"), F.coalesce(F.nullif("slug", F.lit("")), slug).alias("slug"),
        ((open_ & seen.isNotNull()) | new_slug.isNotNull()).alias("changed"), (~blank(F.col("platform")) & (F.col("platform") != "custom")).alias("known"),
    )


def sanitized(answer: Column) -> Column:
    """A model's answer (a variant) with values that are allowed, as (function, level, relevance, confirmed, reason)."""
    text = lambda p: F.nullif(F.lower(F.trim(F.try_variant_get(answer, p, "string"))), F.lit(""))
    among = lambda c, allowed, other: F.when(c.isin(*allowed), c).otherwise(F.lit(other))
    functions = [*(n for n, _ in classify.FUNCTIONS), "other"]
    levels = [*(n for n, _ in classify.SENIORITIES), "mid", "unknown"]
    said = F.try_variant_get(answer, "$.climate_relevance_confirmed", "string")
    return F.struct(
        among(text("$.job_function"), functions, "other").alias("function"), among(text("$.seniority_level"), levels, "unknown").alias("level"),
        among(text("$.mba_relevance"), RELEVANCES, None).alias("relevance"), F.coalesce(said.isin("true", "True"), F.lit(False)).alias("confirmed"),
        F.nullif(F.trim(F.try_variant_get(answer, "$.climate_relevance_reason", "string")), F.lit("")).alias("reason"),
    )


def enriched(listings: DataFrame, answer: Column) -> DataFrame:
    """Listings (id, title, description, function, relevance, reason) with a model's answer merged in: the rules' verdict comes
    before the answer's, that before what is stored; without a description the answer isn't looked at."""
    rows = listings.withColumn("_m", sanitized(answer)).withColumn("_f", classify.job_function(F.col("title"))).withColumn("_l", classify.seniority(F.col("title")))
    rows = rows.withColumn("_r", classify.relevance(F.col("_f"), F.col("_l")))
    told = ~blank(F.col("description"))
    stored = F.when(F.col("relevance").isin(*RELEVANCES), F.col("relevance")).otherwise(F.lit("low"))
    confirmed = told & F.col("_m.confirmed")
    return rows.select(
        "id", F.coalesce("_f", F.when(told, F.col("_m.function")), "function", F.lit("other")).alias("function"),
        F.coalesce("_l", F.when(told, F.col("_m.level")), F.lit("unknown")).alias("level"),
        F.coalesce("_r", F.when(told, F.col("_m.relevance")), stored).alias("relevance"), confirmed.alias("confirmed"),
        F.when(told & ~confirmed, F.coalesce("_m.reason", F.nullif("reason", F.lit("")))).alias("reason"),
    )


def positional(batches: DataFrame) -> DataFrame:
    """(batch, pos, id, category, error) of batches (batch, ids, answers): the answer at a place belongs to the id at that
    place; if there aren't as many answers as ids, none counts."""
    fits = F.coalesce(F.size("answers") == F.size("ids"), F.lit(False))
    each = batches.select("batch", fits.alias("fits"), "answers", F.posexplode("ids").alias("pos", "id"))
    got = F.when(F.col("fits"), F.get("answers", F.col("pos")))
    missing = F.concat(F.lit("batch result missing for index "), F.col("pos").cast("string"))
    return each.select("batch", "pos", "id", got.alias("category"), F.when(got.isNull(), missing).alias("error"))


def model_category(lane: Column, category: Column, sector: Column, confidence: Column) -> Column:
    """What a model says of a category, as columns: in the lane of ingested companies 'None' for sector and confidence is nothing."""
    ingested = lane == "wrds_medium"
    plain = lambda c: F.when(ingested, F.nullif(F.trim(c), F.lit("None"))).otherwise(F.trim(c))
    return F.struct(
        F.trim(category).alias("category"), plain(sector).alias("sector"), plain(confidence).alias("confidence"),
        F.when(ingested, "llm_wrds").otherwise("llm").alias("resolver"),
    )


def category_details(companies: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Companies (id, category) with sector and area of the first taxonomy row (ord, name, sector, area) of that name."""
    same = lambda c: F.nullif(F.lower(F.trim(c)), F.lit(""))
    first = taxonomy.groupBy(same(F.col("name")).alias("_name")).agg(F.min_by(F.struct("sector", "area"), "ord").alias("_d")).where("_name is not null")
    rows = companies.join(first, same(F.col("category")) == F.col("_name"), "left")
    return rows.select("id", "category", F.nullif("_d.sector", F.lit("")).alias("sector"), F.nullif("_d.area", F.lit("")).alias("area"))


def reset(companies: DataFrame, selected: Column) -> DataFrame:
    """Companies with the stages' columns cleared where selected."""
    return companies.withColumns({c: F.when(~F.coalesce(selected, F.lit(False)), F.col(c)) for c in STAGE_COLUMNS if c in companies.columns})


def appears_in(url: Column, html: Column) -> Column:
    """Whether a page has an address, or its path, as written."""
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    there = F.contains(html, F.when(path == "", F.lit("/")).otherwise(path)) | F.contains(html, url)
    return F.coalesce(url.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://") & there, F.lit(False))


def base_url(url: Column, domain: Column) -> Column:
    """Where a company's pages begin: at its address with that path, else at its domain."""
    u = F.trim(url)
    whole = F.when(u.rlike(r"(?i)^https?://"), u).otherwise(F.concat(F.lit("https://"), u))
    root = F.lower(F.regexp_extract(whole, r"^([A-Za-z]+://[^/?#]+)", 1))
    path = F.regexp_replace(F.regexp_extract(whole, r"^[A-Za-z]+://[^/?#]+([^?#]*)", 1), r"/+$", "")
    host = F.split(F.regexp_replace(domain, r"^https?://", ""), r"[/\s]")[0]
    return F.when(~blank(F.trim(url)), F.concat(root, path, F.lit("/"))).when(~blank(domain), F.concat(F.lit("https://"), host, F.lit("/")))


def latest_hashes(items: DataFrame) -> DataFrame:
    """(company_id, url, description_hash): the last item of an address counts; items are (company_id, ord, url, description)."""
    hashed = F.sha2(F.coalesce("description", F.lit("")), 256)
    return items.where(~blank(F.col("url"))).groupBy("company_id", "url").agg(F.max_by(hashed, "ord").alias("description_hash"))

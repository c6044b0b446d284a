"""Queries over companies and listings: joins, upserts, categories, browsing, summaries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions import classify, lifecycle, text
from tidemark.functions.numbers import model_cost, percent, round_half_up
from tidemark.operators import categorize, compare, report, tabular, upsert
from tidemark.sources.shared import dealt, tasks_for
from tidemark.sources.tables import increment
from tidemark.plans import fixed_sql
from tidemark.plans.model import COMPANIES, EVENTS, JOBS, companies, events, jobs, pick, sql_pick, table

# Messages of failures, by number.
MESSAGES = (
    "HTTP 429 from upstream", "rate limit exceeded", "401 Unauthorized", "ECONNRESET while reading", "request timed out",
    "prompt unavailable for stage", "Unexpected token < in JSON at 0", "Anthropic: credit balance too low", "gemini: permission denied",
    "claude said HTTP 403", "empty result", "something else",
)
STATUSES = (429, 200, 401, 0, 504, 0, 200, 400, 403, 0, 200, 500)


def title_classify(spark, sf_dir):
    """Function and level are told once a title; the relevance follows from these two columns."""
    t = F.col("title")
    told = jobs(spark, sf_dir).select("title", "relevance").distinct().select(
        "title", "relevance", classify.normal_title(t).alias("normal"), classify.job_function(t).alias("function"), classify.seniority(t).alias("seniority"),
        classify.employment(t, F.col("relevance")).alias("employment"),
    )
    told = told.withColumn("mba_relevance", classify.relevance(F.col("function"), F.col("seniority")))
    return jobs(spark, sf_dir).select("id", "title", "relevance").join(told, ["title", "relevance"]).select("id", "normal", "function", "seniority", "employment", "mba_relevance")


def location_kinds(spark, sf_dir):
    place = F.when(F.col("id") % 5 == 0, "Remote, US").when(F.col("id") % 5 == 1, "Hybrid - Berlin").when(F.col("id") % 5 == 2, "").otherwise(F.col("hq"))
    return companies(spark, sf_dir).groupBy(classify.location_kind(place).alias("kind")).agg(F.count("*").alias("n"))


def failure_classify(spark, sf_dir):
    e = events(spark, sf_dir).where("outcome = 'failure'")
    numbers = F.element_at(F.array(*map(F.lit, STATUSES)), (F.col("k") % len(STATUSES) + 1).cast("int"))
    found = classify.failure_class(F.col("stage"), F.nullif(numbers, F.lit(0)), pick(MESSAGES, F.col("k")))
    return e.groupBy("stage", found.alias("failure_class"), found.isin(*classify.TRANSIENT).alias("transient")).agg(F.count("*").alias("n"))


def split_delimited(spark, sf_dir):
    raw = F.concat_ws("", "p_name", F.lit(" ; "), "p_brand", F.lit(",|"), "p_type", F.lit(" ,"))
    parts = text.split_delimited(raw)
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(parts, "/").alias("parts"), F.size(parts).cast("long").alias("n"))


def slugs(spark, sf_dir):
    name = F.concat(F.lit(" "), F.regexp_replace("c_name", "#", " & #"), F.lit("  Inc. "))
    return table(spark, sf_dir, "customer").select("c_custkey", text.slugify(name).alias("slug"), text.deterministic_id(name).alias("id"))


def description_hashes(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select(
        "doc_id", text.text_hash(F.col("text")).alias("description_hash"),
        F.sha2(F.concat(F.coalesce("text", F.lit("")), F.lit("|"), F.coalesce("source", F.lit(""))), 256).alias("id"),
        text.employment_code(F.when(F.col("doc_id") % 3 == 0, "Part-Time").when(F.col("doc_id") % 3 == 1, "Seasonal").otherwise("CONTRACT")).alias("employment"),
    )


REQUIRED = ("function", "level", "relevance", "title", "employment", "location", "confirmed")


def needs_enrichment(spark, sf_dir):
    """Documents whose stored hash is another, whose version is old, that miss one of the required fields, or that were asked for; and, when
    only errors are tried again, those with one."""
    k = F.col("doc_id")
    d = table(spark, sf_dir, "documents").select("*", *(F.when(k % (40 + i) != 0, "x").alias(c) for i, c in enumerate(REQUIRED)))
    stored = F.when(k % 4 == 0, F.lit("old")).otherwise(text.text_hash(F.col("text")))
    due = classify.needs_enrichment(
        force=k % 23 == 0, version=F.when(k % 9 == 0, "v1").otherwise("v2"), current="v2", stored_hash=stored, text_hash=text.text_hash(F.col("text")), required=[F.col(c) for c in REQUIRED]
    )
    return d.groupBy("source").agg(F.count_if(due).alias("due"), F.count_if(k % 13 == 0).alias("errors"), F.count("*").alias("n"))


def jobs_with_companies(spark, sf_dir):
    """Browse rows: climate-relevant listings by function, with company name and place."""
    c = companies(spark, sf_dir).where("id % 10 <> 0")
    j = jobs(spark, sf_dir).join(c.withColumnRenamed("id", "c_id"), F.col("company_id") == F.col("c_id"), "left")
    return j.select(
        "id", "title", F.coalesce("name", F.lit("Unknown Company")).alias("company"), F.coalesce("sector", F.lit("Unknown")).alias("industry"),
        F.coalesce("hq", F.lit("Unknown")).alias("location"), classify.job_function(F.col("title")).alias("function"),
        classify.seniority(F.col("title")).alias("seniority"), (F.col("relevance") == "1-URGENT").alias("climate"),
    )


def jobs_browse(spark, sf_dir):
    found = F.lower("title").contains("manager") | F.lower("company").contains("9")
    return jobs_with_companies(spark, sf_dir).where(found & F.col("climate") & F.col("function").isin("product", "operations", "marketing"))


def jobs_browse_page(spark, sf_dir):
    """The third page of twenty."""
    return jobs_browse(spark, sf_dir).orderBy("id").offset(40).limit(20).select("id", "title", "company")


def record_search(spark, sf_dir):
    c = companies(spark, sf_dir)
    whole = F.lower(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}))
    return c.where(whole.contains("build")).groupBy("sector").agg(F.count("*").alias("n"))


def facets(spark, sf_dir):
    j = jobs_with_companies(spark, sf_dir)
    one = lambda kind: j.where(F.coalesce(kind, F.lit("")) != "").select(F.lit(kind).alias("facet"), F.col(kind).alias("value")).distinct()
    return one("function").unionByName(one("seniority"))


def reachable_no_jobs(spark, sf_dir):
    c = companies(spark, sf_dir).where("employees > 0")
    listed = jobs(spark, sf_dir).where("title not like '%Manager%' and status <> 'F'").select("company_id")
    return c.join(listed, F.col("id") == F.col("company_id"), "left_anti").select("id", "name")


def processed_mark_removed(spark, sf_dir):
    """Listings of processed companies that weren't seen since the start of the run are removed."""
    done = companies(spark, sf_dir).where("id % 2 = 0").select(F.col("id").alias("company_id"))
    start = F.lit("1997-01-01").cast("timestamp")
    marked = F.coalesce(~F.col("removed") & (F.col("last_seen_at") < start), F.lit(False))
    return jobs(spark, sf_dir).join(done, "company_id", "left_semi").select("id", "company_id", marked.alias("removed_now"))


def rep_job(spark, sf_dir):
    """A company's first listing, or its first one that is enriched."""
    w = Window.partitionBy("company_id").orderBy(F.col("status") == "O", "id")
    return jobs(spark, sf_dir).withColumn("rn", F.row_number().over(w)).where("rn = 1").select("company_id", "id", "title")


def first5_samples(spark, sf_dir):
    w = Window.partitionBy("company_id").orderBy("id")
    j = jobs(spark, sf_dir).withColumn("rn", F.row_number().over(w)).where("rn <= 5")
    return j.groupBy("company_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rn", "title"))), lambda x: x["title"]), "|").alias("samples"))


def _listings(spark, sf_dir):
    """Documents as listings; several share an address, some have none."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", text.text_hash(F.col("text")).alias("description_hash"))
    url = F.when(F.col("doc_id") % 7 == 0, F.lit(None)).otherwise(F.concat(F.lit("https://x/"), (F.col("doc_id") * 13 % 401).cast("string")))
    seen = F.timestamp_seconds(F.lit(1_500_000_000) + F.col("doc_id") * 7919 % 1_000_000)
    return d.select(
        F.col("doc_id").alias("ord"), url.alias("url"), "description_hash", F.when(F.col("doc_id") % 5 == 0, "").otherwise(F.col("lang")).alias("title"),
        seen.alias("first_seen_at"), seen.alias("last_seen_at"), F.when(F.col("doc_id") % 4 == 0, seen).alias("removed_at"),
    )


def merge_jobs(spark, sf_dir):
    """Listings of earlier runs, some of them first seen after now, several at one address; and new ones."""
    rows = _listings(spark, sf_dir)
    late = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("ord"))
    old = rows.where("ord % 3 = 0").withColumn("first_seen_at", F.when(F.col("ord") % 5 == 0, late).when(F.col("ord") % 11 == 0, F.lit(None)).otherwise(F.col("first_seen_at")))
    now = F.timestamp_seconds(F.lit(1_600_000_000))
    new = rows.where("ord % 3 <> 0").withColumn("first_seen_at", now).withColumn("last_seen_at", now).withColumn("removed_at", F.lit(None).cast("timestamp"))
    new = new.withColumn("description_hash", F.when(F.col("ord") % 4 == 1, F.lit("same")).otherwise(F.col("description_hash")))
    old = old.withColumn("description_hash", F.when(F.col("ord") % 4 == 3, F.lit("same")).otherwise(F.col("description_hash")))
    out = upsert.merge_jobs(old, new, now)
    return out.select(
        "ord", "url", "title", F.unix_seconds("first_seen_at").alias("first_seen"), F.unix_seconds("last_seen_at").alias("last_seen"), F.col("removed_at").isNotNull().alias("removed")
    )


def earliest_per_key(spark, sf_dir):
    return upsert.earliest_per_url(_listings(spark, sf_dir)).select("ord", "url")


def upsert_companies(spark, sf_dir):
    """Suppliers upserted into customers, twice each: by a domain where there is one, else by id."""
    dom = lambda c: F.when(c % 3 == 0, F.concat(F.lit("D"), c.cast("string"), F.lit(".com")))
    deal = lambda day, kind, size: F.struct(F.lit(day).alias("date"), F.lit(kind).alias("deal_type"), size.cast("double").alias("size"))
    k = F.col("c_custkey")
    c = table(spark, sf_dir, "customer").select(
        k.alias("id"), dom(k).alias("domain"), F.when(k % 2 == 0, F.col("c_name")).alias("name"), F.col("c_acctbal").alias("size_mm"), F.when(k % 4 == 0, F.array(deal("d1", "seed", k))).alias("deals")
    )
    s = table(spark, sf_dir, "supplier").crossJoin(F.broadcast(spark.range(2).withColumnRenamed("id", "turn")))  # two rows
    k, t = F.col("s_suppkey"), F.col("turn")
    s = s.select(
        (k * 1000 + t).alias("ord"), (k * 7).alias("id"), F.lower(dom(k * 3 * F.when(k % 4 == 0, 100_000).otherwise(1))).alias("domain"), F.concat("s_name", t.cast("string")).alias("name"),
        F.when((k + t) % 5 != 0, F.col("s_acctbal") + t).alias("size_mm"), F.when(t == 1, F.array(deal("d1", "seed", k), deal("d2", "A", k))).otherwise(F.array(deal("d2", "A", -k))).alias("deals"),
    )
    s = s.withColumn("domain", F.when(F.col("id") % 2 == 0, F.col("domain")))
    out = upsert.merge_companies(c, s, keep_existing=["name"], take_incoming=["size_mm"], signals="deals")
    deals = F.array_join(F.transform(F.coalesce("deals", F.array()), lambda d: F.concat_ws(":", d["date"], d["deal_type"], d["size"].cast("long").cast("string"))), "|")
    return out.select("id", "domain", "name", "size_mm", deals.alias("deals"), "action")


def funding_dedupe(spark, sf_dir):
    """Of the lines with one kind and size, the one with the most fields, the first among equals."""
    rows = table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"), F.col("l_suppkey").alias("company_id"), F.lower("l_returnflag").alias("deal"),
        F.floor("l_quantity").cast("long").alias("size"), F.when(F.col("l_linenumber") > 2, F.col("l_shipdate")).alias("date"),
        F.when(F.col("l_orderkey") % 2 == 0, F.col("l_tax")).alias("raised"),
    )
    return upsert.fullest(rows, ["company_id", "deal", "size"], ["date", "raised"]).select("ord", "company_id", "deal", "size")


def high_water_mark(spark, sf_dir):
    mark = F.coalesce(F.max("o_orderdate"), F.lit("1970-01-01").cast("timestamp_ntz"))
    return table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(F.date_format(mark, "yyyy-MM-dd HH:mm:ss").alias("mark"))


def incremental_page(spark, sf_dir):
    """All rows after a mark under the dynamic filter, with the page of 500 on which each is read, by date, then key."""
    o = table(spark, sf_dir, "orders")
    keep = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "5-LOW") & (
        F.col("o_totalprice").isNull() | (F.col("o_totalprice") <= 300000)
    )
    like = F.col("o_orderpriority").ilike("%urg%") | F.col("o_orderpriority").ilike("%high%")
    return increment(o.where(keep & like), F.lit("1995-06-01").cast("timestamp_ntz"), at="o_orderdate", key="o_orderkey").select("o_orderkey", "o_custkey", "page")


def scout_distinct(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    one = lambda c: p.where(F.trim(c) != "").select(F.lit(c).alias("name"), F.col(c).alias("value")).distinct().orderBy("value").limit(500)
    return one("p_brand").unionByName(one("p_type")).unionByName(one("p_name"))


def _company_keywords(spark, sf_dir):
    """What companies bought, dealt by company; each shuffle's tasks take as many rows however many there are."""
    o, li, p = (table(spark, sf_dir, t) for t in ("orders", "lineitem", "part"))
    n = tasks_for(spark, li.count(), 500_000)
    named = li.select("l_orderkey", "l_partkey").repartition(n, "l_partkey").join(p.select("p_partkey", "p_name").repartition(n, "p_partkey"), F.col("l_partkey") == F.col("p_partkey"))
    named = named.select("l_orderkey", F.col("p_name").alias("keyword")).repartition(n, "l_orderkey")
    bought = o.select("o_orderkey", "o_custkey").repartition(n, "o_orderkey").join(named, F.col("o_orderkey") == F.col("l_orderkey"))
    return bought.select(F.col("o_custkey").alias("company_id"), "keyword").repartition(n, "company_id")


def keyword_rule(spark, sf_dir):
    taxonomy = table(spark, sf_dir, "part").select(F.col("p_type").alias("category"), F.col("p_name").alias("keyword"))
    return categorize.keyword_rule(_company_keywords(spark, sf_dir), taxonomy)


def _tagged(spark, sf_dir):
    return companies(spark, sf_dir).select(
        "id", F.array("sector", "hq").alias("spaces"), F.array(F.concat(F.lit("v"), F.col("id") % 9), F.concat(F.lit("v"), F.col("id") % 4)).alias("verticals"),
        F.when(F.col("id") % 3 != 0, F.col("id")).alias("source_id"), F.repeat("name", F.lit(1) + (F.col("id") % 8).cast("int")).alias("description"),
    )


ENTRIES = (("spaces", "building", "Built"), ("spaces", "machinery", None), ("spaces", "japan", "Asia"), ("verticals", "v3", "Three"), ("verticals", "v1", "One"))


def dictionary_cascade(spark, sf_dir):
    entries = spark.createDataFrame(list(ENTRIES), "section string, key string, category string")
    found = categorize.dictionary_cascade(_tagged(spark, sf_dir), entries, [("spaces", "spaces"), ("verticals", "verticals")])
    return categorize.lane(found).select("id", "category", "hint", "section", "resolver")


TAXONOMY_ENTRIES = (
    (1, "spaces", "Building", "Built"), (2, "spaces", "machinery", None), (3, "verticals", "V3", "Old"), (4, "verticals", " v3 ", "Three"), (5, "codes", "c5", "Code"),
    (6, "codes", "c4", None), (7, "groups", "g2", "Group"), (8, "unused", "g3", "Not"),
)
SECTIONS = [("spaces", "spaces", "high"), ("verticals", "verticals", "high"), ("codes", "code", "medium"), ("groups", "group", "low")]


def taxonomy_cascade(spark, sf_dir):
    """Spaces, verticals, code, group, then keywords of what a company bought."""
    c = _tagged(spark, sf_dir).select("id", "spaces", "verticals", F.concat(F.lit("C"), (F.col("id") % 7).cast("string")).alias("code"), F.when(F.col("id") % 3 != 0, F.concat(F.lit("g"), (F.col("id") % 5).cast("string"))).alias("group"))
    entries = spark.createDataFrame(list(TAXONOMY_ENTRIES), "ord int, section string, key string, category string")
    taxonomy = table(spark, sf_dir, "part").select(F.col("p_type").alias("category"), F.col("p_name").alias("keyword"))
    return categorize.taxonomy_cascade(c, entries, SECTIONS, _company_keywords(spark, sf_dir), taxonomy)


def token_shortlist(spark, sf_dir):
    part = table(spark, sf_dir, "part").withColumnRenamed("p_type", "category")
    names = part.select("category").distinct()  # the taxonomy's names alone are put in order
    names = names.select("category", (F.row_number().over(Window.orderBy("category")) - 1).cast("long").alias("ord"))
    tokens = part.select("category", F.explode(F.split(F.lower("p_name"), " ")).alias("token"))
    words = dealt(table(spark, sf_dir, "part"), "p_partkey").select(F.col("p_partkey").alias("id"), F.when(F.col("p_partkey") % 50 == 0, "none").otherwise(F.col("p_name")).alias("text"))
    return categorize.shortlist(words, names, tokens, 3).select("id", "category", "score")


def telemetry_summary_sets(spark, sf_dir):
    """Model calls: overall, by agent, by model."""
    c = table(spark, sf_dir, "conversations").select(
        F.col("role").alias("agent"), F.concat(F.lit("m"), F.col("turn") % 2).alias("model"), F.length("text").cast("long").alias("chars"), (F.length("text") % 1000).cast("long").alias("ms")
    )
    disc = lambda p: F.expr(f"cast(percentile_disc({p}) within group (order by ms) as long)")
    return c.groupingSets([[], ["agent"], ["model"]], "agent", "model").agg(
        F.count("*").alias("calls"), round_half_up(F.avg("ms")).alias("avg_ms"), disc(0.5).alias("p50"), disc(0.95).alias("p95"), disc(0.99).alias("p99"),
        model_cost(F.sum("chars"), F.sum("ms")).alias("cost"),
    )


def stage_tally(spark, sf_dir):
    """Companies by the stage that they wait for; every stage has a row."""
    i = F.col("id")
    on = lambda m, v="2026-01-01": F.when(i % m != 0, v)
    c = companies(spark, sf_dir).select(
        on(13).alias("wrds_last_updated"), on(7).alias("profile_attempted_at"), on(5).alias("careers_page_discovery_method"),
        F.when(i % 6 == 0, False).when(i % 6 < 4, True).alias("careers_page_reachable"), on(8).alias("fingerprint_attempted_at"),
        on(9).alias("last_scraped_at"), F.when(i % 11 == 0, "skipped_signature_match").otherwise("success").alias("last_scrape_outcome"),
        on(10).alias("last_extracted_at"), on(3).alias("last_enriched_at"), on(2).alias("category_attempted_at"), F.when(i % 17 == 0, "x").otherwise("").alias("climate_tech_category"),
    )
    counts = c.groupBy(lifecycle.stage_of().alias("stage")).agg(F.count("*").alias("n"))
    every = spark.createDataFrame([(s,) for s in lifecycle.STAGES], "stage string")
    return every.join(counts, "stage", "left").select("stage", F.coalesce("n", F.lit(0)).alias("n"))


def qa_profile(spark, sf_dir):
    """Quality of the enriched listings; some have no level, an error, no verdict or a tier in another spelling."""
    k = F.col("id")
    j = jobs_with_companies(spark, sf_dir).select(
        F.col("title").alias("title_normalized"), "function", F.when(k % 3 != 0, F.col("seniority")).alias("seniority"), F.when(k % 7 != 0, F.col("climate")).alias("climate"),
        F.when(k % 4 == 1, "timeout").when(k % 4 == 2, "").alias("error"), F.when(k % 5 == 0, "High").when(k % 5 == 1, "low").when(k % 5 == 2, "MEDIUM").when(k % 5 == 3, "maybe").alias("relevance"),
    )
    return report.quality_of_listings(j)


def relevance_summary(spark, sf_dir):
    return jobs_with_companies(spark, sf_dir).groupBy(F.coalesce("function", F.lit("unknown")).alias("function"), "seniority").agg(F.count("*").alias("n"))


def scrape_summary(spark, sf_dir):
    """Scrapes by outcome, method and status code."""
    e, k = events(spark, sf_dir).where("stage = 'scrape'"), F.col("k")
    rows = e.select(
        F.when(k % 11 != 0, F.col("outcome") == "success").alias("success"), pick(("Greenhouse_API", "direct_html", "lever_api", "", "sitemap", "Playwright_HTML"), k).alias("method"),
        (F.col("outcome") == "skipped").alias("skipped"), F.when(k % 3 != 0, F.when(k % 5 == 0, 404).otherwise(200)).alias("status_code"), F.when(k % 4 != 0, k * 300).alias("n_bytes"),
    )
    return report.scrape_summary(rows)


def run_compare(spark, sf_dir):
    """Two labellings of the same companies: how many labels stayed, by what decided them."""
    c, k = companies(spark, sf_dir), F.col("id")
    before = c.where("id % 7 <> 0").select("id", F.when(k % 4 == 0, " ").otherwise(F.col("sector")).alias("category"), F.when(k % 3 == 0, F.col("hq")).alias("area"))
    after = c.where("id % 5 <> 0").select(
        "id", F.when(k % 8 != 0, F.when(k % 6 == 0, "Other").otherwise(F.col("sector"))).alias("category"), F.when(k % 3 == 0, F.col("hq")).otherwise("").alias("area"), pick(("rule", "", "llm", None), k).alias("resolver")
    )
    return compare.labellings(before, after, ("category", "area"))


def header_of_cell(spark, sf_dir):
    """Cells of table rows under the nearest header of their page."""
    li = table(spark, sf_dir, "lineitem")
    cells = li.select(
        F.col("l_orderkey").alias("page"), F.lit(1).alias("row"), (F.floor("l_extendedprice") % 400).cast("double").alias("left"), F.when(F.col("l_linenumber") != 3, F.concat(F.lit(" c"), F.col("l_linenumber").cast("string"))).otherwise(" ").alias("text")
    )
    names = F.posexplode(F.array(*map(F.lit, ("name", "website", "size", "hq")))).alias("ord", "name")
    heads = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("page"), names)
    heads = heads.withColumn("left", F.element_at(F.array(*map(F.lit, (0, 110, 190, 300))), F.col("ord") + 1) + F.col("page") % 30)
    return tabular.under_headers(cells, heads)


def added_items(spark, sf_dir):
    """Ids that the later list has and the earlier hasn't."""
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("item_id")).exceptAll(table(spark, sf_dir, "benchmark").select("item_id"))


FN, SEN = (x.replace("(t,", "(lower(title),") for x in (fixed_sql.FUNCTIONS, fixed_sql.LEVELS))
JC = f"""WITH {JOBS}, {COMPANIES}, jc AS (SELECT jobs.id, title, coalesce(c.name, 'Unknown Company') AS company, coalesce(sector, 'Unknown') AS industry,
  coalesce(hq, 'Unknown') AS location, {FN} AS function, {SEN} AS seniority, relevance = '1-URGENT' AS climate
  FROM jobs LEFT JOIN (SELECT * FROM companies WHERE id % 10 <> 0) c ON company_id = c.id) """
PCT2 = "floor(CAST({a} AS DOUBLE) / count(*) * 100.0 * 100 + 0.5) / 100"
p2 = lambda a: PCT2.format(a=f"count(*) FILTER ({a})")
M = sql_pick(MESSAGES, "k")
ST = f"nullif(list_extract({list(STATUSES)}, CAST(k % {len(STATUSES)} AS INT) + 1), 0)"
L = """WITH l AS (SELECT doc_id AS ord, CASE WHEN doc_id % 7 <> 0 THEN 'https://x/' || (doc_id * 13 % 401) END AS url, sha256(coalesce(text, '')) AS h,
  CASE WHEN doc_id % 5 = 0 THEN '' ELSE lang END AS title, 1500000000 + doc_id * 7919 % 1000000 AS seen, doc_id % 4 = 0 AS removed FROM documents) """

SQL = {
    "title_classify": f"""WITH {JOBS}, t AS (SELECT *, {FN} AS fn, {SEN} AS sen FROM jobs) SELECT id, {fixed_sql.NORMAL_TITLE} AS normal, fn AS function, sen AS seniority,
  {fixed_sql.EMPLOYMENTS.replace("(t,", "(lower(title || ' ' || relevance),")} AS employment, {fixed_sql.RELEVANCE} AS mba_relevance FROM t""",
    "location_kinds": f"WITH {COMPANIES} SELECT CASE id % 5 WHEN 0 THEN 'remote' WHEN 1 THEN 'hybrid' WHEN 2 THEN 'unknown' ELSE 'on_site' END AS kind, count(*) AS n FROM companies GROUP BY 1",
    "failure_classify": f"""WITH {EVENTS}, f AS (SELECT stage, {ST} AS status, lower({M}) AS m FROM ev WHERE outcome = 'failure'),
c AS (SELECT stage, CASE WHEN contains(m, 'rate limit') OR contains(m, 'too many requests') OR coalesce(status = 429, false) THEN 'rate_limit'
  WHEN regexp_matches(m, 'unauthorized|forbidden|api key') OR coalesce(status IN (401, 403), false) THEN 'auth' WHEN regexp_matches(m, 'aborterror|timeout|timed out') THEN 'timeout'
  WHEN contains(m, 'econnreset') THEN 'transient_network' WHEN contains(m, 'prompt unavailable') THEN 'config' WHEN contains(m, 'json') AND contains(m, 'unexpected') THEN 'bad_data'
  WHEN contains(m, 'anthropic') AND contains(m, 'credit') THEN 'unknown' WHEN contains(m, 'claude') AND contains(m, 'http 403') THEN 'auth'
  WHEN stage = 'extract' AND contains(m, 'empty') THEN 'bad_data' ELSE 'unknown' END AS failure_class FROM f)
SELECT stage, failure_class, failure_class IN {fixed_sql.TRANSIENT} AS transient, count(*) AS n FROM c GROUP BY ALL""",
    "split_delimited": "SELECT p_partkey, trim(p_name) || '/' || trim(p_brand) || '/' || trim(p_type) AS parts, 3::BIGINT AS n FROM part",
    "slugs": r"""WITH n AS (SELECT c_custkey, ' ' || regexp_replace(c_name, '#', ' & #') || '  Inc. ' AS name FROM customer),
s AS (SELECT *, regexp_replace(lower(trim(regexp_replace(name, '[^\w\s-]', '', 'g'))), '[-\s]+', '-', 'g') AS slug FROM n)
SELECT c_custkey, slug, slug || '-' || substr(sha1(name), 1, 10) AS id FROM s""",
    "description_hashes": """SELECT doc_id, sha256(coalesce(text, '')) AS description_hash, sha256(coalesce(text, '') || '|' || coalesce(source, '')) AS id,
  CASE doc_id % 3 WHEN 0 THEN 'part_time' WHEN 1 THEN 'full_time' ELSE 'contract' END AS employment FROM documents""",
    "needs_enrichment": """SELECT source, count(*) FILTER (doc_id % 23 = 0 OR doc_id % 9 = 0 OR doc_id % 4 = 0 OR doc_id % 40 = 0 OR doc_id % 41 = 0 OR doc_id % 42 = 0 OR doc_id % 43 = 0 OR doc_id % 44 = 0 OR doc_id % 45 = 0 OR doc_id % 46 = 0) AS due,
  count(*) FILTER (doc_id % 13 = 0) AS errors, count(*) AS n FROM documents GROUP BY source""",
    "jobs_browse": JC + "SELECT * FROM jc WHERE (contains(lower(title), 'manager') OR contains(lower(company), '9')) AND climate AND function IN ('product', 'operations', 'marketing')",
    "jobs_browse_page": JC + """SELECT id, title, company FROM jc WHERE (contains(lower(title), 'manager') OR contains(lower(company), '9')) AND climate
  AND function IN ('product', 'operations', 'marketing') ORDER BY id LIMIT 20 OFFSET 40""",
    "record_search": f"WITH {COMPANIES} SELECT sector, count(*) AS n FROM companies WHERE contains(lower(to_json(companies)::VARCHAR), 'build') GROUP BY sector",
    "facets": JC + "SELECT DISTINCT 'function' AS facet, function AS value FROM jc WHERE function <> '' UNION ALL SELECT DISTINCT 'seniority', seniority FROM jc WHERE seniority <> ''",
    "reachable_no_jobs": f"WITH {COMPANIES}, {JOBS} SELECT id, name FROM companies WHERE employees > 0 AND id NOT IN (SELECT company_id FROM jobs WHERE title NOT LIKE '%Manager%' AND status <> 'F')",
    "processed_mark_removed": f"WITH {JOBS} SELECT id, company_id, coalesce(NOT removed AND last_seen_at < TIMESTAMP '1997-01-01', false) AS removed_now FROM jobs WHERE company_id IN (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0)",
    "rep_job": f"WITH {JOBS} SELECT company_id, id, title FROM (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY status = 'O', id) AS rn FROM jobs) WHERE rn = 1",
    "first5_samples": f"WITH {JOBS} SELECT company_id, string_agg(title, '|' ORDER BY rn) AS samples FROM (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY id) AS rn FROM jobs) WHERE rn <= 5 GROUP BY 1",
    "merge_jobs": """WITH l AS (SELECT doc_id AS ord, CASE WHEN doc_id % 7 <> 0 THEN 'https://x/' || (doc_id * 13 % 401) END AS url, doc_id % 3 <> 0 AS fresh,
  CASE WHEN CASE WHEN doc_id % 3 = 0 THEN doc_id % 4 = 3 ELSE doc_id % 4 = 1 END THEN 'same' ELSE sha256(coalesce(text, '')) END AS h, CASE WHEN doc_id % 5 = 0 THEN '' ELSE lang END AS title,
  1500000000 + doc_id * 7919 % 1000000 AS seen, doc_id % 4 = 0 AS gone FROM documents),
x AS (SELECT *, CASE WHEN fresh THEN 1600000000 WHEN ord % 5 = 0 THEN 1700000000 + ord WHEN ord % 11 <> 0 THEN seen END AS f0, CASE WHEN fresh THEN 1600000000 ELSE seen END AS l0 FROM l),
o AS (SELECT *, min(ord) OVER k AS place, row_number() OVER (PARTITION BY coalesce(url, ''), h ORDER BY ord DESC) AS r FROM x WHERE NOT fresh WINDOW k AS (PARTITION BY coalesce(url, ''), h)),
e AS (SELECT *, coalesce(f0, l0) AS t FROM o WHERE r = 1),
n AS (SELECT x.*, e.ord IS NOT NULL AS hit, row_number() OVER (PARTITION BY coalesce(x.url, ''), x.h ORDER BY x.ord) AS r,
  first_value(nullif(x.title, '') IGNORE NULLS) OVER (PARTITION BY coalesce(x.url, ''), x.h ORDER BY x.ord ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS ft
  FROM x LEFT JOIN e ON coalesce(x.url, '') = coalesce(e.url, '') AND x.h = e.h WHERE x.fresh),
best AS (SELECT url, arg_min(h, (t, place)) AS h, arg_min(t, (t, place)) AS t FROM e WHERE url IS NOT NULL GROUP BY url),
odd AS (SELECT url, arg_min(h, ord) AS h FROM n WHERE url IS NOT NULL AND NOT hit GROUP BY url),
win AS (SELECT coalesce(best.url, odd.url) AS url, CASE WHEN best.url IS NULL OR odd.url IS NOT NULL AND 1600000000 < best.t THEN odd.h ELSE best.h END AS h, odd.url IS NOT NULL AS other FROM best FULL JOIN odd ON best.url = odd.url
  UNION ALL SELECT NULL, h, false FROM (SELECT h FROM e WHERE url IS NULL UNION SELECT h FROM n WHERE url IS NULL))
SELECT coalesce(e.ord, n.ord) AS ord, win.url, coalesce(nullif(CASE WHEN e.ord IS NOT NULL THEN e.title ELSE n.title END, ''), n.ft) AS title, coalesce(CASE WHEN e.ord IS NOT NULL THEN e.f0 ELSE n.f0 END, 1600000000) AS first_seen,
  CASE WHEN n.ord IS NOT NULL OR win.other THEN 1600000000 ELSE e.l0 END AS last_seen, NOT (n.ord IS NOT NULL OR win.other) AND e.gone AS removed
FROM win LEFT JOIN e ON coalesce(win.url, '') = coalesce(e.url, '') AND win.h = e.h LEFT JOIN (SELECT * FROM n WHERE r = 1) n ON coalesce(win.url, '') = coalesce(n.url, '') AND win.h = n.h""",
    "earliest_per_key": L + "SELECT ord, url FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY seen, ord) AS rn FROM l) WHERE rn = 1 OR url IS NULL",
    "upsert_companies": """WITH c AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN 'D' || c_custkey || '.com' END AS domain, CASE WHEN c_custkey % 2 = 0 THEN c_name END AS name, c_acctbal AS size_mm,
  CASE WHEN c_custkey % 4 = 0 THEN ['d1:seed:' || c_custkey] ELSE [] END AS deals FROM customer),
s AS (SELECT s_suppkey * 1000 + t AS ord, s_suppkey * 7 AS id, CASE WHEN s_suppkey * 7 % 2 = 0 THEN 'd' || (s_suppkey * 3 * CASE WHEN s_suppkey % 4 = 0 THEN 100000 ELSE 1 END) || '.com' END AS domain, s_name || t AS name,
  CASE WHEN (s_suppkey + t) % 5 <> 0 THEN s_acctbal + t END AS size_mm, s_suppkey AS k FROM supplier, range(2) AS r(t)),
m AS (SELECT s.*, coalesce(d.id, i.id) AS target FROM s LEFT JOIN c d ON s.domain = lower(d.domain) LEFT JOIN c i ON s.id = i.id),
g AS (SELECT target, CASE WHEN target IS NULL THEN coalesce(domain, CAST(id AS VARCHAR)) END AS own, arg_min(id, ord) AS id, arg_min(domain, ord) AS domain, arg_min(name, ord) AS name, arg_max(size_mm, ord) FILTER (size_mm IS NOT NULL) AS size_mm,
  arg_min(-k, ord) AS a_size, arg_min(k, ord) AS seed_size FROM m GROUP BY 1, 2)
SELECT c.id, coalesce(c.domain, g.domain) AS domain, coalesce(c.name, g.name) AS name, coalesce(g.size_mm, c.size_mm) AS size_mm, CASE WHEN g.id IS NULL THEN array_to_string(c.deals, '|') ELSE
  array_to_string(list_concat(c.deals, list_concat(['d2:A:' || a_size], CASE WHEN len(c.deals) = 0 THEN ['d1:seed:' || seed_size] ELSE [] END)), '|') END AS deals, CASE WHEN g.id IS NULL THEN 'kept' ELSE 'updated' END AS action
FROM c LEFT JOIN g ON c.id = g.target UNION ALL SELECT id, domain, name, size_mm, 'd2:A:' || a_size || '|d1:seed:' || seed_size, 'added' FROM g WHERE target IS NULL""",
    "funding_dedupe": """SELECT ord, company_id, deal, size FROM (SELECT *, row_number() OVER (PARTITION BY company_id, deal, size ORDER BY (d IS NOT NULL)::INT + (r IS NOT NULL)::INT DESC, ord) AS rn FROM (
  SELECT l_orderkey * 10 + l_linenumber AS ord, l_suppkey AS company_id, lower(l_returnflag) AS deal, CAST(floor(l_quantity) AS BIGINT) AS size,
  CASE WHEN l_linenumber > 2 THEN l_shipdate END AS d, CASE WHEN l_orderkey % 2 = 0 THEN l_tax END AS r FROM lineitem)) WHERE rn = 1""",
    "high_water_mark": "SELECT o_orderstatus, strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') AS mark FROM orders GROUP BY 1",
    "incremental_page": """SELECT o_orderkey, o_custkey, CAST(ceil(row_number() OVER (ORDER BY o_orderdate, o_orderkey) / 500.0) AS BIGINT) AS page FROM orders
WHERE o_orderdate > TIMESTAMP '1995-06-01' AND o_orderpriority IN ('1-URGENT', '2-HIGH', '5-LOW') AND (o_totalprice IS NULL OR o_totalprice <= 300000) AND (o_orderpriority ILIKE '%urg%' OR o_orderpriority ILIKE '%high%')""",
    "scout_distinct": " UNION ALL ".join(f"(SELECT DISTINCT '{c}' AS name, {c} AS value FROM part WHERE trim({c}) <> '' ORDER BY value LIMIT 500)" for c in ("p_brand", "p_type", "p_name")),
    "keyword_rule": """WITH c AS (SELECT DISTINCT o_custkey AS company_id, lower(p_name) AS keyword FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey),
t AS (SELECT DISTINCT p_type AS category, lower(p_name) AS keyword FROM part),
s AS (SELECT company_id, category, count(*) AS score FROM c JOIN t USING (keyword) GROUP BY 1, 2), r AS (SELECT *, rank() OVER (PARTITION BY company_id ORDER BY score DESC) AS rk FROM s)
SELECT company_id, CASE WHEN count(*) = 1 THEN min(category) END AS category, max(score) AS score FROM r WHERE rk = 1 GROUP BY 1""",
    "dictionary_cascade": f"""WITH {COMPANIES}, t AS (SELECT id, lower(sector) AS s1, lower(hq) AS s2, 'v' || (id % 9) AS v1, 'v' || (id % 4) AS v2, id % 3 <> 0 AS src, length(name) * (1 + id % 8) AS len FROM companies),
d AS (SELECT *, CASE WHEN s1 IN ('building', 'machinery', 'japan') THEN s1 WHEN s2 IN ('building', 'machinery', 'japan') THEN s2 END AS sp,
  CASE WHEN v1 IN ('v3', 'v1') THEN v1 WHEN v2 IN ('v3', 'v1') THEN v2 END AS ve FROM t)
SELECT id, CASE coalesce(sp, ve) WHEN 'building' THEN 'Built' WHEN 'japan' THEN 'Asia' WHEN 'v3' THEN 'Three' WHEN 'v1' THEN 'One' END AS category, coalesce(sp, ve) IS NOT NULL AS hint,
  CASE WHEN sp IS NOT NULL THEN 'spaces' WHEN ve IS NOT NULL THEN 'verticals' END AS section,
  CASE WHEN coalesce(sp, ve) IS NOT NULL THEN 'wrds_fast' WHEN src AND len >= 80 THEN 'wrds_medium' ELSE 'cold' END AS resolver FROM d""",
    "taxonomy_cascade": f"""WITH {COMPANIES}, c AS (SELECT DISTINCT o_custkey AS company_id, lower(p_name) AS keyword FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey),
t AS (SELECT DISTINCT p_type AS category, lower(p_name) AS keyword FROM part),
s AS (SELECT company_id, category, count(*) AS score FROM c JOIN t USING (keyword) GROUP BY 1, 2), r AS (SELECT *, rank() OVER (PARTITION BY company_id ORDER BY score DESC) AS rk FROM s),
k AS (SELECT company_id, CASE WHEN count(*) = 1 THEN min(category) END AS rule FROM r WHERE rk = 1 GROUP BY 1),
d AS (SELECT id, rule, CASE WHEN lower(sector) IN ('building', 'machinery') THEN 'spaces' WHEN id % 9 = 3 OR id % 4 = 3 THEN 'verticals' WHEN id % 7 IN (4, 5) THEN 'codes' WHEN id % 3 <> 0 AND id % 5 = 2 THEN 'groups' END AS section,
  lower(sector) = 'machinery' OR id % 7 = 4 AND lower(sector) <> 'building' AND NOT (id % 9 = 3 OR id % 4 = 3) AS hint FROM companies LEFT JOIN k ON id = company_id)
SELECT id, CASE WHEN hint THEN NULL WHEN section IS NULL THEN rule ELSE CASE section WHEN 'spaces' THEN 'Built' WHEN 'verticals' THEN 'Three' WHEN 'codes' THEN 'Code' ELSE 'Group' END END AS category,
  CASE WHEN hint THEN NULL WHEN section IS NULL THEN CASE WHEN rule IS NOT NULL THEN 'high' END WHEN section = 'codes' THEN 'medium' WHEN section = 'groups' THEN 'low' ELSE 'high' END AS confidence,
  coalesce(section, CASE WHEN rule IS NOT NULL THEN 'rule' END) AS resolver, hint FROM d""",
    "token_shortlist": """WITH t AS (SELECT p_type AS category, dense_rank() OVER (ORDER BY p_type) - 1 AS ord, unnest(string_split(lower(p_name), ' ')) AS token FROM part),
w AS (SELECT category, ord, token, count(*) AS w FROM t GROUP BY ALL),
c AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 50 = 0 THEN 'none' ELSE p_name END AS text FROM part),
k AS (SELECT DISTINCT id, unnest(string_split(lower(text), ' ')) AS token FROM c), s AS (SELECT id, category, ord, sum(w)::BIGINT AS score FROM k JOIN w USING (token) GROUP BY ALL)
SELECT id, category, score FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, ord) AS rn FROM s) WHERE rn <= 3
UNION ALL SELECT id, category, 0 FROM c, (SELECT DISTINCT category FROM t) WHERE id NOT IN (SELECT id FROM s)""",
    "telemetry_summary_sets": """WITH c AS (SELECT role AS agent, 'm' || (turn % 2) AS model, length(text) AS chars, length(text) % 1000 AS ms FROM conversations)
SELECT agent, model, count(*) AS calls, floor(avg(ms) + 0.5) AS avg_ms, quantile_disc(ms, 0.5)::BIGINT AS p50, quantile_disc(ms, 0.95)::BIGINT AS p95, quantile_disc(ms, 0.99)::BIGINT AS p99,
  floor((sum(chars) / 4.0::DOUBLE * 0.075::DOUBLE + sum(ms) / 4.0::DOUBLE * 0.30::DOUBLE) / 1e6 * 10000 + 0.5) / 10000 AS cost FROM c GROUP BY GROUPING SETS ((), (agent), (model))""",
    "stage_tally": """WITH c AS (SELECT CASE WHEN c_custkey % 13 = 0 AND c_custkey % 7 = 0 THEN 'wrds_ingest' WHEN c_custkey % 7 = 0 THEN 'profile' WHEN c_custkey % 5 = 0 THEN 'discovery'
  WHEN c_custkey % 6 = 0 THEN CASE WHEN c_custkey % 2 = 0 AND c_custkey % 17 <> 0 THEN 'categorize' ELSE 'done' END WHEN c_custkey % 8 = 0 THEN 'fingerprint' WHEN c_custkey % 9 = 0 THEN 'scrape'
  WHEN c_custkey % 11 = 0 THEN CASE WHEN c_custkey % 2 = 0 AND c_custkey % 17 <> 0 THEN 'categorize' ELSE 'done' END WHEN c_custkey % 10 = 0 THEN 'extract' WHEN c_custkey % 3 = 0 THEN 'enrich'
  WHEN c_custkey % 2 = 0 AND c_custkey % 17 <> 0 THEN 'categorize' ELSE 'done' END AS stage FROM customer),
s AS (SELECT unnest(['wrds_ingest', 'profile', 'discovery', 'fingerprint', 'scrape', 'extract', 'enrich', 'categorize', 'done']) AS stage)
SELECT s.stage, count(c.stage) AS n FROM s LEFT JOIN c USING (stage) GROUP BY 1""",
    "qa_profile": JC + f""", q AS (SELECT title, function, CASE WHEN id % 3 <> 0 THEN seniority END AS s, CASE WHEN id % 7 <> 0 THEN climate END AS c, id % 4 = 1 AS err, CASE id % 5 WHEN 0 THEN 'high' WHEN 1 THEN 'low' WHEN 2 THEN 'medium' ELSE 'unknown' END AS b,
  id % 5 = 4 AS no_tier FROM jc)
SELECT count(*) AS n, count(*) FILTER (err) AS errors, {p2("err")} AS errors_pct, count(*) FILTER (title IS NULL OR function IS NULL OR s IS NULL OR no_tier OR c IS NULL) AS incomplete,
  {p2("title IS NULL OR function IS NULL OR s IS NULL OR no_tier OR c IS NULL")} AS incomplete_pct, count(*) FILTER (b = 'low') AS low, count(*) FILTER (b = 'medium') AS medium, count(*) FILTER (b = 'high') AS high,
  count(*) FILTER (b = 'unknown') AS unknown, count(*) FILTER (c) AS climate, count(*) FILTER (NOT c) AS not_climate, {p2("c")} AS climate_pct,
  count(*) FILTER (err) > 0.2 * count(*) AS warn_errors, NOT {p2("c")} BETWEEN 10 AND 90 AS warn_climate, count(*) FILTER (s IS NULL) > 0.3 * count(*) AS warn_seniority FROM q""",
    "relevance_summary": JC + "SELECT coalesce(function, 'unknown') AS function, seniority, count(*) AS n FROM jc GROUP BY ALL",
    "scrape_summary": f"""WITH {EVENTS}, r AS (SELECT k % 11 <> 0 AND outcome = 'success' AS ok, outcome = 'skipped' AS skipped, CASE k % 6 WHEN 0 THEN 'greenhouse_api' WHEN 1 THEN 'direct_html' WHEN 2 THEN 'lever_api' WHEN 3 THEN 'unknown' WHEN 4 THEN 'sitemap' ELSE 'playwright_html' END AS m,
  CASE WHEN k % 3 = 0 THEN 'unknown' WHEN k % 5 = 0 THEN '404' ELSE '200' END AS st, k % 4 <> 0 AND k * 300 < 5120 AS small FROM ev WHERE stage = 'scrape'),
u AS (SELECT 'outcome' AS kind, 'total' AS key FROM r UNION ALL SELECT 'outcome', CASE WHEN ok THEN 'success' ELSE 'error' END FROM r UNION ALL SELECT 'outcome', 'skipped_signature_match' FROM r WHERE skipped
  UNION ALL SELECT 'outcome', 'small_body' FROM r WHERE small UNION ALL SELECT 'method', m FROM r UNION ALL SELECT 'status', st FROM r),
z AS (SELECT 'outcome' AS kind, unnest(['total', 'success', 'error', 'skipped_signature_match', 'small_body']) AS key UNION ALL SELECT 'method', unnest(['greenhouse_api', 'lever_api', 'ashby_api', 'workday_api', 'playwright_html', 'direct_html'])),
c AS (SELECT kind, key, count(*) AS n FROM u GROUP BY 1, 2) SELECT coalesce(c.kind, z.kind) AS kind, coalesce(c.key, z.key) AS key, coalesce(n, 0) AS n FROM c FULL JOIN z ON c.kind = z.kind AND c.key = z.key""",
    "run_compare": f"""WITH {COMPANIES}, b AS (SELECT id, CASE WHEN id % 4 <> 0 THEN sector END AS bc, CASE WHEN id % 3 = 0 THEN hq END AS ba, CASE WHEN id % 8 <> 0 THEN CASE WHEN id % 6 = 0 THEN 'Other' ELSE sector END END AS ac,
  CASE id % 4 WHEN 0 THEN 'rule' WHEN 2 THEN 'llm' ELSE 'unknown' END AS resolver FROM companies WHERE id % 7 <> 0 AND id % 5 <> 0)
SELECT resolver, count(*) AS n, count(*) FILTER (bc IS NOT DISTINCT FROM ac) AS same, count(*) FILTER (bc IS DISTINCT FROM ac) AS changed FROM b GROUP BY 1""",
    "header_of_cell": """WITH c AS (SELECT l_orderkey AS page, l_linenumber AS n, CAST(floor(l_extendedprice) AS BIGINT) % 400 AS x, row_number() OVER () AS rid FROM lineitem WHERE l_linenumber <> 3),
h AS (SELECT * FROM (VALUES (0, 'name', 0), (1, 'website', 110), (2, 'size', 190), (3, 'hq', 300)) AS v(i, name, x0)),
d AS (SELECT c.*, name, abs(x - x0 - page % 30) AS d, row_number() OVER (PARTITION BY rid ORDER BY abs(x - x0 - page % 30), i) AS rn FROM c, h)
SELECT page, 1::INT AS row, name AS header, string_agg('c' || n, ' ' ORDER BY x, n) AS text FROM d WHERE rn = 1 AND d < 40 GROUP BY 1, 3""",
    "added_items": "SELECT doc_id AS item_id FROM documents EXCEPT ALL SELECT item_id FROM benchmark",
}
QUERIES = {k: globals()[k] for k in SQL}

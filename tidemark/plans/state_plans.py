"""Queries over what stages do to companies and listings: gates, updates, merges, and their summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import text, urls
from tidemark.functions.lifecycle import blank
from tidemark.functions.numbers import delta_text, percent, round_half_up
from tidemark.operators import report, states
from tidemark.plans import fixed_sql
from tidemark.plans.model import COMPANIES, EVENTS, JOBS, STATE, companies, company_state, events, jobs, pick, sql_pick, table

ANSWERS = (
    '{"job_function":" Sales ","seniority_level":"VP","mba_relevance":"HIGH","climate_relevance_confirmed":"True","climate_relevance_reason":"x"}',
    '{"job_function":"wizard","seniority_level":"boss","mba_relevance":"some","climate_relevance_confirmed":false,"climate_relevance_reason":" why "}',
    '{"climate_relevance_confirmed":true}', "{}", "no json",
)
HOMEPAGES = ("<a href='https://jobs.lever.co/x'>", "<p>nothing</p>", None, '<div id="grnhse_app"></div>', "<p>plain</p>")


def _cols(*names):
    return {n: F.col(n) for n in names}


def valid_companies(spark, sf_dir):
    """F01"""
    k = F.col("id")
    c = companies(spark, sf_dir).select(
        F.when(k % 9 == 0, F.lit(" EXAMPLE ")).otherwise(k.cast("string")).alias("id"), F.when(k % 10 == 0, " ").when(k % 7 == 0, "Example").otherwise(F.col("name")).alias("name")
    )
    return states.validated(c)


def target_selection(spark, sf_dir):
    """F03"""
    return states.targeted(companies(spark, sf_dir), [" customer#000000012", "7", "19", "CUSTOMER#000000005 "], 3).select("id", "name")


def needs_discovery(spark, sf_dir):
    """F05, F23, F24"""
    c = company_state(spark, sf_dir)
    due = states.needs_discovery(_cols("domain", "careers_url", "reachable"), F.col("id") % 23 == 0)
    return c.select("id", due.alias("due"), F.col("reachable").eqNullSafe(F.lit(True)).alias("loaded"), blank(F.col("method")).alias("backfill"))


def stage_gates(spark, sf_dir):
    """F14, F15"""
    force = F.col("id") % 19 == 0
    listed = jobs(spark, sf_dir).select("company_id").distinct().withColumn("listed", F.lit(True))
    c = company_state(spark, sf_dir).join(listed, F.col("id") == F.col("company_id"), "left")
    profile = F.repeat("name", (F.col("id") % 7).cast("int"))
    signal = states.has_signal(F.col("listed"), profile, F.lit(None), F.col("n_spaces"), F.lit(0), F.when(F.col("id") % 5 == 0, "c").otherwise(""))
    return c.select(
        "id", states.discovery_gate(F.col("domain"), F.col("careers_url"), F.col("reachable"), force).alias("discovery"),
        F.when(~F.coalesce("reachable", F.lit(False)), "unreachable").alias("scrape"), F.when(~force & ~blank(F.col("category")), "categorized").alias("category"),
        F.when(~signal, "insufficient_signal").alias("signal"),
    )


def scrape_outcomes(spark, sf_dir):
    """P19, P20, X42"""
    k = F.col("id")
    c = company_state(spark, sf_dir).select(
        states.scrape_outcome(F.when(k % 4 == 0, k % 8 == 0), k % 3 != 0).alias("o"), states.categorize_outcome(F.col("category")).alias("categorized"), (k % 6).alias("agent")
    )
    return c.groupBy("o.outcome", "o.company_outcome", "categorized", "agent").agg(F.count("*").alias("n"))


def _runs(spark, sf_dir):
    """Runs that keep their count and addresses under one name or another."""
    k = F.col("seq")
    made = lambda n: F.transform(F.sequence(F.lit(1), n.cast("int")), lambda i: F.concat(F.lit("u"), i.cast("string")))
    some = lambda m, r, n: F.when(k % m == r, F.when(n > 0, made(n)).otherwise(F.array().cast("array<string>")))
    return events(spark, sf_dir).select(
        "seq", F.when(k % 9 == 0, k % 4).alias("job_count"), F.when(k % 7 == 0, k % 5).alias("count"), F.when(k % 11 == 0, k % 3).alias("jobs_count"),
        some(5, 0, k % 3).alias("jobs"), some(4, 1, k % 2).alias("job_urls"), some(3, 2, k % 4).alias("seen_urls"), some(8, 3, k % 6).alias("found_jobs"),
        some(13, 6, k % 5).alias("urls"), some(10, 7, k % 3).alias("found_urls"),
    )


def run_counts(spark, sf_dir):
    """D05, D06"""
    r = _runs(spark, sf_dir)
    c = _cols(*states.COUNTS, *states.COUNTED)
    return r.select("seq", states.run_job_count(c).cast("long").alias("n_jobs"), F.array_join(states.seen_urls(c), ",").alias("seen"))


def active_urls(spark, sf_dir):
    """U04"""
    k = F.col("id")
    url = lambda a: F.concat(F.lit("HTTPS://Jobs.example.com/"), (k % 40).cast("string"), F.lit(a))
    gone = F.lit("2024-01-01").cast("timestamp")
    j = jobs(spark, sf_dir).select("company_id", "id", k.alias("ord"))
    stored = j.withColumn("url", F.when(k % 6 != 0, url("/#top"))).withColumn("removed_at", F.when(k % 4 == 0, gone))
    new = j.where(k % 5 == 0).withColumn("url", url("?page=2")).withColumn("removed_at", F.when(k % 15 == 0, gone))
    return states.active_urls(stored, new)


ATS = ("greenhouse", "lever", "ashby", "workday", "custom", "unknown")


def discovery_summary(spark, sf_dir):
    """A02"""
    low = F.lower(F.coalesce("platform", F.lit("unknown")))
    ats = F.coalesce(*(F.when(low.contains(a), F.lit(a)) for a in ATS[:4]), F.when(low == "unknown", "unknown").otherwise("custom"))
    c = company_state(spark, sf_dir).select(F.coalesce("reachable", F.lit(False)).alias("ok"), F.coalesce("method", F.lit("unknown")).alias("method"), ats.alias("ats"))
    counts = c.groupingSets([[], ["method"], ["ats"]], "method", "ats").agg(
        F.grouping_id().alias("g"), F.count("*").alias("n"), F.count_if("ok").alias("reachable"), percent(F.count_if("ok"), F.count("*")).alias("pct")
    )
    kind = F.when(F.col("g") == 3, "all").when(F.col("g") == 1, "method").otherwise("ats")
    found = counts.select(kind.alias("kind"), F.coalesce("method", "ats", F.lit("")).alias("key"), "n", "reachable", "pct")
    zero = spark.createDataFrame([("ats", a) for a in ATS], "kind string, key string").join(found, ["kind", "key"], "left_anti")
    return found.unionByName(zero.select("kind", "key", F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("reachable"), F.lit(0.0).alias("pct")))


def extraction_totals(spark, sf_dir):
    """A03, and the distribution of relevance of A04"""
    k = F.col("id")
    j = jobs(spark, sf_dir).select(
        (k % 3 != 0).alias("enriched"), (k % 50 == 0).alias("error"), F.when(k % 7 == 0, "").otherwise(F.col("title")).alias("title"), F.when(k % 4 != 0, "d").alias("text"),
        (F.col("relevance") == "1-URGENT").alias("climate"), pick(("HIGH", "low", "Medium", "odd", None), k).alias("tier"),
    )
    tier = F.lower(F.coalesce("tier", F.lit("")))
    n = F.count("*")
    return j.agg(
        n.alias("total_jobs"), F.count_if("enriched").alias("enriched"), F.count_if("error").alias("errors"), percent(F.count_if("error"), n).alias("error_pct"),
        F.count_if(blank(F.col("title"))).alias("missing_title"), F.count_if(blank(F.col("text"))).alias("missing_description"), percent(F.count_if("climate"), n).alias("climate_pct"),
        *(F.count_if(tier == t).alias(t) for t in states.RELEVANCES), F.count_if(~tier.isin(*states.RELEVANCES)).alias("unknown"),
    )


def discovery_status(spark, sf_dir):
    """A15"""
    c = company_state(spark, sf_dir).where(~blank(F.col("domain")))
    ok, no, done = F.col("reachable").eqNullSafe(F.lit(True)), F.col("reachable").eqNullSafe(F.lit(False)), ~blank(F.col("method"))
    reason = F.when(no, F.coalesce(F.nullif("failure_reason", F.lit("")), F.lit("unclassified")))
    key = F.when(ok, F.concat(F.lit("method:"), F.coalesce("method", F.lit("unknown")))).otherwise(F.concat(F.lit("failure:"), reason))
    parts = c.where(ok | no).groupBy(key.alias("key")).agg(F.count("*").alias("n"), F.lit(None).cast("double").alias("hit_pct"))
    total = c.agg(F.count_if(done).alias("processed"), F.count_if(ok).alias("ok"), F.count_if(no).alias("missed"), F.count_if(~done).alias("open"))
    rate = percent(F.col("ok"), F.col("processed"))
    rows = F.inline(F.array(*(F.struct(F.lit(k).alias("key"), F.col(c).alias("n"), r.alias("hit_pct")) for k, c, r in (
        ("processed", "processed", rate), ("reachable", "ok", F.lit(None).cast("double")), ("not_found", "missed", F.lit(None).cast("double")), ("unprocessed", "open", F.lit(None).cast("double"))))))
    return total.select(rows).unionByName(parts)


def discovery_runs(spark, sf_dir):
    """What a run found, by method; every method has a row."""
    c = company_state(spark, sf_dir).where(states.needs_discovery(_cols("domain", "careers_url", "reachable"), F.lit(True)))
    found = c.where("reachable is not null").groupBy(F.when(F.col("reachable"), F.col("method")).otherwise("not_found").alias("method")).agg(F.count("*").alias("n"))
    every = spark.createDataFrame([(m,) for m in ("profile_hint", "standard_pattern", "ats_slug", "homepage_link_scan", "sitemap", "playwright_scan", "not_found")], "method string")
    return every.join(found, "method", "full").select("method", F.coalesce("n", F.lit(0)).alias("n"))


def discovery_updates(spark, sf_dir):
    """P25, X34"""
    k = F.col("id")
    steps = F.array(F.lit("head"), F.when(k % 4 == 0, "get: timeout").when(k % 6 == 0, "dns lookup").otherwise("404"))
    r = company_state(spark, sf_dir).where("method is not null").select(
        "id", F.col("reachable").alias("found"), F.col("careers_url").alias("url"), F.when(k % 8 != 5, F.col("method")).alias("method"), F.lit("footer").alias("hint_location"), steps.alias("steps")
    )
    return states.discovery_updates(r)


def slug_candidates(spark, sf_dir):
    """X34"""
    name = F.concat(F.lit(" "), F.col("name"), pick((" Inc.", " Energy", "", " Labs", " & Sons co"), F.col("id")), F.lit(" "))
    c = company_state(spark, sf_dir)
    return c.select("id", F.array_join(states.slug_candidates(F.col("domain"), F.when(F.col("id") % 29 != 0, name)), "|").alias("slugs"))


def _pages(spark, sf_dir):
    k = F.col("id")
    return company_state(spark, sf_dir).select(
        "id", F.when(k % 3 == 2, F.concat(F.lit("www."), F.col("slug"), F.lit(".com/Careers"))).otherwise(F.col("domain")).alias("domain"), "careers_url", "platform",
        F.when(k % 5 == 0, F.col("slug")).alias("slug"), pick(HOMEPAGES, k).alias("homepage"),
        F.when(k % 4 == 0, "<script src='https://jobs.ashbyhq.com/embed'></script>").when(k % 4 == 1, "<i>x.recruitee.com</i>").alias("careers_page"),
    )


def fingerprint_merge(spark, sf_dir):
    """P28, X07"""
    return states.fingerprints(_pages(spark, sf_dir))


def fingerprint_summary(spark, sf_dir):
    """A28"""
    f = states.fingerprints(_pages(spark, sf_dir))
    return f.groupBy(F.coalesce("platform", F.lit("unknown")).alias("platform")).agg(
        F.count("*").alias("n"), F.count_if("known").alias("known"), F.count_if("changed").alias("updated"), F.count_if(F.col("source").isNotNull()).alias("detected")
    )


def enrich_merge(spark, sf_dir):
    """X20, X21"""
    k = F.col("id")
    j = jobs(spark, sf_dir).select(
        "id", "title", F.when(k % 5 != 0, F.when(k % 7 == 0, "").otherwise("text")).alias("description"), F.when(k % 3 == 0, "stored").alias("function"),
        pick(("high", "odd", None), k).alias("relevance"), F.when(k % 2 == 0, "old reason").alias("reason"), F.try_parse_json(pick(ANSWERS, k)).alias("answer"),
    )
    return states.enriched(j, F.col("answer"))


def batch_positions(spark, sf_dir):
    """J15, P23"""
    c = companies(spark, sf_dir).select(F.floor(F.col("id") / 8).alias("batch"), "id", F.when(F.col("id") % 13 != 0, F.col("sector")).alias("answer"))
    b = c.groupBy("batch").agg(F.array_sort(F.collect_list(F.struct("id", "answer"))).alias("r"))
    answers = F.transform("r", lambda x: x["answer"])
    answers = F.when(F.col("batch") % 5 == 0, F.slice(answers, 1, 3)).otherwise(answers)
    got = states.positional(b.select("batch", F.transform("r", lambda x: x["id"]).alias("ids"), answers.alias("answers")))
    return got.select("id", "category", F.lit(None).cast("string").alias("sector"), F.when(F.col("category").isNotNull(), "llm_batch").alias("resolver"), "error")


def model_categories(spark, sf_dir):
    """P31, P27"""
    k = F.col("id")
    said = states.model_category(F.coalesce(F.nullif("source", F.lit("")), F.lit("cold")), F.col("category"), pick((" None", "Power ", None), k), pick(("None", "high"), k))
    stand_in = F.coalesce(F.nullif(F.trim(F.when(k % 3 == 0, F.concat(F.lit(" "), F.col("slug")))), F.lit("")), F.nullif(F.when(k % 2 == 0, "about").otherwise(""), F.lit("")), F.col("name"))
    return company_state(spark, sf_dir).select("id", said.alias("s"), stand_in.alias("stand_in")).select("id", "s.*", "stand_in")


TAXONOMY = ((1, "SOLAR ", "Energy", ""), (2, "solar", "Other", "Sun"), (3, "Wind", "Energy", "Air"), (4, " ", "None", "None"), (5, "Storage", "", "Grid"))


def category_details(spark, sf_dir):
    """J12"""
    taxonomy = spark.createDataFrame(list(TAXONOMY), "ord int, name string, sector string, area string")
    return states.category_details(company_state(spark, sf_dir), taxonomy)


def category_to_jobs(spark, sf_dir):
    """Listings with their company's category, their own fields of that kind dropped, and the page that a sink has of the company."""
    c = company_state(spark, sf_dir)
    known = c.where(~blank(F.col("category"))).select(F.col("id").alias("c_id"), "category", F.nullif("source", F.lit("")).alias("source"))
    pages = c.where("id % 3 = 0").select(F.col("id").alias("p_id"), F.concat(F.lit("page-"), F.col("id").cast("string")).alias("page_id"))
    j = jobs(spark, sf_dir).withColumn("category", F.lit("stale")).drop("category").select("id", "company_id")
    return j.join(known, F.col("company_id") == F.col("c_id"), "left").join(pages, F.col("company_id") == F.col("p_id"), "left").select("id", "company_id", "category", "source", "page_id")


def state_reset(spark, sf_dir):
    """The stages' columns of the selected companies cleared, as rows of the explorer."""
    c = company_state(spark, sf_dir).select("id", "name", "domain", F.col("category").alias("climate_tech_category"), F.col("platform").alias("ats_platform"), F.col("reachable").alias("careers_page_reachable"))
    shown = lambda x: F.coalesce(F.nullif(x, F.lit("")), F.lit("N/A"))
    r = states.reset(c, F.col("id") % 2 == 0)
    return r.select("id", shown("name").alias("name"), shown("domain").alias("domain"), shown("climate_tech_category").alias("category"), "ats_platform", "careers_page_reachable")


def report_compare(spark, sf_dir):
    """Model calls by agent in two runs, agents of either."""
    c = table(spark, sf_dir, "conversations").select(F.concat_ws("/", "role", (F.col("turn") % 4).cast("string")).alias("agent"), "conv_id", "turn", (F.length("text") % 1000).cast("long").alias("ms"))
    one = lambda df, x: df.groupBy("agent").agg(F.count("*").alias(f"calls_{x}"), round_half_up(F.avg("ms")).alias(f"avg_{x}"))
    both = one(c.where("conv_id % 2 = 0 and turn % 4 <> 1"), "a").join(one(c.where("conv_id % 2 = 1 and turn % 4 <> 2"), "b"), "agent", "full")
    zero = lambda x: F.coalesce(x, F.lit(0))
    return both.select(
        "agent", zero("calls_a").alias("calls_a"), zero("calls_b").alias("calls_b"), F.coalesce("avg_a", F.lit(0.0)).alias("avg_a"), F.coalesce("avg_b", F.lit(0.0)).alias("avg_b"),
        delta_text(zero("calls_a").cast("double"), zero("calls_b").cast("double")).alias("delta"),
    )


def extract_paths(spark, sf_dir):
    """A11, A29"""
    path = pick(("adapter", "llm", None, "xml_or_sitemap", "json", "adapter"), F.col("seq"))
    e = events(spark, sf_dir).where("stage = 'extract'").groupBy(F.coalesce(path, F.lit("(missing)")).alias("path")).agg(F.count("*").alias("n"))
    share = F.sum(F.when(F.col("path") == "adapter", F.col("n")).otherwise(0)).over(report.everything()), F.sum(F.when(F.col("path").isin("adapter", "llm"), F.col("n")).otherwise(0)).over(report.everything())
    return e.select("path", "n", percent(*share).alias("adapter_share"))


def enrichment_tally(spark, sf_dir):
    """A24"""
    j = enrich_merge(spark, sf_dir).where("id % 50 <> 0")
    n = F.count("*")
    return j.agg(
        n.alias("enriched"), *(F.count_if(F.col("relevance") == t).alias(t) for t in states.RELEVANCES), F.count_if("confirmed").alias("climate_true"),
        percent(F.count_if("confirmed"), n).alias("true_pct"), percent(F.count_if(~F.col("confirmed")), n).alias("false_pct"),
    )


def latencies(spark, sf_dir):
    """Latencies by agent, as counts, so no list grows with the calls."""
    ms = (F.length("text") % 1000).cast("long")
    return table(spark, sf_dir, "conversations").groupBy(F.col("role").alias("agent"), ms.alias("ms")).agg(F.count("*").alias("n"))


def dashboard_totals(spark, sf_dir):
    """Counters of every stage, 0 where there is none, and the totals."""
    e = events(spark, sf_dir).where("stage <> 'enrich'")
    counts = e.groupBy("stage").agg(
        F.count("*").alias("started"), report.of("success").alias("completed"), report.of("no_result").alias("no_result"), report.of("failure").alias("failed"), report.of("skipped").alias("skipped")
    )
    every = spark.createDataFrame([(s,) for s in ("profile", "discovery", "fingerprint", "scrape", "extract", "enrich", "categorize")], "stage string")
    names = ("started", "completed", "no_result", "failed", "skipped")
    full = every.join(counts, "stage", "left").select("stage", *(F.coalesce(n, F.lit(0)).alias(n) for n in names))
    total = full.agg(*(F.sum(n).alias(n) for n in names)).select(F.lit("all").alias("stage"), *names)
    return full.unionByName(total).withColumn("processed", F.col("completed") + F.col("failed"))


def recent_failures(spark, sf_dir):
    """Of the last 60 events of every stage, failures by class, and whether a provider is to be looked at."""
    e = report.last_per_key(events(spark, sf_dir), "stage", "seq", 60).where("outcome = 'failure'")
    kind = pick(("rate_limit", "timeout", "auth", "bad_data"), F.col("k"))
    return e.groupBy("stage", kind.alias("failure_class")).agg(F.count("*").alias("n"), (F.count("*") >= 2).alias("alert"))


def url_in_page(spark, sf_dir):
    """F12"""
    p = table(spark, sf_dir, "pages").select("page_id", F.when(F.col("page_id") % 6 == 0, "not an address").otherwise(F.col("url")).alias("url"), F.concat("html", F.when(F.col("page_id") % 4 == 0, F.col("url")).otherwise("")).alias("html"))
    return p.select("page_id", states.appears_in(F.col("url"), F.col("html")).alias("there"))


def profile_bases(spark, sf_dir):
    """X46"""
    k = F.col("id")
    url = F.when(k % 3 == 0, F.concat(F.lit(" "), F.upper("slug"), F.lit(".com/About//?q=1"))).when(k % 3 == 1, "").otherwise(F.col("careers_url"))
    return company_state(spark, sf_dir).select("id", states.base_url(url, F.when(k % 2 == 0, F.concat(F.lit("https://"), F.col("domain"), F.lit("/x"))).otherwise(F.col("domain"))).alias("base"))


def artifact_hashes(spark, sf_dir):
    """P26"""
    d = table(spark, sf_dir, "documents").select(
        (F.col("doc_id") % 97).alias("company_id"), F.col("doc_id").alias("ord"), F.when(F.col("doc_id") % 8 != 0, F.concat(F.lit("https://x/"), (F.col("doc_id") % 41).cast("string"))).alias("url"), F.col("text").alias("description")
    )
    return states.latest_hashes(d)


def refresh_targets(spark, sf_dir):
    """Targets with the merged table's values, and the companies that are new to them."""
    merged = company_state(spark, sf_dir).where("id % 5 <> 1").select("id", "domain")
    targets = companies(spark, sf_dir).where("id % 3 <> 0").select("id", F.lit("old").alias("stored"))
    both = targets.join(merged.withColumn("_there", F.lit(True)), "id", "full")
    value = F.when(F.col("_there"), F.col("domain")).otherwise(F.col("stored"))
    return both.select("id", value.alias("domain"), F.when(F.col("stored").isNull(), "enqueued").when(F.col("_there"), "refreshed").otherwise("kept").alias("action"))


def run_stages(spark, sf_dir):
    """The known stages that a run asks for, each once, and whether that is less than all of them."""
    known = F.array(*map(F.lit, ("profile", "discovery", "scrape")))
    asked = F.transform(F.split(pick(("scrape, profile,scrape", "bogus", "profile,discovery,scrape", "", " discovery "), F.col("id")), ","), lambda x: F.trim(x))
    stages = F.array_intersect(asked, known)
    return companies(spark, sf_dir).select("id", F.when((F.size(stages) > 0) & (F.size(stages) < 3), F.array_join(stages, ",")).alias("stages"))


def newest_reports(spark, sf_dir):
    """Of the reports of a tag the newest by name."""
    name = F.concat(F.lit("tag"), (F.col("k") % 5).cast("string"), F.lit("-"), F.date_format("ts", "yyyyMMdd-HHmmss"), F.lit(".json"))
    tag = F.regexp_extract("name", "^(tag[0-9])-", 1)
    return events(spark, sf_dir).select(name.alias("name")).groupBy(tag.alias("tag")).agg(F.max("name").alias("newest"))


def baseline_snapshots(spark, sf_dir):
    """Totals of a baseline that wraps them or has them flat; null for anything else."""
    k = F.col("seq")
    whole = F.concat(F.lit('{"totalHtmlOnly":'), k.cast("string"), F.lit(',"adapterHit":'), (k % 7).cast("string"))
    raw = (
        F.when(k % 4 == 0, F.concat(F.lit('{"headroom":'), whole, F.lit("}}"))).when(k % 4 == 1, F.concat(F.lit('{"htmlAdapterCompanies":5,"headroom":'), whole, F.lit("}}")))
        .when(k % 4 == 2, F.concat(whole, F.lit("}"))).when(k % 8 == 3, '{"adapterHit":1}').otherwise("broken")
    )
    v = F.try_parse_json(raw)
    at = lambda p: F.try_variant_get(v, p, "long")
    flat = at("$.totalHtmlOnly").isNotNull() & at("$.adapterHit").isNotNull()
    total = F.coalesce(at("$.headroom.totalHtmlOnly"), F.when(flat, at("$.totalHtmlOnly")))
    hits = F.when(total.isNotNull(), F.coalesce(at("$.htmlAdapterCompanies"), at("$.headroom.adapterHit"), at("$.adapterHit")))
    return events(spark, sf_dir).select("seq", total.alias("total"), hits.alias("hits"))


def row_errors(spark, sf_dir):
    """Rows mapped with what went wrong as a column, and the first ten errors of each kind by order."""
    size = F.when(F.col("p_partkey") % 9 == 0, "n/a").otherwise(F.col("p_size").cast("string"))
    p = table(spark, sf_dir, "part").select("p_partkey", size.try_cast("int").alias("size"), F.when(size.try_cast("int").isNull(), F.concat(F.lit("bad size: "), size)).alias("error"), "p_brand")
    return report.first_per_key(p.where("error is not null"), "p_brand", "p_partkey", 10).select("p_brand", "p_partkey", "error")


PCT = "CASE WHEN ({b}) = 0 THEN 0.0 ELSE floor(CAST(({a}) AS DOUBLE) / ({b}) * 100.0 * 10 + 0.5) / 10 END"
pct = lambda a, b: PCT.format(a=a, b=b)
S = f"WITH {STATE} "
E = f"WITH {EVENTS} "
B = lambda c: f"coalesce({c}, '') = ''"
ENRICHED = f"""WITH {JOBS}, a AS (SELECT id, lower(title) AS t, id % 5 AS m, CASE WHEN id % 5 <> 0 AND id % 7 <> 0 THEN 'text' END AS d, CASE id % 3 WHEN 0 THEN 'high' WHEN 1 THEN 'odd' END AS old, id % 2 = 0 AS even FROM jobs),
f AS (SELECT *, {fixed_sql.FUNCTIONS} AS fn, {fixed_sql.LEVELS} AS lv FROM a),
r AS (SELECT *, CASE WHEN fn IS NULL OR lv = 'unknown' THEN NULL WHEN fn IN ('strategy', 'finance', 'product', 'legal', 'policy') AND lv IN ('mid', 'senior', 'staff', 'director', 'vp', 'c_suite') THEN 'high'
  WHEN lv = 'intern' THEN 'low' WHEN fn IN ('engineering', 'hr', 'customer_success') AND lv = 'entry' THEN 'low' ELSE 'medium' END AS rel FROM f),
en AS (SELECT id, coalesce(fn, CASE WHEN d IS NOT NULL THEN 'other' END, CASE WHEN id % 3 = 0 THEN 'stored' END, 'other') AS function, lv AS level,
  coalesce(rel, CASE WHEN d IS NOT NULL AND m = 0 THEN 'high' END, CASE WHEN old = 'high' THEN old ELSE 'low' END) AS relevance, d IS NOT NULL AND m IN (0, 2) AS confirmed,
  CASE WHEN d IS NOT NULL AND m NOT IN (0, 2) THEN CASE WHEN m = 1 THEN 'why' WHEN even THEN 'old reason' END END AS reason FROM r) """
FINGER = S + """, h AS (SELECT id, careers_url, platform, CASE WHEN id % 3 = 2 THEN 'www.' || slug || '.com/Careers' ELSE domain END AS domain, CASE WHEN id % 5 = 0 THEN slug END AS own, slug,
  CASE id % 5 WHEN 0 THEN 'lever' WHEN 3 THEN 'greenhouse' END AS home, CASE id % 4 WHEN 0 THEN 'ashby' WHEN 1 THEN 'recruitee' END AS page FROM cs),
g AS (SELECT *, CASE WHEN home IS NULL AND careers_url IS NOT NULL AND (coalesce(domain, '') = '' OR rtrim(lower(careers_url), '/') <> rtrim(lower('https://' || domain || '/'), '/')) THEN page END AS careers FROM h),
k AS (SELECT *, coalesce(home, careers) AS seen, platform IS NULL OR platform = 'custom' AS open FROM g),
fm AS (SELECT id, CASE WHEN open AND seen IS NOT NULL THEN seen ELSE platform END AS platform, CASE WHEN home IS NOT NULL THEN 'homepage' WHEN careers IS NOT NULL THEN 'careers_page' END AS source,
  CASE WHEN seen IS NOT NULL THEN CASE WHEN contains(lower(coalesce(careers_url, '')), lower(coalesce(CASE WHEN open THEN seen ELSE platform END, '?'))) THEN 'url' ELSE 'html' END END AS confidence,
  coalesce(own, CASE WHEN careers_url IS NOT NULL THEN CASE WHEN id % 3 = 2 THEN 'Careers' ELSE slug END END) AS slug,
  (open AND seen IS NOT NULL) OR (own IS NULL AND careers_url IS NOT NULL) AS changed, platform IS NOT NULL AND platform <> 'custom' AS known FROM k) """

SQL = {
    "valid_companies": f"""WITH {COMPANIES}, v AS (SELECT CASE WHEN id % 9 = 0 THEN ' EXAMPLE ' ELSE CAST(id AS VARCHAR) END AS id, CASE WHEN id % 10 = 0 THEN ' ' WHEN id % 7 = 0 THEN 'Example' ELSE name END AS name FROM companies)
SELECT * FROM v WHERE trim(name) <> '' AND lower(trim(id)) <> 'example' AND lower(name) <> 'example'""",
    "target_selection": f"WITH {COMPANIES} SELECT id, name FROM companies WHERE lower(name) IN ('customer#000000012', 'customer#000000005') OR id IN (7, 19) ORDER BY id LIMIT 3",
    "needs_discovery": S + f"""SELECT id, NOT {B("domain")} AND (id % 23 = 0 OR {B("careers_url")} OR coalesce(NOT reachable, true)) AS due, coalesce(reachable, false) AS loaded, method IS NULL AS backfill FROM cs""",
    "stage_gates": S + f"""SELECT id, CASE WHEN {B("domain")} THEN 'no-domain' WHEN id % 19 <> 0 AND careers_url <> '' AND reachable THEN 'already-reachable' END AS discovery,
  CASE WHEN NOT coalesce(reachable, false) THEN 'unreachable' END AS scrape, CASE WHEN id % 19 <> 0 AND category <> '' THEN 'categorized' END AS category,
  CASE WHEN NOT (id IN (SELECT o_custkey FROM orders) OR length(name) * (id % 7) >= 80 OR n_spaces > 0 OR id % 5 = 0) THEN 'insufficient_signal' END AS signal FROM cs""",
    "scrape_outcomes": S + """, o AS (SELECT CASE WHEN id % 8 = 0 THEN 'skipped' WHEN id % 3 <> 0 THEN 'success' ELSE 'no_result' END AS outcome, CASE WHEN category <> '' AND category <> 'None' THEN 'success' ELSE 'no_result' END AS categorized, id % 6 AS agent FROM cs)
SELECT outcome, CASE outcome WHEN 'skipped' THEN 'skipped_signature_match' ELSE outcome END AS company_outcome, categorized, agent, count(*) AS n FROM o GROUP BY ALL""",
    "run_counts": E + """, z AS (SELECT seq, CASE WHEN seq % 9 = 0 THEN seq % 4 WHEN seq % 7 = 0 THEN seq % 5 WHEN seq % 11 = 0 THEN seq % 3 WHEN seq % 5 = 0 THEN seq % 3 WHEN seq % 4 = 1 THEN seq % 2
  WHEN seq % 3 = 2 THEN seq % 4 WHEN seq % 8 = 3 THEN seq % 6 WHEN seq % 13 = 6 THEN seq % 5 WHEN seq % 10 = 7 THEN seq % 3 ELSE 0 END AS n_jobs,
  CASE WHEN seq % 3 = 2 AND seq % 4 > 0 THEN seq % 4 WHEN seq % 4 = 1 AND seq % 2 > 0 THEN seq % 2 WHEN seq % 5 = 0 AND seq % 3 > 0 THEN seq % 3 WHEN seq % 10 = 7 AND seq % 3 > 0 THEN seq % 3
  WHEN seq % 8 = 3 AND seq % 6 > 0 THEN seq % 6 WHEN seq % 13 = 6 THEN seq % 5 ELSE 0 END AS s FROM ev)
SELECT seq, CAST(n_jobs AS BIGINT) AS n_jobs, array_to_string(list_transform(range(1, s + 1), lambda i: 'u' || i), ',') AS seen FROM z""",
    "active_urls": f"""WITH {JOBS}, a AS (SELECT company_id, id, CASE WHEN id % 5 = 0 OR id % 6 <> 0 THEN 'https://jobs.example.com/' || (id % 40) END AS url, CASE WHEN id % 5 = 0 THEN id % 15 = 0 ELSE id % 4 = 0 END AS gone FROM jobs)
SELECT DISTINCT company_id, url FROM a WHERE NOT gone AND url IS NOT NULL""",
    "discovery_summary": S + f""", d AS (SELECT coalesce(reachable, false) AS ok, coalesce(method, 'unknown') AS method, CASE WHEN platform IS NULL THEN 'unknown' WHEN contains(lower(platform), 'greenhouse') THEN 'greenhouse' WHEN contains(lower(platform), 'lever') THEN 'lever'
  WHEN contains(lower(platform), 'ashby') THEN 'ashby' WHEN contains(lower(platform), 'workday') THEN 'workday' ELSE 'custom' END AS ats FROM cs),
u AS (SELECT 'all' AS kind, '' AS key, ok FROM d UNION ALL SELECT 'method', method, ok FROM d UNION ALL SELECT 'ats', ats, ok FROM d),
z AS (SELECT 'ats' AS kind, unnest(['greenhouse', 'lever', 'ashby', 'workday', 'custom', 'unknown']) AS key), c AS (SELECT kind, key, count(*) AS n, count(*) FILTER (ok) AS reachable FROM u GROUP BY 1, 2)
SELECT coalesce(c.kind, z.kind) AS kind, coalesce(c.key, z.key) AS key, coalesce(n, 0) AS n, coalesce(reachable, 0) AS reachable, {pct("coalesce(reachable, 0)", "coalesce(n, 0)")} AS pct FROM c FULL JOIN z ON c.kind = z.kind AND c.key = z.key""",
    "extraction_totals": f"""WITH {JOBS}, t AS (SELECT *, CASE id % 5 WHEN 0 THEN 'high' WHEN 1 THEN 'low' WHEN 2 THEN 'medium' ELSE 'unknown' END AS tier FROM jobs)
SELECT count(*) AS total_jobs, count(*) FILTER (id % 3 <> 0) AS enriched, count(*) FILTER (id % 50 = 0) AS errors, {pct("count(*) FILTER (id % 50 = 0)", "count(*)")} AS error_pct, count(*) FILTER (id % 7 = 0) AS missing_title,
  count(*) FILTER (id % 4 = 0) AS missing_description, {pct("count(*) FILTER (relevance = '1-URGENT')", "count(*)")} AS climate_pct, count(*) FILTER (tier = 'low') AS low, count(*) FILTER (tier = 'medium') AS medium,
  count(*) FILTER (tier = 'high') AS high, count(*) FILTER (tier = 'unknown') AS unknown FROM t""",
    "discovery_status": S + f""", w AS (SELECT * FROM cs WHERE domain <> ''), t AS (SELECT count(method) AS p, count(*) FILTER (reachable) AS r, count(*) FILTER (NOT reachable) AS f, count(*) FILTER (method IS NULL) AS o FROM w)
SELECT 'processed' AS key, p AS n, {pct("r", "p")} AS hit_pct FROM t UNION ALL SELECT 'reachable', r, NULL FROM t UNION ALL SELECT 'not_found', f, NULL FROM t UNION ALL SELECT 'unprocessed', o, NULL FROM t
UNION ALL SELECT CASE WHEN reachable THEN 'method:' || method ELSE 'failure:' || coalesce(nullif(failure_reason, ''), 'unclassified') END, count(*), NULL FROM w WHERE reachable IS NOT NULL GROUP BY 1""",
    "discovery_runs": S + """, f AS (SELECT CASE WHEN reachable THEN method ELSE 'not_found' END AS method FROM cs WHERE domain <> '' AND reachable IS NOT NULL),
m AS (SELECT unnest(['profile_hint', 'standard_pattern', 'ats_slug', 'homepage_link_scan', 'sitemap', 'playwright_scan', 'not_found']) AS method) SELECT m.method, count(f.method) AS n FROM m LEFT JOIN f USING (method) GROUP BY 1""",
    "discovery_updates": S + """SELECT id, careers_url, reachable, CASE WHEN id % 8 <> 5 THEN method WHEN NOT reachable THEN 'not_found' END AS method,
  CASE WHEN reachable THEN CASE id % 3 WHEN 0 THEN 'greenhouse' WHEN 1 THEN 'lever' ELSE 'custom' END END AS platform,
  CASE WHEN NOT reachable THEN CASE WHEN id % 4 = 0 THEN 'timeout' WHEN id % 6 = 0 THEN 'dns_error' ELSE 'all_miss' END END AS failure_reason,
  CASE WHEN reachable AND id % 8 <> 5 AND method = 'profile_hint' THEN 'footer' END AS hint_location FROM cs WHERE method IS NOT NULL""",
    "slug_candidates": S + """, n AS (SELECT id, CASE WHEN domain <> '' THEN slug END AS base, CASE WHEN id % 29 <> 0 THEN slug || CASE id % 5 WHEN 0 THEN '-inc' WHEN 1 THEN '-energy' WHEN 2 THEN '' WHEN 3 THEN '-labs' ELSE '-sons-co' END END AS whole,
  CASE WHEN id % 29 <> 0 THEN slug || CASE id % 5 WHEN 4 THEN '-sons' ELSE '' END END AS short FROM cs)
SELECT id, concat_ws('|', base, CASE WHEN whole IS DISTINCT FROM base THEN whole END, CASE WHEN short IS DISTINCT FROM base AND short IS DISTINCT FROM whole THEN short END) AS slugs FROM n""",
    "fingerprint_merge": FINGER + "SELECT * FROM fm",
    "fingerprint_summary": FINGER + "SELECT coalesce(platform, 'unknown') AS platform, count(*) AS n, count(*) FILTER (known) AS known, count(*) FILTER (changed) AS updated, count(source) AS detected FROM fm GROUP BY 1",
    "enrich_merge": ENRICHED + "SELECT * FROM en",
    "enrichment_tally": ENRICHED + f"""SELECT count(*) AS enriched, count(*) FILTER (relevance = 'low') AS low, count(*) FILTER (relevance = 'medium') AS medium, count(*) FILTER (relevance = 'high') AS high, count(*) FILTER (confirmed) AS climate_true,
  {pct("count(*) FILTER (confirmed)", "count(*)")} AS true_pct, {pct("count(*) FILTER (NOT confirmed)", "count(*)")} AS false_pct FROM en WHERE id % 50 <> 0""",
    "batch_positions": f"""WITH {COMPANIES}, b AS (SELECT id, sector, CAST(floor(id / 8) AS BIGINT) AS batch FROM companies), p AS (SELECT *, row_number() OVER (PARTITION BY batch ORDER BY id) - 1 AS pos, count(*) OVER (PARTITION BY batch) AS n FROM b),
g AS (SELECT id, pos, CASE WHEN (batch % 5 <> 0 OR n <= 3) AND id % 13 <> 0 THEN sector END AS category FROM p)
SELECT id, category, CAST(NULL AS VARCHAR) AS sector, CASE WHEN category IS NOT NULL THEN 'llm_batch' END AS resolver, CASE WHEN category IS NULL THEN 'batch result missing for index ' || pos END AS error FROM g""",
    "model_categories": S + """SELECT id, trim(category) AS category, CASE id % 3 WHEN 0 THEN CASE WHEN source = 'wrds_medium' THEN NULL ELSE 'None' END WHEN 1 THEN 'Power' END AS sector,
  CASE id % 2 WHEN 0 THEN CASE WHEN source = 'wrds_medium' THEN NULL ELSE 'None' END ELSE 'high' END AS confidence, CASE WHEN source = 'wrds_medium' THEN 'llm_wrds' ELSE 'llm' END AS resolver,
  CASE WHEN id % 3 = 0 THEN slug WHEN id % 2 = 0 THEN 'about' ELSE name END AS stand_in FROM cs""",
    "category_details": S + """, t AS (SELECT * FROM (VALUES (1, 'SOLAR ', 'Energy', ''), (2, 'solar', 'Other', 'Sun'), (3, 'Wind', 'Energy', 'Air'), (4, ' ', 'None', 'None'), (5, 'Storage', '', 'Grid')) AS v(ord, name, sector, area)),
f AS (SELECT lower(trim(name)) AS n, arg_min(sector, ord) AS sector, arg_min(area, ord) AS area FROM t WHERE trim(name) <> '' GROUP BY 1)
SELECT id, category, nullif(sector, '') AS sector, nullif(area, '') AS area FROM cs LEFT JOIN f ON lower(trim(category)) = n""",
    "category_to_jobs": f"""WITH {STATE}, {JOBS} SELECT jobs.id, company_id, nullif(category, '') AS category, CASE WHEN category <> '' THEN nullif(source, '') END AS source, CASE WHEN company_id % 3 = 0 THEN 'page-' || company_id END AS page_id
FROM jobs LEFT JOIN cs ON company_id = cs.id""",
    "state_reset": S + """SELECT id, name, CASE WHEN domain <> '' THEN domain ELSE 'N/A' END AS domain, CASE WHEN id % 2 = 1 AND category <> '' THEN category ELSE 'N/A' END AS category, CASE WHEN id % 2 = 1 THEN platform END AS ats_platform,
  CASE WHEN id % 2 = 1 THEN reachable END AS careers_page_reachable FROM cs""",
    "report_compare": """WITH c AS (SELECT role || '/' || (turn % 4) AS agent, conv_id % 2 AS run, length(text) % 1000 AS ms FROM conversations WHERE CASE conv_id % 2 WHEN 0 THEN turn % 4 <> 1 ELSE turn % 4 <> 2 END),
a AS (SELECT agent, count(*) FILTER (run = 0) AS ca, count(*) FILTER (run = 1) AS cb, floor(avg(ms) FILTER (run = 0) + 0.5) AS aa, floor(avg(ms) FILTER (run = 1) + 0.5) AS ab FROM c GROUP BY 1)
SELECT agent, ca AS calls_a, cb AS calls_b, coalesce(aa, 0) AS avg_a, coalesce(ab, 0) AS avg_b, CASE WHEN ca = 0 AND cb = 0 THEN '—' WHEN ca = 0 THEN '+∞'
  ELSE CASE WHEN floor((cb - ca) / ca * 1000.0::DOUBLE + 0.5) > 0 THEN '+' ELSE '' END || printf('%.1f', floor(CAST(cb - ca AS DOUBLE) / ca * 100.0::DOUBLE * 10 + 0.5) / 10) || '%' END AS delta FROM a""",
    "extract_paths": E + f""", p AS (SELECT CASE seq % 6 WHEN 0 THEN 'adapter' WHEN 1 THEN 'llm' WHEN 2 THEN '(missing)' WHEN 3 THEN 'xml_or_sitemap' WHEN 4 THEN 'json' ELSE 'adapter' END AS path FROM ev WHERE stage = 'extract'),
t AS (SELECT {pct("count(*) FILTER (path = 'adapter')", "count(*) FILTER (path IN ('adapter', 'llm'))")} AS s FROM p) SELECT path, count(*) AS n, max(s) AS adapter_share FROM p, t GROUP BY 1""",
    "latencies": "SELECT role AS agent, length(text) % 1000 AS ms, count(*) AS n FROM conversations GROUP BY 1, 2",
    "dashboard_totals": E + """, s AS (SELECT unnest(['profile', 'discovery', 'fingerprint', 'scrape', 'extract', 'enrich', 'categorize']) AS stage),
c AS (SELECT s.stage, count(e.seq) AS started, count(*) FILTER (outcome = 'success') AS completed, count(*) FILTER (outcome = 'no_result') AS no_result, count(*) FILTER (outcome = 'failure') AS failed, count(*) FILTER (outcome = 'skipped') AS skipped
  FROM s LEFT JOIN (SELECT * FROM ev WHERE stage <> 'enrich') e ON e.stage = s.stage GROUP BY 1),
u AS (SELECT * FROM c UNION ALL SELECT 'all', CAST(sum(started) AS BIGINT), CAST(sum(completed) AS BIGINT), CAST(sum(no_result) AS BIGINT), CAST(sum(failed) AS BIGINT), CAST(sum(skipped) AS BIGINT) FROM c)
SELECT *, completed + failed AS processed FROM u""",
    "recent_failures": E + """, l AS (SELECT *, row_number() OVER (PARTITION BY stage ORDER BY seq DESC) AS rn FROM ev)
SELECT stage, ['rate_limit', 'timeout', 'auth', 'bad_data'][k % 4 + 1] AS failure_class, count(*) AS n, count(*) >= 2 AS alert FROM l WHERE rn <= 60 AND outcome = 'failure' GROUP BY 1, 2""",
    "url_in_page": r"""WITH p AS (SELECT page_id, CASE WHEN page_id % 6 = 0 THEN 'not an address' ELSE url END AS url, html || CASE WHEN page_id % 4 = 0 THEN url ELSE '' END AS html FROM pages),
q AS (SELECT *, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path FROM p)
SELECT page_id, coalesce(regexp_matches(url, '^[A-Za-z][A-Za-z0-9+.-]*://') AND (contains(html, CASE WHEN path = '' THEN '/' ELSE path END) OR contains(html, url)), false) AS there FROM q""",
    "profile_bases": S + """SELECT id, CASE WHEN id % 3 = 0 THEN 'https://' || slug || '.com/About/' WHEN id % 3 = 2 AND careers_url IS NOT NULL THEN 'https://www.' || slug || '.com/Careers/' WHEN domain <> '' THEN 'https://' || domain || '/'
  WHEN id % 2 = 0 AND domain = '' THEN 'https:///' END AS base FROM cs""",
    "artifact_hashes": """SELECT doc_id % 97 AS company_id, 'https://x/' || (doc_id % 41) AS url, arg_max(sha256(coalesce(text, '')), doc_id) AS description_hash FROM documents WHERE doc_id % 8 <> 0 GROUP BY 1, 2""",
    "refresh_targets": S + """SELECT id, CASE WHEN id % 5 <> 1 THEN domain ELSE 'old' END AS domain, CASE WHEN id % 3 = 0 THEN 'enqueued' WHEN id % 5 <> 1 THEN 'refreshed' ELSE 'kept' END AS action FROM cs WHERE id % 5 <> 1 OR id % 3 <> 0""",
    "run_stages": f"WITH {COMPANIES} SELECT id, CASE id % 5 WHEN 0 THEN 'scrape,profile' WHEN 4 THEN 'discovery' END AS stages FROM companies",
    "newest_reports": E + "SELECT 'tag' || (k % 5) AS tag, max('tag' || (k % 5) || '-' || strftime(ts, '%Y%m%d-%H%M%S') || '.json') AS newest FROM ev GROUP BY 1",
    "baseline_snapshots": E + "SELECT seq, CASE WHEN seq % 4 < 3 THEN seq END AS total, CASE seq % 4 WHEN 0 THEN seq % 7 WHEN 1 THEN 5 WHEN 2 THEN seq % 7 END AS hits FROM ev",
    "row_errors": """SELECT p_brand, p_partkey, 'bad size: n/a' AS error FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS rn FROM part WHERE p_partkey % 9 = 0) WHERE rn <= 10""",
}
QUERIES = {k: globals()[k] for k in SQL}

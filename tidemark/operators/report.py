"""Reports over the event log: outcomes, yields, histograms, windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import classify
from tidemark.functions.numbers import percent, round_half_up
from tidemark.operators.numbering import overlapped
from tidemark.sources.shared import ranked

OUTCOMES = ("success", "no_result", "failure", "skipped")


def of(outcome: str):
    return F.count_if(F.col("outcome") == outcome)


def stage_report(events: DataFrame) -> DataFrame:
    """One row per stage: outcomes, p50 and p95 of successful durations, yield in percent.

    The percentiles are those at index min(n - 1, floor(p / 100 * n)); they come from ranks, so no group is
    collected: durations are counted first, and a running count finds the place."""
    counts = events.where("outcome = 'success'").groupBy("stage", "duration_ms").agg(F.count("*").alias("n"))
    by = Window.partitionBy("stage").orderBy("duration_ms")
    ranked = counts.withColumn("upto", F.sum("n").over(by)).withColumn("total", F.sum("n").over(Window.partitionBy("stage")))

    def at(p: float):
        place = F.least(F.col("total") - 1, F.floor(F.lit(p / 100.0) * F.col("total")))
        return F.min(F.when(F.col("upto") > place, F.col("duration_ms")))

    places = ranked.groupBy("stage").agg(at(50).alias("p50"), at(95).alias("p95"))
    tally = events.groupBy("stage").agg(*(of(o).alias(o) for o in OUTCOMES))
    tried = F.col("success") + F.col("no_result") + F.col("failure")
    return tally.join(places, "stage", "left").withColumn("yield_pct", F.when(tried > 0, percent(F.col("success"), tried)))


def failure_histogram(events: DataFrame, limit: int = 15) -> DataFrame:
    """The most frequent stage/class keys of failures."""
    return (
        events.where("outcome = 'failure'")
        .groupBy(F.concat_ws("/", "stage", "failure_class").alias("key"))
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "key")
        .limit(limit)
    )


def outcome_sets(events: DataFrame) -> DataFrame:
    """Counts by stage and outcome, and by lane, stage and outcome, in one pass."""
    return (
        events.groupingSets([["stage", "outcome"], ["lane", "stage", "outcome"]], "lane", "stage", "outcome")
        .agg(F.count("*").alias("n"), F.grouping("lane").cast("int").alias("all_lanes"))
        .select("lane", "stage", "outcome", "n", "all_lanes")
    )


def share_table(rows: DataFrame, key: str) -> DataFrame:
    """Counts of a key with their share, and the running share from the largest down."""
    counts = rows.groupBy(F.coalesce(F.nullif(F.col(key), F.lit("")), F.lit("unknown")).alias(key)).agg(F.count("*").alias("n"))
    down = Window.orderBy(F.desc("n"), key)  # one row a key
    return counts.select(
        key,
        "n",
        percent(F.col("n"), F.sum("n").over(Window.partitionBy())).alias("pct"),
        percent(F.sum("n").over(down), F.sum("n").over(Window.partitionBy())).alias("running_pct"),
    )


def rolling(events: DataFrame, seconds: int = 60) -> DataFrame:
    """For every event: completions of its stage in the time before it, their error rate and their nearest-rank p95 of durations.

    A stage is cut into blocks of an hour, each with the last minute of the one before, so a stage isn't one task. The p95
    looks at the durations of one minute."""
    dealt = overlapped(events.withColumn("_ms", F.unix_millis("ts")), "_ms", 3_600_000, seconds * 1000)
    back = Window.partitionBy("stage", "_block").orderBy("_ms").rangeBetween(-seconds * 1000, 0)
    n = F.count("*").over(back)
    durations = F.array_sort(F.collect_list("duration_ms").over(back))
    p95 = F.get(durations, F.greatest(F.ceil(F.size(durations) * 0.95).cast("int") - 1, F.lit(0)))
    out = dealt.withColumns({"completions": n, "error_rate": round_half_up(of("failure").over(back) / n, 4), "p95_ms": p95})
    return out.where("_own").drop("_ms", "_block", "_own")


def last_failure_rate(events: DataFrame, last: int = 20, least: int = 5) -> DataFrame:
    """Failure rate of the last outcomes of a stage, null below the least number of samples."""
    dealt, back = lately(events, last)
    n = F.count("*").over(back)
    return dealt.withColumn("failure_rate", F.when(n >= least, round_half_up(of("failure").over(back) / n, 4))).where("_own").drop("rank", "_block", "_own")


def lately(events: DataFrame, last: int, size: int = 100_000):
    """(events, window over the last rows of a stage): a stage is cut into blocks of rows by its rank, each with the last rows
    of the one before; rows that are only looked back at have ``_own`` false."""
    dealt = overlapped(ranked(events, ["stage"], ["seq"])[0].withColumn("rank", F.col("rank") - 1), "rank", size, last)
    return dealt, Window.partitionBy("stage", "_block").orderBy("rank").rowsBetween(1 - last, 0)


def everything():
    """A window over all rows, for tables of a few rows: one a key."""
    return Window.partitionBy()


def last_per_key(rows: DataFrame, key: str, order: str, n: int) -> DataFrame:
    """The last rows of each key; what a task can't use any more is dropped before the shuffle."""
    down = Window.partitionBy(key).orderBy(F.desc(order))
    return rows.withColumn("_rn", F.row_number().over(down)).where(F.col("_rn") <= n).drop("_rn")


def first_per_key(rows: DataFrame, key: str, order: str, n: int) -> DataFrame:
    """The first rows of each key, in the same way."""
    up = Window.partitionBy(key).orderBy(order)
    return rows.withColumn("_rn", F.row_number().over(up)).where(F.col("_rn") <= n).drop("_rn")


def no_result_reason(*, reason: Column, category_error: Column, failure_class: Column, status_code: Column, jobs: Column, category: Column, platform: Column) -> Column:
    """Why an event has no result: the first that tells, from what was written down to what is missing."""
    there = lambda c: F.nullif(c, F.lit(""))
    error = there(category_error)
    return F.coalesce(
        there(reason), F.when(error.isNotNull(), F.concat(F.lit("category_error:"), there(failure_class))), F.when(error.isNotNull(), F.lit("category_error")),
        F.concat(F.lit("http_"), F.nullif(status_code, F.lit(0)).cast("string")), F.when(jobs == 0, F.lit("zero_jobs")),
        F.when(category.isNull() | (category == "None"), F.lit("category_none")), F.when(platform.isNull(), F.lit("ats_undetected")), F.lit("unknown"),
    )


# How a scrape's method is told from its name, in order, and below how many bytes a body is small.
SCRAPE_METHODS = (("greenhouse", "greenhouse_api"), ("lever", "lever_api"), ("ashby", "ashby_api"), ("workday", "workday_api"), ("playwright", "playwright_html"), ("direct", "direct_html"), ("html", "direct_html"))
SMALL_BODY = 5120


def scrape_summary(scrapes: DataFrame) -> DataFrame:
    """(kind, key, n) of scrapes (success, method, skipped, status_code, n_bytes): outcomes, methods, status codes, small bodies. Known methods
    have a row though none came that way; others are named as they are."""
    low = F.lower(F.coalesce(F.nullif("method", F.lit("")), F.lit("unknown")))
    method = F.coalesce(*(F.when(low.contains(w), F.lit(n)) for w, n in SCRAPE_METHODS), low)
    yes = lambda c: F.coalesce(c, F.lit(False))
    flags = (("success", yes(F.col("success"))), ("error", ~yes(F.col("success"))), ("skipped_signature_match", yes(F.col("skipped"))), ("small_body", yes(F.col("n_bytes") < SMALL_BODY)))
    pair = lambda kind, key: F.struct(F.lit(kind).alias("kind"), key.alias("key"))
    told = [pair("outcome", F.lit("total")), pair("method", method), pair("status", F.coalesce(F.col("status_code").cast("string"), F.lit("unknown")))]
    told += [F.when(test, pair("outcome", F.lit(name))) for name, test in flags]
    counts = scrapes.select(F.explode(F.array_compact(F.array(*told))).alias("t")).groupBy("t.kind", "t.key").agg(F.count("*").alias("n"))
    known = [("outcome", k) for k in ("total", *(n for n, _ in flags))] + [("method", n) for n in dict.fromkeys(n for _, n in SCRAPE_METHODS)]
    return scrapes.sparkSession.createDataFrame(known, "kind string, key string").join(counts, ["kind", "key"], "full").select("kind", "key", F.coalesce("n", F.lit(0)).alias("n"))


def retries(events: DataFrame, most: int = 3) -> DataFrame:
    """Failures with the attempt that they are (from the last event that was none), and whether another attempt follows: only for a
    transient class, and up to the third."""
    order = Window.partitionBy("company_id", "stage").orderBy("seq")
    chain = F.count_if(F.col("outcome") != "failure").over(order)
    rows = events.withColumn("_chain", chain).where("outcome = 'failure'")
    attempt = F.row_number().over(Window.partitionBy("company_id", "stage", "_chain").orderBy("seq"))
    again = F.col("failure_class").isin(*classify.TRANSIENT) & (F.col("attempt") < most)
    return rows.withColumn("attempt", attempt).withColumn("retry", again).drop("_chain")


def quality_of_listings(jobs: DataFrame) -> DataFrame:
    """One row about enriched listings (title_normalized, function, seniority, relevance, climate, error): errors, listings without a required field,
    tiers whatever their case, and warnings: more than a fifth of errors, climate outside of 10 to 90 percent, more than 30 percent without a level. A
    field that says unknown isn't missing."""
    required = ("title_normalized", "function", "seniority", "relevance", "climate")
    incomplete = F.exists(F.array(*(F.col(c).isNull() for c in required)), lambda x: x)
    known = F.lower("relevance").isin("low", "medium", "high")
    tier = F.when(known, F.lower("relevance")).otherwise("unknown")
    failed = F.coalesce(F.col("error") != "", F.lit(False))
    n, climate = F.count("*"), percent(F.count_if("climate"), F.count("*"), 2)
    return jobs.agg(
        n.alias("n"), F.count_if(failed).alias("errors"), percent(F.count_if(failed), n, 2).alias("errors_pct"), F.count_if(incomplete).alias("incomplete"),
        percent(F.count_if(incomplete), n, 2).alias("incomplete_pct"), *(F.count_if(tier == t).alias(t) for t in ("low", "medium", "high", "unknown")),
        F.count_if("climate").alias("climate"), F.count_if(~F.col("climate")).alias("not_climate"), climate.alias("climate_pct"),
        (F.count_if(failed) > 0.2 * n).alias("warn_errors"), ((n > 0) & ~climate.between(10, 90)).alias("warn_climate"), (F.count_if(F.col("seniority").isNull()) > 0.3 * n).alias("warn_seniority"),
    )

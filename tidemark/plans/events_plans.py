"""Queries over the event log."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions.numbers import percent
from tidemark.operators import report, temporal
from tidemark.plans.model import COMPANIES, EVENTS, JOBS, companies, events, jobs

WITH = f"WITH {EVENTS} "


def stage_report(spark, sf_dir):
    return report.stage_report(events(spark, sf_dir))


def failure_top15(spark, sf_dir):
    e = events(spark, sf_dir).withColumn("failure_class", F.concat(F.lit("class_"), F.col("k") % 7))
    return report.failure_histogram(e)


def no_result_reasons(spark, sf_dir):
    e = events(spark, sf_dir).where("outcome = 'no_result'")
    k = F.col("k")
    found = report.no_result_reason(
        reason=F.when(k % 9 == 0, "all_miss").when(k % 9 == 1, ""), category_error=F.when(k % 5 == 0, "boom"), failure_class=F.when(k % 2 == 0, "timeout"),
        status_code=F.when(k % 4 == 1, 404).when(k % 4 == 2, 0), jobs=F.when(k % 3 == 0, 0), category=F.when(k % 7 == 0, "None").when(k % 7 < 4, "Solar"), platform=F.when(k % 2 == 0, "lever"),
    )
    return e.groupBy(F.concat_ws("/", "stage", found).alias("reason")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "reason").limit(15)


def source_distribution(spark, sf_dir):
    e = events(spark, sf_dir).where("stage = 'categorize'").withColumn("source", F.concat(F.lit("s"), F.col("k") % 5))
    return e.groupBy("source").agg(
        F.count("*").alias("n"), percent(report.of("no_result"), F.count("*")).alias("no_result_pct")
    )


def event_tristate_summary(spark, sf_dir):
    e = events(spark, sf_dir)
    scraped = (F.col("stage") == "scrape") & (F.col("outcome") == "success")
    total = lambda c: F.coalesce(F.sum(F.when(scraped, c)), F.lit(0)).cast("long")
    return e.agg(
        F.count_if((F.col("lane") == "cold") & (F.col("stage") == "profile") & (F.col("outcome") == "success")).alias("cold_onboarded"),
        F.count_if(scraped & (F.col("lane") == "warm")).alias("warm_refreshed"),
        total(F.col("k")).alias("net_new"), total(F.col("job_count")).alias("existing"), total(F.col("k") % 2).alias("removed"),
    )


def lane_stage_outcome_sets(spark, sf_dir):
    return report.outcome_sets(events(spark, sf_dir))


def slowest10(spark, sf_dir):
    e = events(spark, sf_dir).where("outcome = 'success'")
    return e.orderBy(F.desc("duration_ms"), "seq").limit(10).select("seq", "stage", "company_id", "duration_ms")


def recent_failures10(spark, sf_dir):
    return events(spark, sf_dir).where("outcome = 'failure'").orderBy(F.desc("seq")).limit(10).select("seq", "stage", "company_id")


def last60_per_stage(spark, sf_dir):
    down = Window.partitionBy("stage").orderBy(F.desc("seq"))
    return events(spark, sf_dir).withColumn("rn", F.row_number().over(down)).where("rn <= 60").select("stage", "seq", "outcome", "rn")


def rolling60s(spark, sf_dir):
    return report.rolling(events(spark, sf_dir)).select("seq", "stage", "completions", "error_rate", "p95_ms")


def last20_failure_rate(spark, sf_dir):
    return report.last_failure_rate(events(spark, sf_dir)).select("seq", "stage", "failure_rate")


def latest_run(spark, sf_dir):
    return temporal.latest_run(events(spark, sf_dir)).select("company_id", "seq", "outcome", "job_count")


def consecutive_empty(spark, sf_dir):
    return temporal.consecutive_empty(events(spark, sf_dir))


def dormancy(spark, sf_dir):
    c = companies(spark, sf_dir).withColumn("was_dormant", F.when(F.col("id") % 3 == 0, F.col("id") % 2 == 0))
    return temporal.dormancy(c, events(spark, sf_dir)).select("id", "empty_runs", "dormant", "changed")


def lifecycle(spark, sf_dir):
    return temporal.job_lifecycle(jobs(spark, sf_dir), events(spark, sf_dir)).select(
        "id", "company_id", F.date_format("last_seen_at", "yyyy-MM-dd HH:mm:ss").alias("last_seen"), "removed", "removed_now", "days_live"
    )


def transition_counts(spark, sf_dir):
    from tidemark.functions.lifecycle import advances, next_stage

    e = events(spark, sf_dir).select(
        "stage", "outcome", advances(F.col("stage"), F.col("outcome")).alias("advanced"), next_stage(F.col("stage")).alias("following")
    )
    return e.groupBy("stage", "outcome", "advanced", F.when(F.col("advanced"), F.col("following")).alias("goes_to")).agg(F.count("*").alias("n"))


def retry_attempts(spark, sf_dir):
    """Failures by the attempt that they were, and how many of them are tried again."""
    kind = F.element_at(F.array(*map(F.lit, ("timeout", "auth", "rate_limit", "bad_data", "transient_network"))), (F.col("k") % 5 + 1).cast("int"))
    r = report.retries(events(spark, sf_dir).withColumn("failure_class", kind))
    return r.groupBy("stage", "failure_class", "attempt").agg(F.count("*").alias("n"), F.count_if("retry").alias("retries"))


def micro_batches(spark, sf_dir):
    """Categorise calls in batches of ten, in log order, with the size of each batch."""
    from tidemark.operators.numbering import numbered

    e = numbered(events(spark, sf_dir).where("stage = 'categorize'").select("seq"), ["seq"])
    return e.groupBy(F.floor((F.col("number") - 1) / 10).alias("batch")).agg(F.count("*").alias("n"), F.min("seq").alias("first_seq"))


PCT = "CASE WHEN ({b}) = 0 THEN 0.0 ELSE floor(CAST(({a}) AS DOUBLE) / ({b}) * 100.0 * 10 + 0.5) / 10 END"
pct = lambda a, b: PCT.format(a=a, b=b)

SQL = {
    "stage_report": WITH + f""", d AS (
  SELECT stage, list_sort(list(duration_ms)) AS v, count(*) AS n FROM ev WHERE outcome = 'success' GROUP BY stage),
t AS (SELECT stage, count(*) FILTER (outcome = 'success') AS success, count(*) FILTER (outcome = 'no_result') AS no_result,
  count(*) FILTER (outcome = 'failure') AS failure, count(*) FILTER (outcome = 'skipped') AS skipped FROM ev GROUP BY stage)
SELECT t.*, v[least(n - 1, CAST(floor(0.5 * n) AS BIGINT)) + 1] AS p50, v[least(n - 1, CAST(floor(0.95 * n) AS BIGINT)) + 1] AS p95,
  CASE WHEN success + no_result + failure > 0 THEN {pct("success", "success + no_result + failure")} END AS yield_pct
FROM t LEFT JOIN d USING (stage)""",
    "failure_top15": WITH + """SELECT stage || '/class_' || (k % 7) AS key, count(*) AS n FROM ev WHERE outcome = 'failure'
GROUP BY 1 ORDER BY n DESC, key LIMIT 15""",
    "no_result_reasons": WITH + """SELECT stage || '/' || CASE WHEN k % 9 = 0 THEN 'all_miss' WHEN k % 5 = 0 AND k % 2 = 0 THEN 'category_error:timeout' WHEN k % 5 = 0 THEN 'category_error'
  WHEN k % 4 = 1 THEN 'http_404' WHEN k % 3 = 0 THEN 'zero_jobs' WHEN k % 7 = 0 OR k % 7 >= 4 THEN 'category_none' WHEN k % 2 = 1 THEN 'ats_undetected' ELSE 'unknown' END AS reason, count(*) AS n
FROM ev WHERE outcome = 'no_result' GROUP BY 1 ORDER BY n DESC, reason LIMIT 15""",
    "source_distribution": WITH + f"""SELECT 's' || (k % 5) AS source, count(*) AS n,
  {pct("count(*) FILTER (outcome = 'no_result')", "count(*)")} AS no_result_pct FROM ev WHERE stage = 'categorize' GROUP BY 1""",
    "event_tristate_summary": WITH + """SELECT count(*) FILTER (lane = 'cold' AND stage = 'profile' AND outcome = 'success') AS cold_onboarded,
  count(*) FILTER (stage = 'scrape' AND outcome = 'success' AND lane = 'warm') AS warm_refreshed,
  CAST(coalesce(sum(k) FILTER (stage = 'scrape' AND outcome = 'success'), 0) AS BIGINT) AS net_new,
  CAST(coalesce(sum(job_count) FILTER (stage = 'scrape' AND outcome = 'success'), 0) AS BIGINT) AS existing,
  CAST(coalesce(sum(k % 2) FILTER (stage = 'scrape' AND outcome = 'success'), 0) AS BIGINT) AS removed FROM ev""",
    "lane_stage_outcome_sets": WITH + """SELECT lane, stage, outcome, count(*) AS n, CAST(grouping(lane) AS INT) AS all_lanes
FROM ev GROUP BY GROUPING SETS ((stage, outcome), (lane, stage, outcome))""",
    "slowest10": WITH + "SELECT seq, stage, company_id, duration_ms FROM ev WHERE outcome = 'success' ORDER BY duration_ms DESC, seq LIMIT 10",
    "recent_failures10": WITH + "SELECT seq, stage, company_id FROM ev WHERE outcome = 'failure' ORDER BY seq DESC LIMIT 10",
    "last60_per_stage": WITH + """SELECT stage, seq, outcome, CAST(rn AS INT) AS rn FROM (
  SELECT *, row_number() OVER (PARTITION BY stage ORDER BY seq DESC) AS rn FROM ev) WHERE rn <= 60""",
    "rolling60s": WITH + """SELECT seq, stage, count(*) OVER w AS completions,
  floor(CAST(count(*) FILTER (outcome = 'failure') OVER w AS DOUBLE) / count(*) OVER w * 10000 + 0.5) / 10000 AS error_rate,
  list_extract(list_sort(list(duration_ms) OVER w), greatest(CAST(ceil(count(*) OVER w * 0.95) AS INT), 1)) AS p95_ms
-- whole milliseconds, as unix_millis has them; epoch_ms rounds, which puts events later than they were
FROM ev WINDOW w AS (PARTITION BY stage ORDER BY epoch_us(ts) // 1000 RANGE BETWEEN 60000 PRECEDING AND CURRENT ROW)""",
    "last20_failure_rate": WITH + """SELECT seq, stage, CASE WHEN count(*) OVER w >= 5 THEN
  floor(CAST(count(*) FILTER (outcome = 'failure') OVER w AS DOUBLE) / count(*) OVER w * 10000 + 0.5) / 10000 END AS failure_rate
FROM ev WINDOW w AS (PARTITION BY stage ORDER BY seq ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)""",
    "latest_run": WITH + """SELECT company_id, max(seq) AS seq, arg_max(outcome, seq) AS outcome, arg_max(job_count, seq) AS job_count
FROM ev GROUP BY company_id""",
    "consecutive_empty": WITH + """, f AS (SELECT company_id, max(seq) FILTER (job_count > 0) AS filled FROM ev GROUP BY 1)
SELECT company_id, count(*) FILTER (filled IS NULL OR seq > filled) AS empty_runs FROM ev JOIN f USING (company_id) GROUP BY 1""",
    "dormancy": f"WITH {EVENTS}, {COMPANIES}" + """, f AS (SELECT company_id, max(seq) FILTER (job_count > 0) AS filled FROM ev GROUP BY 1),
r AS (SELECT company_id, count(*) FILTER (filled IS NULL OR seq > filled) AS n FROM ev JOIN f USING (company_id) GROUP BY 1)
SELECT id, coalesce(n, 0) AS empty_runs, coalesce(n, 0) >= 3 AS dormant,
  coalesce(CASE WHEN id % 3 = 0 THEN id % 2 = 0 END, false) <> (coalesce(n, 0) >= 3) AS changed
FROM companies LEFT JOIN r ON id = company_id""",
    "lifecycle": f"WITH {EVENTS}, {JOBS}" + """, r AS (SELECT company_id AS c, arg_max(ts, seq) AS run_at, arg_max(outcome, seq) AS o FROM ev GROUP BY 1),
x AS (SELECT *, CASE WHEN o = 'skipped' AND NOT removed THEN run_at ELSE last_seen_at END AS seen FROM jobs LEFT JOIN r ON company_id = c)
SELECT id, company_id, strftime(seen, '%Y-%m-%d %H:%M:%S') AS last_seen, removed,
  coalesce(o = 'success' AND NOT removed AND epoch_ms(coalesce(last_seen_at, first_seen_at, TIMESTAMP '2000-01-01')) < epoch_ms(run_at) - 300000, false) AS removed_now,
  CAST(coalesce(greatest(0, floor((epoch_ms(seen) - epoch_ms(first_seen_at)) / 86400000.0)), 0) AS INT) AS days_live FROM x""",
    "transition_counts": WITH + """, s AS (SELECT *, CASE WHEN outcome IN ('success', 'skipped') THEN true
    WHEN outcome = 'no_result' THEN stage IN ('discovery', 'fingerprint', 'profile') ELSE false END AS advanced FROM ev)
SELECT stage, outcome, advanced, CASE WHEN advanced THEN CASE stage WHEN 'profile' THEN 'discovery' WHEN 'discovery' THEN 'fingerprint'
  WHEN 'fingerprint' THEN 'scrape' WHEN 'scrape' THEN 'extract' WHEN 'extract' THEN 'enrich' WHEN 'enrich' THEN 'categorize' ELSE 'done' END END AS goes_to,
  count(*) AS n FROM s GROUP BY ALL""",
    "retry_attempts": WITH + """, c AS (SELECT *, count(*) FILTER (outcome <> 'failure') OVER (PARTITION BY company_id, stage ORDER BY seq) AS g FROM ev),
f AS (SELECT stage, ['timeout', 'auth', 'rate_limit', 'bad_data', 'transient_network'][k % 5 + 1] AS failure_class, row_number() OVER (PARTITION BY company_id, stage, g ORDER BY seq)::INT AS attempt FROM c WHERE outcome = 'failure')
SELECT stage, failure_class, attempt, count(*) AS n, count(*) FILTER (failure_class IN ('timeout', 'rate_limit', 'transient_network') AND attempt < 3) AS retries FROM f GROUP BY ALL""",
    "micro_batches": WITH + """SELECT CAST(floor((rn - 1) / 10) AS BIGINT) AS batch, count(*) AS n, min(seq) AS first_seq FROM (
  SELECT seq, row_number() OVER (ORDER BY seq) AS rn FROM ev WHERE stage = 'categorize') GROUP BY 1""",
}
QUERIES = {k: globals()[k] for k in SQL}

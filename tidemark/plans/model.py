"""The engine's logical tables as views of the stored tables, in Spark and in SQL.

companies come from customer, listings (jobs) from orders and their lines, runs and events from
events, model calls from conversations. Both forms of a view give the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The stages that an event can tell of, and titles of listings.
EVENT_STAGES = ("profile", "discovery", "fingerprint", "scrape", "extract", "enrich", "categorize")
TITLES = (
    "Senior Software Engineer", "Sr. Product Manager", "Data Scientist II", "Marketing Manager", "VP of Finance", "Chief of Staff",
    "Summer Internship", "Director of Engineering", "Account Executive", "Junior UX Designer", "Operations Manager",
    "General Counsel", "Customer Success Lead", "People Operations Partner", "Supply Chain Analyst", "Chief Operating Officer",
    "Assoc Eng 3", "Policy Advisor", "Engineering Manager", "Controller", "Manager", "Technician", "Head of Growth", "Mgr, Business Development",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(values: tuple[str, ...], index: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (index % len(values) + 1).cast("int"))


def sql_pick(values: tuple[str, ...], index: str) -> str:
    return f"list_extract([{', '.join(repr(v) for v in values)}], CAST(({index}) % {len(values)} AS INT) + 1)"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("seq"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("user_id").alias("company_id"),
        pick(EVENT_STAGES, F.col("event_id")).alias("stage"),
        F.when(F.col("user_id") % 3 == 0, "cold").otherwise("warm").alias("lane"),
        F.when(F.col("event_type").isin("purchase", "view"), "success")
        .when(F.col("event_type") == "click", "no_result")
        .when(F.col("event_type") == "signup", "skipped")
        .otherwise("failure")
        .alias("outcome"),
        F.floor(F.col("value") * 10).cast("long").alias("duration_ms"),
        F.get_json_object("props", "$.k").cast("long").alias("k"),
    ).withColumn("job_count", F.col("k") % 3)


EVENTS = f"""ev AS (
  SELECT event_id AS seq, ts, user_id AS company_id, {sql_pick(EVENT_STAGES, "event_id")} AS stage,
    CASE WHEN user_id % 3 = 0 THEN 'cold' ELSE 'warm' END AS lane,
    CASE WHEN event_type IN ('purchase', 'view') THEN 'success' WHEN event_type = 'click' THEN 'no_result'
         WHEN event_type = 'signup' THEN 'skipped' ELSE 'failure' END AS outcome,
    CAST(floor(value * 10) AS BIGINT) AS duration_ms, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
    CAST(json_extract_string(props, '$.k') AS BIGINT) % 3 AS job_count
  FROM events)"""


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    return (
        table(spark, sf_dir, "customer")
        .join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            F.col("c_custkey").alias("id"),
            F.col("c_name").alias("name"),
            F.col("c_mktsegment").alias("sector"),
            F.col("n_name").alias("hq"),
            F.floor("c_acctbal").cast("long").alias("employees"),
        )
    )


COMPANIES = """companies AS (
  SELECT c_custkey AS id, c_name AS name, c_mktsegment AS sector, n_name AS hq, CAST(floor(c_acctbal) AS BIGINT) AS employees
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)"""


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("last"))
    return (
        table(spark, sf_dir, "orders")
        .join(last, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .select(
            F.col("o_orderkey").alias("id"),
            F.col("o_custkey").alias("company_id"),
            pick(TITLES, F.col("o_orderkey")).alias("title"),
            F.col("o_orderdate").cast("timestamp").alias("first_seen_at"),
            F.col("last").cast("timestamp").alias("last_seen_at"),
            (F.col("o_orderstatus") == "F").alias("removed"),
            F.col("o_orderpriority").alias("relevance"),
            F.col("o_orderstatus").alias("status"),
        )
    )


JOBS = f"""jobs AS (
  SELECT o_orderkey AS id, o_custkey AS company_id, {sql_pick(TITLES, "o_orderkey")} AS title, o_orderdate AS first_seen_at,
    last AS last_seen_at, o_orderstatus = 'F' AS removed, o_orderpriority AS relevance, o_orderstatus AS status
  FROM orders LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS last FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey)"""


# What stages write about a company, by turns; an empty text and a missing value are among them.
METHODS = ("profile_hint", "ats_slug", "homepage_link_scan", None, "not_found", "sitemap")
PLATFORMS = ("greenhouse", "custom", None, "Workday EU", "ashby", "lever", "smartrecruiters")
REASONS = (None, "timeout", "all_miss", "")
CATEGORIES = (None, "None", "Solar", " wind ", "", "Storage")
SOURCES = ("wrds_fast", "cold", None, "wrds_medium", "")


def company_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Companies with what the stages have written about them."""
    k = F.col("c_custkey")
    slug = F.lower(F.replace("c_name", F.lit("#"), F.lit("-")))
    c = table(spark, sf_dir, "customer").select(
        k.alias("id"), F.col("c_name").alias("name"), slug.alias("slug"),
        F.when(k % 11 != 0, F.when(k % 13 == 0, "").otherwise(F.concat(F.lit("www."), slug, F.lit(".com")))).alias("domain"),
        pick(METHODS, k).alias("method"), pick(CATEGORIES, k).alias("category"), pick(SOURCES, k).alias("source"), (k % 4).alias("n_spaces"),
    )
    k = F.col("id")
    c = c.withColumn("reachable", F.when(F.col("method").isNotNull(), (F.col("method") != "not_found") & (k % 17 != 0)))
    url = pick(("https://boards.greenhouse.io/", "https://jobs.lever.co/", "https://www."), k)
    url = F.concat(url, F.col("slug"), F.when(k % 3 == 2, F.lit(".com/Careers/")).otherwise(F.lit("/")))
    return c.select(
        "*", F.when(F.col("reachable"), url).alias("careers_url"), F.when(F.col("reachable"), pick(PLATFORMS, k)).alias("platform"),
        F.when(~F.col("reachable"), pick(REASONS, k)).alias("failure_reason"),
    )


def _case(values: tuple, index: str) -> str:
    return f"CASE ({index}) % {len(values)} " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values) if v is not None) + " END"


STATE = f"""cs0 AS (
  SELECT c_custkey AS id, c_name AS name, lower(replace(c_name, '#', '-')) AS slug, {_case(METHODS, "c_custkey")} AS method, {_case(CATEGORIES, "c_custkey")} AS category,
    {_case(SOURCES, "c_custkey")} AS source, c_custkey % 4 AS n_spaces,
    CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 13 = 0 THEN '' ELSE 'www.' || lower(replace(c_name, '#', '-')) || '.com' END AS domain FROM customer),
cs1 AS (SELECT *, CASE WHEN method IS NOT NULL THEN method <> 'not_found' AND id % 17 <> 0 END AS reachable FROM cs0),
cs AS (SELECT *, CASE WHEN reachable THEN CASE id % 3 WHEN 0 THEN 'https://boards.greenhouse.io/' || slug || '/' WHEN 1 THEN 'https://jobs.lever.co/' || slug || '/'
    ELSE 'https://www.' || slug || '.com/Careers/' END END AS careers_url, CASE WHEN reachable THEN {_case(PLATFORMS, "id")} END AS platform,
  CASE WHEN NOT reachable THEN {_case(REASONS, "id")} END AS failure_reason FROM cs1)"""

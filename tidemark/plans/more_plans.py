"""Queries over projections, comparisons and model answers."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import classify, text, urls
from tidemark.functions.lifecycle import blank, lane_of
from tidemark.functions.numbers import percent, progress, round_half_up
from tidemark.operators import compare, report, tabular
from tidemark.plans import page_plans
from tidemark.plans.model import COMPANIES, EVENTS, companies, events, jobs, pick, table
from tidemark.sources.shared import dealt
from tidemark.sources.tables import prefer_json, retained, run_status, upsert_plan


def company_projection(spark, sf_dir):
    """Ingested rows as companies: id from the domain, else from the name; zero sizes are unknown; place in parts."""
    c = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    site = F.when(F.col("c_custkey") % 4 != 0, F.concat(F.lit("HTTPS://Site"), F.col("c_custkey").cast("string"), F.lit(".com/about?x=1")))
    domain = urls.domain_ingested(site)
    size = F.nullif(F.when(F.col("c_custkey") % 7 == 0, 0.0).otherwise(F.col("c_acctbal")), F.lit(0.0))
    hq = F.nullif(F.concat_ws(", ", F.when(F.col("c_custkey") % 3 == 0, F.lit("City")), F.col("n_name")), F.lit(""))
    words = text.split_delimited(F.concat_ws(";", "c_mktsegment", F.lit(" "), "n_name"))
    return c.select(
        F.when(domain.isNotNull(), text.slugify(F.regexp_replace(domain, r"\.", " "))).otherwise(text.deterministic_id(F.col("c_name"))).alias("id"),
        domain.alias("domain"), size.alias("employees"), hq.alias("hq"), F.array_join(words, "|").alias("keywords"),
    )


def sink_projection(spark, sf_dir):
    """Companies as a sink takes them: the first deal that has a kind, texts cut to 2000, known names only."""
    o = table(spark, sf_dir, "orders").select(
        "o_custkey", F.struct("o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderpriority")).alias("deal_type"), "o_totalprice").alias("s")
    )
    signals = o.groupBy("o_custkey").agg(F.sort_array(F.collect_list("s")).alias("signals"))
    deal = F.try_element_at(F.filter("signals", lambda x: x["deal_type"].isNotNull() & (x["deal_type"] != "")), F.lit(1))["deal_type"]
    return signals.select("o_custkey", deal.alias("deal_type"), F.size("signals").cast("long").alias("n"), F.length(F.left(F.repeat("o_custkey", 900), F.lit(2000))).alias("text_length"))


def batch_results(spark, sf_dir):
    asked = companies(spark, sf_dir).where("id % 5 = 0").select("id")
    answers = companies(spark, sf_dir).where("id % 3 <> 0").select("id", F.when(F.col("id") % 4 == 0, " ").otherwise(F.col("sector")).alias("category"))
    return compare.result_outcomes(asked, answers).groupBy("outcome").agg(F.count("*").alias("n"))


def headroom_compare(spark, sf_dir):
    shapes = page_plans.pages(spark, sf_dir).select("page_id", urls.page_shape(F.col("html")).alias("shape"))
    count = lambda df: df.groupBy("shape").agg(F.count("*").alias("n"))
    return compare.bucket_deltas(count(shapes.where("page_id % 2 = 0")), count(shapes.where("page_id % 3 <> 0")), "shape")


def ship_gate(spark, sf_dir):
    d = headroom_compare(spark, sf_dir).agg(F.sum("delta").alias("delta"), F.count_if(F.col("delta") < 0).alias("regressed"))
    reasons = compare.ship_reasons(F.col("delta"), F.col("regressed"))
    return d.select("delta", "regressed", F.array_join(reasons, ",").alias("reasons"), (F.size(reasons) == 0).alias("ship"))


def warm_decision(spark, sf_dir):
    u = table(spark, sf_dir, "pages").select("page_id", urls.host(F.col("url")).alias("site"), urls.normalize(F.col("url")).alias("url")).where("url is not null")
    flags = u.groupBy("site", "url").agg(
        F.bool_or(F.col("page_id") % 5 != 0).alias("before"), F.bool_or(F.col("page_id") % 7 != 0).alias("after"), F.bool_and(F.col("page_id") % 11 != 0).alias("same_hash")
    )
    return compare.warm_decision(flags)


def warm_touch(spark, sf_dir):
    """Listings of sites after a scrape: seen again, removed, gone before, and new addresses."""
    u = table(spark, sf_dir, "pages").select("page_id", urls.host(F.col("url")).alias("site"), urls.normalize(F.col("url")).alias("url")).where("url is not null")
    at = lambda n: F.timestamp_seconds(F.lit(n))
    old = u.where("page_id % 5 <> 0").groupBy("site", "url").agg(F.min("page_id").alias("k")).select("site", "url", at(1_500_000_000).alias("last_seen_at"), F.when(F.col("k") % 4 == 0, at(1_510_000_000)).alias("removed_at"))
    out = compare.touched(old, u.where("page_id % 7 <> 0"), at(1_600_000_000))
    return out.select("site", "url", "action", F.unix_seconds("last_seen_at").cast("string").alias("last_seen"), F.unix_seconds("removed_at").cast("string").alias("removed"))


def json_answers(spark, sf_dir):
    """Answers of a model, with fences, talk and trailing commas, as arrays."""
    c = table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("Sure:\n```json\n["), F.concat_ws(",", F.col("c_custkey").cast("string"), F.lit("2")), F.lit(",]\n``` done")).alias("a"))
    c = c.withColumn("a", F.when(F.col("c_custkey") % 9 == 0, "nothing").otherwise(F.col("a")))
    return c.select("c_custkey", compare.json_array_of(F.col("a")).alias("json"), F.coalesce(F.json_array_length(compare.json_array_of(F.col("a"))), F.lit(0)).alias("n"))


def backoff(spark, sf_dir):
    e = events(spark, sf_dir).where("outcome = 'failure'").withColumn("attempt", F.col("k") % 5 + 1)
    return e.groupBy("attempt", compare.backoff_ms(F.col("attempt")).alias("wait_ms")).agg(F.count("*").alias("n"))


def hour_buckets(spark, sf_dir):
    return events(spark, sf_dir).groupBy(F.date_format("ts", "yyyy-MM-dd-HH").alias("hour")).agg(F.count("*").alias("n"), report.of("failure").alias("failures"))


def seeded_sample(spark, sf_dir):
    """Fifteen companies by the hash of id and seed: the same on every run and partitioning."""
    h = F.md5(F.concat(F.col("id").cast("string"), F.lit("|42")))
    return companies(spark, sf_dir).orderBy(h, "id").limit(15).select("id", "name")


def sparkline(spark, sf_dir):
    """Where each event's duration stands among the last 24 of its stage, in eight steps."""
    dealt, w = report.lately(events(spark, sf_dir), 24)
    dealt = dealt.withColumn("_most", F.max("duration_ms").over(w)).where("_own")
    most = F.col("_most")
    return dealt.select("seq", F.when(most > 0, F.floor(F.col("duration_ms") / most * 7)).otherwise(0).cast("long").alias("step"))


def kept_runs(spark, sf_dir):
    """The event log by day; only the thirty newest runs stay."""
    e = events(spark, sf_dir).withColumn("run_id", F.date_format("ts", "yyyyMMddHH"))
    return retained(e, 30).groupBy("run_id").agg(F.count("*").alias("n"))


def worst_stage(spark, sf_dir):
    """Per company the stage with the lowest share of successes, the first by name among equals."""
    s = events(spark, sf_dir).groupBy("company_id", "stage").agg(percent(report.of("success"), F.count("*")).alias("pct"))
    worst = F.min(F.struct("pct", "stage"))
    return s.groupBy("company_id").agg(worst["stage"].alias("stage"), worst["pct"].alias("pct"))


def first_failures(spark, sf_dir):
    """The first five companies with a failure, and the stage of their first one."""
    f = events(spark, sf_dir).where("outcome = 'failure'").groupBy("company_id").agg(F.min_by("stage", "seq").alias("stage"), F.min("seq").alias("seq"))
    return f.orderBy("company_id").limit(5)


def benchmark_score(spark, sf_dir):
    """Quality, speed and cost of each stage as one weighted score."""
    e = events(spark, sf_dir).groupBy("stage").agg(report.of("success").alias("ok"), F.count("*").alias("n"), F.sum("duration_ms").alias("ms"))
    quality = F.col("ok") / F.col("n")
    speed = F.lit(1.0) / (F.lit(1.0) + F.col("ms") / F.col("n") / 1000.0)
    return e.select("stage", round_half_up(quality * 0.7 + speed * 0.3, 4).alias("score"))


def prompts(spark, sf_dir):
    """Prompts rendered for parts, and placeholders that a new template lost."""
    t = F.lit("Classify {name} of {brand} by {name}: {missing}")
    lost = F.array_except(text.placeholders(t), text.placeholders(F.lit("{name} {brand}")))
    return table(spark, sf_dir, "part").select(
        "p_partkey", text.render(t, {"name": F.col("p_name"), "brand": F.col("p_brand"), "missing": F.lit(None)}).alias("prompt"), F.array_join(lost, ",").alias("lost")
    )


def cold_batch(spark, sf_dir):
    """Companies that are neither profiled nor tagged get the batch's tag."""
    c = companies(spark, sf_dir).select("id", F.when(F.col("id") % 3 == 0, "").when(F.col("id") % 3 == 1, "2026").alias("profiled"), F.when(F.col("id") % 4 == 0, "old").alias("tag"))
    due = blank(F.col("profiled")) & blank(F.col("tag"))
    return c.groupBy(F.when(due, "pb_new").otherwise(F.col("tag")).alias("tag")).agg(F.count("*").alias("n"))


def event_search(spark, sf_dir):
    """Events of companies by part of the name, whatever its case, or by id."""
    e = events(spark, sf_dir).join(companies(spark, sf_dir).select("id", "name"), F.col("company_id") == F.col("id"), "left")
    hit = F.lower(F.coalesce("name", F.lit(""))).contains("00012") | (F.col("company_id") == 7)
    return e.where(hit).groupBy("company_id", "outcome").agg(F.count("*").alias("n"))


def placeholder_jobs(spark, sf_dir):
    """Listings that only show what one looks like."""
    title = pick(("Example role", "A TEST JOB", "Lead", None), F.col("id"))
    told = F.when(F.col("id") % 7 == 0, "This is a sample description of it").otherwise(F.col("title"))
    return jobs(spark, sf_dir).groupBy(classify.is_placeholder(title, told).alias("placeholder")).agg(F.count("*").alias("n"))


def artifact_choice(spark, sf_dir):
    """Of a site's artifacts the JSON one, else the HTML one."""
    p = table(spark, sf_dir, "pages").select((F.col("page_id") % 40).alias("company_id"), F.when(F.col("page_id") % 80 == 3, "json").otherwise("html").alias("kind"), F.col("url").alias("body"))
    return prefer_json(p).select("company_id", "kind")


def sink_actions(spark, sf_dir):
    """What a sink must do with each company, and the status that the run's log gets."""
    c = companies(spark, sf_dir).select("id", "sector")
    plan = upsert_plan(c, c.where("id % 3 = 0 or sector = 'BUILDING'").unionByName(c.where("id % 6 = 0")))
    return plan.groupBy("action").agg(F.count("*").alias("n"), run_status(F.count_if((F.col("action") == "create") & (F.col("id") % 500 == 1))).alias("status"))


def lane_progress(spark, sf_dir):
    """Companies by lane, and how far each lane is."""
    c = companies(spark, sf_dir).select("id", lane_of(F.when(F.col("id") % 3 == 0, "").when(F.col("id") % 3 == 1, "2026")).alias("lane"))
    done, queued, flying = (F.count_if(F.col("id") % 7 == k) for k in (0, 1, 2))
    return c.groupBy("lane").agg(F.count("*").alias("n"), progress(done, done, queued, flying).alias("progress"))


def typed_values(spark, sf_dir):
    """Texts and numbers of answers, with nothing where there is none."""
    k = F.col("c_custkey")
    c = table(spark, sf_dir, "customer").select("c_custkey", F.when(k % 4 == 0, "  ").otherwise(F.concat(F.lit(" "), "c_mktsegment")).alias("a"), F.when(k % 3 == 0, "12x").otherwise((k / 4).cast("string")).alias("b"))
    return c.select("c_custkey", text.string_or_null(F.col("a")).alias("text"), text.number_or_null(F.col("b")).alias("number"))


#: Answers of a model by the customer's number modulo 9; ~ is the number, ^ a long string.
ANSWERS = (
    '```json\n[{"id":~},{"id":"b~", },]\n```', 'x [{"id":~,"t":{"a":1}},{"id":2},{"id', '[{"id":~},{"id":7,"s":"^"},{"id":8,"s":"^', 'Here: {"id":~,} done', "none",
    '[{"id":~,"s":"}"},{"id":2},', '{"rows":[1,2],"id":~}', '[ } {"id":~} {"id":2}', '[{"id":~,"s":"a\\"b"},{"id":oops},{"id":3}, and so on',
)


def recovered_answers(spark, sf_dir):
    """What is whole in answers with fences, stray commas, cut ends and strings that repeat themselves."""
    k = F.col("c_custkey")
    answer = F.lit("")
    for i, a in enumerate(ANSWERS):
        answer = F.when(k % 9 == i, F.replace(F.replace(F.lit(a), F.lit("~"), k.cast("string")), F.lit("^"), F.repeat(F.lit("ab\\n{"), 400))).otherwise(answer)
    got = tabular.recovered(dealt(table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey", 20_000).select(k.alias("id"), answer.alias("answer")))
    ids = F.transform("rows", lambda r: F.coalesce(F.try_variant_get(r, "$.id", "string"), F.lit("-")))
    longest = F.array_max(F.transform("rows", lambda r: F.coalesce(F.length(F.try_variant_get(r, "$.s", "string")), F.lit(0))))
    return got.select("id", "form", F.array_join(ids, ",").alias("ids"), longest.alias("longest"))


def base_addresses(spark, sf_dir):
    """Addresses with a scheme."""
    bare = F.when(F.col("page_id") % 2 == 0, F.regexp_replace("url", "^[a-z]+://", "")).otherwise(F.col("url"))
    return table(spark, sf_dir, "pages").select("page_id", urls.absolute(bare).alias("url"))


PCT = "CASE WHEN ({b}) = 0 THEN 0.0 ELSE floor(CAST(({a}) AS DOUBLE) / ({b}) * 100.0 * 10 + 0.5) / 10 END"
pct = lambda a, b: PCT.format(a=a, b=b)
HR = page_plans.SHAPED + """, b AS (SELECT shape, count(*) AS n FROM s WHERE page_id % 2 = 0 GROUP BY 1), a AS (SELECT shape, count(*) AS n FROM s WHERE page_id % 3 <> 0 GROUP BY 1),
hr AS (SELECT coalesce(a.shape, b.shape) AS shape, coalesce(b.n, 0) AS before, coalesce(a.n, 0) AS after, coalesce(a.n, 0) - coalesce(b.n, 0) AS delta FROM a FULL JOIN b ON a.shape = b.shape) """
E = f"WITH {EVENTS} "

SQL = {
    "warm_touch": page_plans.NORMAL + """, o AS (SELECT site, url, min(page_id) % 4 = 0 AS gone FROM u WHERE page_id % 5 <> 0 GROUP BY 1, 2), s AS (SELECT DISTINCT site, url FROM u WHERE page_id % 7 <> 0)
SELECT coalesce(o.site, s.site) AS site, coalesce(o.url, s.url) AS url, CASE WHEN o.url IS NULL THEN 'net_new' WHEN s.url IS NOT NULL THEN 'existing' WHEN gone THEN 'gone' ELSE 'removed' END AS action,
  CASE WHEN o.url IS NOT NULL THEN CASE WHEN s.url IS NOT NULL THEN '1600000000' ELSE '1500000000' END END AS last_seen, CASE WHEN s.url IS NULL THEN CASE WHEN gone THEN '1510000000' ELSE '1600000000' END END AS removed FROM o FULL JOIN s ON o.site = s.site AND o.url = s.url""",
    "placeholder_jobs": """SELECT o_orderkey % 7 = 0 OR o_orderkey % 4 < 2 AS placeholder, count(*) AS n FROM orders GROUP BY 1""",
    "artifact_choice": "SELECT page_id % 40 AS company_id, CASE WHEN bool_or(page_id % 80 = 3) THEN 'json' ELSE 'html' END AS kind FROM pages GROUP BY 1",
    "sink_actions": """WITH a AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 OR c_mktsegment = 'BUILDING' THEN 'update' ELSE 'create' END AS action FROM customer)
SELECT action, count(*) AS n, CASE WHEN count(*) FILTER (action = 'create' AND id % 500 = 1) > 0 THEN 'partial' ELSE 'success' END AS status FROM a GROUP BY 1""",
    "lane_progress": """WITH c AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 1 THEN 'warm' ELSE 'cold' END AS lane, c_custkey % 7 AS m FROM customer)
SELECT lane, count(*) AS n, CASE WHEN count(*) FILTER (m < 3) = 0 THEN 0.0 ELSE floor(CAST(count(*) FILTER (m = 0) AS DOUBLE) / count(*) FILTER (m < 3) * 100.0::DOUBLE + 0.5) END AS progress FROM c GROUP BY 1""",
    "typed_values": "SELECT c_custkey, CASE WHEN c_custkey % 4 <> 0 THEN c_mktsegment END AS text, CASE WHEN c_custkey % 3 <> 0 THEN c_custkey / 4.0::DOUBLE END AS number FROM customer",
    "recovered_answers": """WITH w AS (SELECT c_custkey AS id, replace(replace(CASE c_custkey % 9 """ + " ".join("WHEN %d THEN '%s'" % (i, a) for i, a in enumerate(ANSWERS)) + """ END, '~', c_custkey::VARCHAR), '^', repeat('ab\\n{', 400)) AS answer FROM customer),
s AS (SELECT id, trim(regexp_replace(answer, '```[a-z]*', chr(10), 'gi'), ' ' || chr(10)) AS s FROM w),
b AS (SELECT *, instr(s, '[') AS fa, instr(s, '{') AS fo, regexp_extract(s, '\\[.*\\]', 0, 's') AS a, regexp_extract(s, '\\{.*\\}', 0, 's') AS o FROM s),
f AS (SELECT *, regexp_replace(regexp_replace(a, ',\\s*\\]', ']', 'g'), ',\\s*\\}', '}', 'g') AS fixed, regexp_replace(o, ',\\s*\\}', '}', 'g') AS fixed_o FROM b),
g AS (SELECT *, CASE WHEN a <> '' AND json_valid(a) THEN a WHEN a <> '' AND json_valid(fixed) THEN fixed END AS va, CASE WHEN o <> '' AND json_valid(o) THEN o WHEN o <> '' AND json_valid(fixed_o) THEN fixed_o END AS vo FROM f),
-- a whole long string is capped: 500 characters, each backslash of them written twice
c AS (SELECT id, substr(array_to_string(list_transform(regexp_extract_all(s, '"(?:[^"\\\\]|\\\\.)*"|[^"]+|"'), lambda p: CASE WHEN p LIKE '"%"' AND length(regexp_replace(p, '\\\\.', 'x', 'g')) > 1002
  THEN '"' || replace(substr(p, 2, 500), '\\', '\\\\') || '…"' ELSE p END), ''), fa) AS s FROM g WHERE va IS NULL AND vo IS NULL AND fa > 0 AND fo > 0),
p AS (SELECT id, unnest(regexp_extract_all(s, '[^{}]+|[{}]')) AS x, generate_subscripts(regexp_extract_all(s, '[^{}]+|[{}]'), 1) AS i FROM c),
d AS (SELECT *, sum(CASE x WHEN '{' THEN 1 WHEN '}' THEN -1 ELSE 0 END) OVER (PARTITION BY id ORDER BY i) AS depth FROM p),
n AS (SELECT *, sum((x = '{' AND depth = 1)::INT) OVER (PARTITION BY id ORDER BY i) AS k FROM d),
r AS (SELECT id, k, string_agg(x, '' ORDER BY i) AS v FROM n WHERE depth > 0 OR depth = 0 AND x = '}' GROUP BY 1, 2 HAVING bool_or(x = '}' AND depth = 0)),
q AS (SELECT id, list(v ORDER BY k) AS vs FROM r WHERE json_valid(v) GROUP BY 1),
z AS (SELECT g.id, CASE WHEN va IS NOT NULL THEN 'array' WHEN vo IS NOT NULL THEN 'object' WHEN vs IS NOT NULL THEN 'partial' END AS form, CASE WHEN va IS NOT NULL THEN json_extract(va, '$[*]')::VARCHAR[] WHEN vo IS NOT NULL THEN [vo] ELSE vs END AS rows FROM g LEFT JOIN q USING (id))
SELECT id, form, array_to_string(list_transform(rows, lambda r: coalesce(CASE WHEN json_type(r) = 'OBJECT' THEN json_extract_string(r, '$.id') END, '-')), ',') AS ids,
  list_max(list_transform(rows, lambda r: coalesce(CASE WHEN json_type(r) = 'OBJECT' THEN length(json_extract_string(r, '$.s')) END, 0))) AS longest FROM z""",
    "base_addresses": "SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'https://' || regexp_replace(url, '^[a-z]+://', '') ELSE url END AS url FROM pages",
    "company_projection": """WITH c AS (SELECT *, CASE WHEN c_custkey % 4 <> 0 THEN 'Site' || c_custkey || '.com' END AS domain FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)
SELECT coalesce(lower(replace(domain, '.', '-')), lower(replace(c_name, '#', '')) || '-' || substr(sha1(c_name), 1, 10)) AS id, domain,
  CASE WHEN c_custkey % 7 <> 0 THEN nullif(c_acctbal, 0) END AS employees, CASE WHEN c_custkey % 3 = 0 THEN 'City, ' ELSE '' END || n_name AS hq, c_mktsegment || '|' || n_name AS keywords FROM c""",
    "sink_projection": """SELECT o_custkey, arg_min(o_orderpriority, o_orderkey) FILTER (o_orderkey % 3 = 0) AS deal_type, count(*) AS n,
  CAST(least(2000, 900 * length(CAST(o_custkey AS VARCHAR))) AS INT) AS text_length FROM orders GROUP BY 1""",
    "batch_results": f"WITH {COMPANIES} SELECT CASE WHEN id % 3 = 0 THEN 'missing_result' WHEN id % 4 = 0 THEN 'malformed_result' ELSE 'ok' END AS outcome, count(*) AS n FROM companies WHERE id % 5 = 0 GROUP BY 1",
    "headroom_compare": HR + "SELECT * FROM hr",
    "ship_gate": HR + """, t AS (SELECT CAST(sum(delta) AS BIGINT) AS delta, count(*) FILTER (delta < 0) AS regressed FROM hr)
SELECT delta, regressed, concat_ws(',', CASE WHEN delta < 40 THEN 'below_gate' END, CASE WHEN regressed > 0 THEN 'regression' END) AS reasons, delta >= 40 AND regressed = 0 AS ship FROM t""",
    "warm_decision": """WITH p AS (SELECT page_id, lower(regexp_extract(url, '^https?://([^/?#:]+)', 1)) AS site, lower(regexp_extract(url, '^https?://[^/?#:]+(?::[0-9]+)?([^?#]*)', 1)) AS path FROM pages),
f AS (SELECT site, rtrim(path, '/') AS u, bool_or(page_id % 5 <> 0) AS b, bool_or(page_id % 7 <> 0) AS a, bool_and(page_id % 11 <> 0) AS same FROM
  (SELECT p.*, regexp_extract(url, '^https?') AS s FROM p JOIN pages USING (page_id)) GROUP BY site, u, s)
SELECT site, count(*) FILTER (b AND a) AS existing, count(*) FILTER (NOT b AND a) AS net_new, count(*) FILTER (b AND NOT a) AS removed,
  coalesce(bool_or(b AND a AND NOT same), false) AS churn, count(*) FILTER (NOT b AND a) = 0 AND NOT coalesce(bool_or(b AND a AND NOT same), false) AS no_delta FROM f GROUP BY site""",
    "json_answers": "SELECT c_custkey, CASE WHEN c_custkey % 9 <> 0 THEN '[' || c_custkey || ',2]' END AS json, CASE WHEN c_custkey % 9 <> 0 THEN 2::INT ELSE 0::INT END AS n FROM customer",
    "backoff": E + "SELECT k % 5 + 1 AS attempt, CAST(500 * pow(2, k % 5) AS BIGINT) AS wait_ms, count(*) AS n FROM ev WHERE outcome = 'failure' GROUP BY 1, 2",
    "hour_buckets": E + "SELECT strftime(ts, '%Y-%m-%d-%H') AS hour, count(*) AS n, count(*) FILTER (outcome = 'failure') AS failures FROM ev GROUP BY 1",
    "seeded_sample": f"WITH {COMPANIES} SELECT id, name FROM companies ORDER BY md5(id || '|42'), id LIMIT 15",
    "sparkline": E + """SELECT seq, CAST(CASE WHEN max(duration_ms) OVER w > 0 THEN floor(CAST(duration_ms AS DOUBLE) / max(duration_ms) OVER w * 7) ELSE 0 END AS BIGINT) AS step
FROM ev WINDOW w AS (PARTITION BY stage ORDER BY seq ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)""",
    "kept_runs": E + """, r AS (SELECT strftime(ts, '%Y%m%d%H') AS run_id FROM ev) SELECT run_id, count(*) AS n FROM r
WHERE run_id IN (SELECT DISTINCT run_id FROM r ORDER BY run_id DESC LIMIT 30) GROUP BY 1""",
    "worst_stage": E + f""", s AS (SELECT company_id, stage, {pct("count(*) FILTER (outcome = 'success')", "count(*)")} AS pct FROM ev GROUP BY 1, 2)
SELECT company_id, stage, pct FROM (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY pct, stage) AS rn FROM s) WHERE rn = 1""",
    "first_failures": E + "SELECT company_id, arg_min(stage, seq) AS stage, min(seq) AS seq FROM ev WHERE outcome = 'failure' GROUP BY 1 ORDER BY 1 LIMIT 5",
    "benchmark_score": E + """SELECT stage, floor((CAST(count(*) FILTER (outcome = 'success') AS DOUBLE) / count(*) * 0.7::DOUBLE + 1.0::DOUBLE / (1.0::DOUBLE + CAST(sum(duration_ms) AS DOUBLE) / count(*) / 1000.0::DOUBLE) * 0.3::DOUBLE) * 10000 + 0.5) / 10000 AS score FROM ev GROUP BY 1""",
    "prompts": "SELECT p_partkey, 'Classify ' || p_name || ' of ' || p_brand || ' by ' || p_name || ': ' AS prompt, 'missing' AS lost FROM part",
    "cold_batch": f"WITH {COMPANIES} SELECT CASE WHEN id % 3 <> 1 AND id % 4 <> 0 THEN 'pb_new' WHEN id % 4 = 0 THEN 'old' END AS tag, count(*) AS n FROM companies GROUP BY 1",
    "event_search": f"WITH {EVENTS}, {COMPANIES} SELECT company_id, outcome, count(*) AS n FROM ev LEFT JOIN companies ON company_id = id WHERE contains(lower(coalesce(name, '')), '00012') OR company_id = 7 GROUP BY 1, 2",
}
QUERIES = {k: globals()[k] for k in SQL}

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import categorize, providers, temporal, upsert
from tidemark.sources import tables
from tidemark.streaming import live


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_consecutive_empty_and_dormancy(spark):
    runs = spark.createDataFrame([(1, 1, 3), (1, 2, 0), (1, 3, 0), (1, 4, 0), (2, 5, 0), (2, 6, 0), (2, 7, 4)], "company_id long, seq long, job_count long")
    assert rows(temporal.consecutive_empty(runs)) == [(1, 3), (2, 0)]
    companies = spark.createDataFrame([(1, None), (2, True), (3, None)], "id long, was_dormant boolean")
    got = temporal.dormancy(companies, runs).select("id", "empty_runs", "dormant", "changed")
    assert rows(got) == [(1, 3, True, True), (2, 0, False, True), (3, 0, False, False)]


def test_merge_jobs(spark):
    t0, now = dt.datetime(2020, 1, 1), dt.datetime(2021, 1, 1)
    schema = "ord long, url string, description_hash string, title string, first_seen_at timestamp, last_seen_at timestamp, removed_at timestamp"
    old = spark.createDataFrame([(1, "u", "h1", "", t0, t0, t0), (2, None, "h2", "B", t0, t0, None), (3, "w", "h3", "C", t0, t0, None)], schema)
    new = spark.createDataFrame([(4, "u", "h1", "A", now, now, None), (5, "u", "h9", "Z", now, now, None), (6, "", "h2", "", now, now, None), (7, "n", "h", "N", now, now, None)], schema)
    got = {r["ord"]: r for r in upsert.merge_jobs(old, new, F.lit(now)).collect()}
    assert sorted(got) == [1, 2, 3, 7]
    assert got[1]["title"] == "A" and got[1]["removed_at"] is None and got[1]["last_seen_at"] == now and got[1]["first_seen_at"] == t0
    assert got[2]["last_seen_at"] == now and got[3]["last_seen_at"] == t0


def test_keyword_rule_and_cascade(spark):
    c = spark.createDataFrame([(1, " Solar  Panel"), (1, "wind"), (2, "wind"), (2, "solar panel"), (3, "none")], "company_id long, keyword string")
    t = spark.createDataFrame([("S", "solar panel"), ("S", "wind"), ("W", "wind")], "category string, keyword string")
    assert rows(categorize.keyword_rule(c, t)) == [(1, "S", 2), (2, "S", 2)]
    tie = spark.createDataFrame([("S", "wind"), ("W", "wind")], "category string, keyword string")
    assert rows(categorize.keyword_rule(c, tie)) == [(1, None, 1), (2, None, 1)]
    entries = spark.createDataFrame([("s", "a", None), ("v", "b", "B")], "section string, key string, category string")
    companies = spark.createDataFrame([(1, ["x", "A"], ["b"]), (2, ["x"], ["B"]), (3, None, ["q"])], "id long, s array<string>, v array<string>")
    got = categorize.dictionary_cascade(companies, entries, [("s", "s"), ("v", "v")]).select("id", "category", "hint", "section")
    assert rows(got) == [(1, None, True, "s"), (2, "B", True, "v"), (3, None, False, None)]


def test_provider_forms(spark):
    a = spark.createDataFrame(
        [(1, None, None, '{"jobs":[{"title":"T","absolute_url":"u","location":{"name":"L"}}]}'), (2, None, None, '[{"text":"T","hostedUrl":"u"}]'),
         (3, "workable", "s", '{"results":[{"title":"T","shortcode":"c","location":{"city":"C","country":"K"}}]}'), (4, None, None, "nope"), (5, None, None, "{}")],
        "company_id long, platform string, slug string, body string",
    )
    got = rows(providers.listings(a).select("company_id", "provider", "title", "url", "location"))
    assert got == [(1, "greenhouse", "T", "u", "L"), (2, "lever", "T", "u", None), (3, "workable", "T", "https://apply.workable.com/s/j/c", "C, K")]


def test_streams_count_and_forget_repeats(spark, tmp_path):
    t = dt.datetime(2024, 1, 1)
    data = [(f"s{i % 2}", i // 2, t + dt.timedelta(seconds=i), "failure" if i % 5 == 0 else "success") for i in range(40)]
    spark.createDataFrame(data, "stage string, seq long, ts timestamp, outcome string").coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = lambda: spark.readStream.schema("stage string, seq long, ts timestamp, outcome string").parquet(f"{tmp_path}/in")

    def run(df, name, mode):
        q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", f"{tmp_path}/{name}").trigger(availableNow=True).start()
        q.awaitTermination(120)
        return rows(spark.table(name))

    assert run(live.outcome_counts(stream()), "counts", "complete") == sorted([("s0", "failure", 4), ("s0", "success", 16), ("s1", "failure", 4), ("s1", "success", 16)])
    assert len(run(live.once(stream(), ["seq"]), "once", "append")) == 20
    windows = run(live.throughput(stream(), "20 seconds", "20 seconds"), "windows", "complete")
    assert [(w[0], w[3], w[4]) for w in windows] == [("s0", 10, 2), ("s0", 10, 2), ("s1", 10, 2), ("s1", 10, 2)]


def test_an_empty_table_of_companies_is_an_error(spark):
    import pytest

    from tidemark.operators import states

    c = spark.createDataFrame([("1", " "), ("example", "A"), ("2", "EXAMPLE"), (None, None)], "id string, name string")
    with pytest.raises(ValueError):
        states.validated(c)
    assert rows(states.validated(c.unionByName(spark.createDataFrame([("3", "B")], "id string, name string")))) == [("3", "B")]


def test_merge_lets_an_earlier_listing_win(spark):
    t = lambda n: dt.datetime(2020, 1, 1) + dt.timedelta(days=n)
    schema = "ord long, url string, description_hash string, title string, first_seen_at timestamp, last_seen_at timestamp, removed_at timestamp"
    old = spark.createDataFrame([(1, "u", "h1", "A", t(50), t(50), None), (2, "v", "h2", "", t(1), t(1), t(2)), (3, "v", "h3", "C", t(0), t(0), None), (9, "u", "h1", "last", t(60), t(60), None)], schema)
    new = spark.createDataFrame([(4, "u", "hx", "N", t(10), t(10), None), (5, "u", "hy", "M", t(10), t(10), None), (6, "v", "h2", "F", t(10), t(10), None)], schema)
    got = {r["url"]: r for r in upsert.merge_jobs(old, new, F.lit(t(10))).collect()}
    assert got["u"]["ord"] == 4 and got["u"]["first_seen_at"] == t(10)  # first seen before the stored one
    assert got["v"]["ord"] == 3 and got["v"]["last_seen_at"] == t(0)  # what was hit is the other listing of the address


def test_event_log_skips_what_is_no_json(spark, tmp_path):
    lines = ['{"ts":"2024-01-01T00:00:00Z","run_id":"r","stage":"scrape","outcome":"success","duration_ms":5,"net_new":2}', "not-json", "[1]", ""]
    (tmp_path / "a.jsonl").write_text("\n".join(lines))
    got = tables.read_events(spark, str(tmp_path)).select("stage", "duration_ms", F.try_variant_get("extra", "$.net_new", "long"))
    assert rows(got) == [("scrape", 5, 2)]
    path = f"{tmp_path}/t"
    tables.write_version(spark.range(3), path)
    tables.write_version(spark.range(5), path)
    assert tables.read_version(spark, path).count() == 5 and tables.read_version(spark, path, 1).count() == 3
    assert tables.read_json_table(spark, f"{tmp_path}/none.json", "a long").count() == 0


def test_increment_has_all_rows_and_parts_ties(spark):
    t = dt.datetime(2024, 1, 1)
    table = spark.createDataFrame([(i, t if i < 800 else t + dt.timedelta(1)) for i in range(1300)], "id long, at timestamp")
    got = tables.increment(table, F.lit(t - dt.timedelta(1)), at="at", key="id")
    assert rows(got.groupBy("page").agg(F.min("id"), F.max("id"))) == [(1, 0, 499), (2, 500, 999), (3, 1000, 1299)]
    rest = tables.increment(table, F.lit(t), at="at", key="id", after=F.lit(499))
    assert sorted(r["id"] for r in rest.collect()) == list(range(500, 1300))


def test_log_is_appended_streamed_and_kept(spark, tmp_path):
    log = spark.createDataFrame([(f"r{i % 4}", "scrape", i) for i in range(12)], "run_id string, stage string, seq long")
    tables.append_events(log.where("run_id < 'r2'"), f"{tmp_path}/log")
    tables.append_events(log.where("run_id >= 'r2'"), f"{tmp_path}/log")
    got = spark.read.parquet(f"{tmp_path}/log")
    assert got.count() == 12 and rows(tables.retained(got, 2).select("run_id").distinct()) == [("r2",), ("r3",)]
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "a.jsonl").write_text('{"stage":"scrape","duration_ms":5}\nno json\n')
    q = tables.stream_events(spark, f"{tmp_path}/lines").writeStream.format("memory").queryName("tail").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert rows(spark.table("tail").select("stage", "duration_ms")) == [("scrape", 5)]
    assert tables.missing_columns(["Stage", "Lane"], got) == ["Lane"]

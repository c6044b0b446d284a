"""Followed logs, commands, folders of files, substrings and manifests by rows made by hand."""

import datetime as dt
import json
import random

from tidemark.operators import manifests, substrings
from tidemark.sources import files
from tidemark.streaming import commands, snapshots

T = dt.datetime(2024, 1, 1, 10)
EVENT = "ts timestamp, stage string, outcome string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_snapshots_survive_a_replayed_batch(spark, tmp_path):
    at, out = f"file://{tmp_path}/in", f"file://{tmp_path}/out"

    def add(*events):
        spark.createDataFrame(list(events), EVENT).coalesce(1).write.mode("append").parquet(at)

    def follow():
        snapshots.follow(spark.readStream.schema(EVENT).parquet(at), out, ("a", "b")).awaitTermination()
        return {(s["stage"], s["outcome"]): s["n"] for s in snapshots.latest(spark, out).first()["stages"] if s["n"]}

    add((T, "a", "success"), (T, "a", "failure"), (T, "other", "success"))
    assert follow() == {("a", "success"): 1, ("a", "failure"): 1}
    add((T + dt.timedelta(hours=1), "b", "skipped"), (T, "a", "success"))
    expected = {("a", "success"): 2, ("a", "failure"): 1, ("b", "skipped"): 1}
    assert follow() == expected
    last = snapshots.latest(spark, out).first()
    assert (last["batch"], last["total"], last["last_at"]) == (1, 5, T + dt.timedelta(hours=1))
    for name in ("1", ".1.crc"):
        (tmp_path / "out/log/commits" / name).unlink()  # as if the driver was lost before the batch was committed
    assert follow() == expected and snapshots.latest(spark, out).first() == last
    assert spark.read.parquet(f"{out}/events").count() == 5
    assert [(r["hour"], r["total"]) for r in snapshots.hourly(spark, out).orderBy("hour").collect()] == [("2024-01-01-10", 3), ("2024-01-01-11", 5)]


def test_commands_are_consumed_once(spark, tmp_path):
    path, state = f"file://{tmp_path}/queue", f"file://{tmp_path}/state"
    take = lambda: rows(commands.consume(spark, path, state, ("scrape", "extract")).select("id", "stage"))
    put = lambda *c: commands.queue(spark.createDataFrame([(i, s, T) for i, s in c], commands.COMMAND), path)
    assert take() == []
    put(("1", "scrape"), ("2", "nobody"), ("3", None), (None, "scrape"))
    assert take() == [("1", "scrape")]
    assert take() == []
    put(("1", "scrape"), ("2", "scrape"), ("4", "extract"))
    (tmp_path / "queue/noise.json").write_text("not json\n")
    assert take() == [("4", "extract")]


def test_folders_of_files(spark, tmp_path):
    for name in ("a/one.html", "a/one.playwright.html", "a/two.html", "a/two.json", "a/x.y.html", "a/.html", "b/s.PDF", "b/i.PnG", "b/two.html", "c/.png", "c/notes"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("x" * len(name))
    listed = files.listing(spark, f"file://{tmp_path}")
    short = listed.selectExpr("right(folder, 1) AS folder", "name", "bytes")
    assert (("b", "two.html", 10) in rows(short)) and short.count() >= 9
    assert {r["name"] for r in files.listing(spark, f"file://{tmp_path}", "*.html").collect()} >= {"one.html", "two.html"}
    assert {(r["folder"], r["id"]) for r in files.canonical_pages(short).collect()} - {("a", "")} == {("a", "one"), ("b", "two")}
    modes = {r["folder"]: (r["mode"], r["n_pdf"], r["n_image"]) for r in files.input_modes(short).collect()}
    assert modes["a"] == ("images", 0, 0) and modes["b"] == ("pdf-dir", 1, 1)
    assert files.input_modes(short.where("name = 's.PDF'"), single=True).first()["mode"] == "pdf"


def test_substrings_equal_brute_force(spark):
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("abé") for _ in range(n))
    texts = [(i, word(rng.randrange(0, 30))) for i in range(60)] + [(100, None), (101, "https://x"), (102, "https://x")]
    patterns = [(i, word(rng.randrange(0, 9))) for i in range(60)] + [(70, None), (71, "https://x"), (72, "https://"), (73, "nowhere at all"), (74, "a%_\\")]
    t, p = spark.createDataFrame(texts, "text_id long, text string"), spark.createDataFrame(patterns, "pattern_id long, pattern string")
    got = substrings.contained(t, p)
    assert rows(got) == sorted(((i, j) for i, x in texts for j, y in patterns if x is not None and y and y in x), key=str)
    assert "NestedLoop" not in got._jdf.queryExecution().toString()
    assert substrings.contained(t, p.limit(0)).count() == 0 and substrings.contained(t.limit(0), p).count() == 0


def test_manifests(spark):
    good = {"id": "a", "shape": "other", "expected_min_jobs": 0, "must_not_match": ["bad", ""], "require_high_signal": True}
    entries = [good, {**good, "shape": None}, {**good, "id": "b", "must_not_match": [None]}, 5, {"id": 7}]
    e = spark.createDataFrame([(i, json.dumps(x)) for i, x in enumerate(entries)] + [(9, "{"), (10, None)], "ord int, entry string")
    names = spark.createDataFrame([("a.html",), ("a.html",)], "name string")
    shapes = "shape must be one of: many-career-path-hrefs, other, webflow-dom, wordpress-careers-ish"
    assert rows(manifests.errors(e, names, "/f")) == sorted(
        [
            (1, "duplicate fixture id: a"), (1, f"fixtures[1].{shapes}"), (2, 'missing fixture file for id "b": /f/b.html'), (2, "fixtures[2].must_not_match[0] must be a string"), (3, "fixtures[3]: must be an object"),
            (4, "fixtures[4].id must be a non-empty string"), (4, f"fixtures[4].{shapes}"), (4, "fixtures[4].expected_min_jobs must be a non-negative integer"), (4, "fixtures[4].must_not_match must be an array of strings"),
            (9, "fixtures[9]: must be an object"), (10, "fixtures[10]: must be an object"),
        ], key=str,
    )
    found = spark.createDataFrame([("a", "https://x/bad/1"), ("a", "https://x/good"), ("b", "https://x/bad/2"), ("a", None)], "id string, url string")
    assert rows(manifests.violations(e, found)) == [("a", "https://x/bad/1", "bad")]
    decided = spark.createDataFrame([("a", "shopify", "wix", 2)], "id string, shape string, adapter string, n_links int")
    assert rows(manifests.report(e, decided)) == [("shopify", 2, 2, 2, 2), (None, 1, 0, 1, 1)]

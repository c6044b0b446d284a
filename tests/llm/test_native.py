import datetime as dt
import random

from tests.llm import data
from tidemark.llm import licenses, url_filters

CAPTURES = "page_id long, url string, fetched_on date, entry string, list string, salt int"
LOG = "list string, entry string, action string, day date, note string"


def day(n):
    return None if n is None else dt.date(2024, 1, 1) + dt.timedelta(n)


def brute(url, fetched, log):
    import re

    m = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)[^/?#]*([^?#]*)", url or "")
    if not m or fetched is None:
        return set(), 0
    host = re.sub(r"^www\.", "", m[1].lower())
    whole = "/".join([host, *[p for p in m[2].split("/") if p]])
    hits = set()
    for name, entry in {(x[0], x[1]) for x in log if x[0] and x[1]}:
        holds = whole == entry or whole.startswith(entry + "/") if "/" in entry else host == entry or host.endswith("." + entry)
        days = sorted({x[3] for x in log if (x[0], x[1]) == (name, entry) and x[3] and x[3] <= fetched and x[2] in ("add", "remove")})
        if holds and days and not any(x[2] == "remove" for x in log if (x[0], x[1], x[3]) == (name, entry, days[-1])):
            hits.add((name, entry))
    return {n for n, _ in hits}, len(hits)


def test_url_filters_match_brute_force(spark):
    r = random.Random(4)
    hosts = ["a.com", "x.a.com", "y.x.a.com", "b.org", "www.b.org", "c.net"]
    log = [(r.choice("pq"), r.choice(["a.com", "x.a.com", "b.org", "c.net/ads", "a.com/x/y"]), r.choice(["add", "add", "remove"]), day(r.randint(0, 60)), "n") for _ in range(60)]
    log += [(None, "a.com", "add", day(1), ""), ("p", None, "add", day(1), ""), ("p", "b.org", None, day(1), ""), ("p", "b.org", "add", None, "")]
    rows = [(i, f"https://{r.choice(hosts)}:80/{r.choice(['', 'ads', 'ads/1?q', 'x/y/z#f', 'adsx'])}", day(r.randint(0, 70)), "e", "l", 1) for i in range(300)]
    rows += [(1000, None, day(5), None, None, None), (1001, "nothing", day(5), None, None, None), (1002, "https://a.com/", None, None, None, None), (None, "https://a.com/", day(30), None, None, None)]
    rows += rows[:7]
    out = url_filters.evaluate(spark.createDataFrame(rows, CAPTURES), spark.createDataFrame(log, LOG)).collect()
    want = sorted(str((i, u, f, *(lambda h: (",".join(sorted(h[0])), h[1]))(brute(u, f, log)))) for i, u, f, *_ in rows)
    assert sorted(str((x["page_id"], x["url"], x["fetched_on"], x["lists"], x["n_entries"])) for x in out) == want
    assert all(x["blocked"] == (x["n_entries"] > 0) for x in out)
    nothing = spark.createDataFrame([], LOG)
    assert url_filters.evaluate(spark.createDataFrame(rows, CAPTURES), nothing).where("blocked").count() == 0
    assert url_filters.evaluate(spark.createDataFrame([], CAPTURES), spark.createDataFrame(log, LOG)).count() == 0


def test_licences_are_found_and_prose_is_left(spark):
    lines = {1: ("MIT", "Released under the MIT License."), 3: ("GPL", "This work is licensed under the GNU General Public License, version 3."),
             5: ("Apache-2.0", "Licensed under the Apache License, Version 2.0."), 7: ("CC-BY-NC", "Licensed under CC BY-NC 4.0."),
             9: ("unknown", "This code is licensed under the Eclipse Public License.")}
    rows = [data.row(i, data.prose(60, i) + ("\n" + lines[i][1] + "\n" + data.prose(30, i) if i in lines else "")) for i in range(20)] + data.edge_rows()[10:]
    rows += [data.row(1, rows[1][1])]
    docs = data.frame(spark, rows)
    model = licenses.fit(docs)
    out = licenses.scan(docs, model).collect()
    known = {k: f for k, (f, _) in lines.items() if f != "unknown"}
    assert sorted((r["doc_id"], r["family"]) for r in out if r["confirmed"]) == sorted([(1, "MIT"), *known.items()])
    assert [r["doc_id"] for r in out if not r["confirmed"]] == [9]  # a licence that no template confirms
    assert licenses.scan(data.empty(spark), model).count() == 0 and licenses.fit(data.empty(spark)).families[-1] == "none"
    # the scan gives what the model gives
    for r in out:
        p = model.probabilities([licenses.grams(licenses._token.findall(lines[r["doc_id"]][1].lower()))])[0]
        assert abs(p[:-1].max() - r["probability"]) < 1e-5


def test_deep_and_unlike_entries_hold(spark):
    deep = ".".join("abcdefgh") + ".com"
    entries = ["c.net/1/2/3/4", "c.net/1/2/3/4/5/6/7", deep, "WWW.Example.ORG", "HTTPS://www.Slash.net:443//A//b/#top", "example.net/?ad=1", "zip"]
    log = [("p", e, "add", day(1), "") for e in entries]
    urls = {"https://c.net/1/2/3/4/5": 1, "https://c.net/1/2/3/4/5/6/7/8": 2, "https://c.net/1/2/3": 0, f"http://x.y.{deep}/": 1, "http://a.example.org/q": 1,
            "http://slash.net/A/b/c": 1, "http://slash.net/a/b": 0, "http://example.net/?ad=1": 0, "http://q.zip/": 1}
    captures = spark.createDataFrame([(i, u, day(5), "e", "l", 1) for i, u in enumerate(urls)], CAPTURES)
    out = url_filters.evaluate(captures, spark.createDataFrame(log, LOG)).collect()
    assert {r["url"]: r["n_entries"] for r in out} == urls


def test_licence_words_stay_however_common(spark):
    notice = "Confidential and proprietary. Unauthorized copying of this file is strictly prohibited. All rights reserved."
    tail = {i: "All rights reserved." if i % 4 else notice for i in range(40)}
    docs = data.frame(spark, [data.row(i, data.prose(60, i) + "\n" + tail[i]) for i in tail])
    model = licenses.fit(docs)
    assert {"rights", "reserved", "license", "copyright"} <= set(model.vocabulary)
    out = licenses.scan(docs, model).collect()
    assert sorted(r["doc_id"] for r in out if r["confirmed"] and r["family"] == "Proprietary") == sorted(tail) and len(out) == len(tail)

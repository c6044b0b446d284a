from pyspark.sql import functions as F

from tidemark.functions import classify, lifecycle, numbers, text, urls


def one(spark, column, **values):
    names = ", ".join(f"{k} {'string' if v is None or isinstance(v, str) else 'double' if isinstance(v, float) else 'long'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], names).select(column).first()[0]


def test_rounding_goes_up_on_the_binary_value(spark):
    assert one(spark, numbers.round_half_up(F.col("x"), 2), x=1.005) == 1.0
    assert one(spark, numbers.round_half_up(F.col("x"), 0), x=2.5) == 3.0
    assert one(spark, numbers.percent(F.col("a"), F.col("b")), a=1, b=0) == 0.0
    assert one(spark, numbers.delta_text(F.col("a"), F.col("b")), a=0.0, b=0.0) == "—"
    assert one(spark, numbers.delta_text(F.col("a"), F.col("b")), a=0.0, b=2.0) == "+∞"
    assert one(spark, numbers.delta_text(F.col("a"), F.col("b")), a=4.0, b=5.0) == "+25.0%"


def test_percentile_takes_the_value_at_the_floor(spark):
    df = spark.createDataFrame([(i,) for i in range(1, 12)], "x long").agg(F.collect_list("x").alias("v"))
    assert df.select(numbers.percentile_at(F.col("v"), 95)).first()[0] == 11
    assert df.select(numbers.percentile_at(F.col("v"), 50)).first()[0] == 6


def test_addresses(spark):
    n = lambda u: one(spark, urls.normalize(F.col("u")), u=u)
    assert n("https://Team.Tidewater.org/Open-Posts/Ab-9//?from=mail#apply") == "https://team.tidewater.org/open-posts/ab-9"
    assert n("http://u:p@a.com:8080") == "http://a.com/" and n("ftp://a.com/x") is None and n(None) is None
    both = lambda a: one(spark, urls.signature(F.split("u", " ")), u=a)
    assert both("https://a.com/1 https://a.com/2/") == both("https://a.com/2 https://A.com/1 https://a.com/1")
    assert one(spark, urls.slug_of_url(F.col("u")), u="https://omega.recruitee.com/o/x") == "omega"
    assert one(spark, urls.looks_like_listing(F.col("u")), u="/careers/lead") and not one(spark, urls.looks_like_listing(F.col("u")), u="mailto:jobs@x.com")
    assert one(spark, urls.is_listing_index(F.col("u")), u="/Jobs/") and one(spark, urls.is_denied_path(F.col("u")), u="/jobs/privacy.html")
    assert one(spark, urls.resolve(F.col("u"), F.col("b")), u="../x", b="https://a.com/b/c") == "https://a.com/x"


def test_text(spark):
    assert one(spark, text.slugify_any(F.col("x")), x=" Crème & Co. -- Ltd ") == "creme-co-ltd"
    assert one(spark, F.array_join(text.split_delimited(F.col("x")), "/"), x="a, b;;c | ") == "a/b/c"
    assert one(spark, text.split_delimited(F.col("x")), x=" ,; ") is None
    assert one(spark, text.render(F.lit("{a}-{a}-{b}"), {"a": F.col("x"), "b": F.lit(None)}), x="1") == "1-1-"


def test_titles(spark):
    t = lambda f, x: one(spark, f(F.col("x")), x=x)
    assert t(classify.normal_title, "Sr. Eng  III") == "Senior Engineer" and t(classify.normal_title, None) == ""
    assert t(classify.job_function, "Senior Data Scientist") == "data_science" and t(classify.job_function, "Chef") is None
    assert t(classify.seniority, "Vice President, Sales") == "vp" and t(classify.seniority, "Office Manager") == "mid"
    assert t(classify.seniority, "Product Manager") == "unknown" and t(classify.seniority, "Summer Internship") == "intern"
    f = lambda stage, status, m: one(spark, classify.failure_class(F.col("s"), F.col("c"), F.col("m")), s=stage, c=status, m=m)
    assert f("scrape", 429, "x") == "rate_limit" and f("scrape", 0, "ECONNRESET") == "transient_network" and f("extract", 0, "was empty") == "bad_data"
    assert f("scrape", 0, "llm prompt unavailable") == "config" and f("x", 401, "") == "auth" and f("x", 0, "odd") == "unknown"


def test_stages(spark):
    names = ("wrds_last_updated", "profile_attempted_at", "careers_page_discovery_method", "fingerprint_attempted_at", "last_scraped_at",
             "last_scrape_outcome", "last_extracted_at", "last_enriched_at", "category_attempted_at", "climate_tech_category")
    schema = ", ".join(f"{n} string" for n in names) + ", careers_page_reachable boolean"
    full = dict.fromkeys(names, "x")

    def stage(reachable=True, **gone):
        row = {**full, "last_scrape_outcome": "success", **gone}
        return spark.createDataFrame([(*[row[n] for n in names], reachable)], schema).select(lifecycle.stage_of()).first()[0]

    assert stage() == "done" and stage(last_enriched_at="") == "enrich" and stage(profile_attempted_at=None) == "profile"
    assert stage(profile_attempted_at="", wrds_last_updated=None) == "wrds_ingest" and stage(reachable=False) == "done"
    assert stage(reachable=False, category_attempted_at=None, climate_tech_category="") == "categorize"
    assert stage(last_scrape_outcome="skipped_signature_match", last_extracted_at=None) == "done"


def test_links_are_resolved_as_python_does(spark):
    from urllib.parse import urljoin

    bases = ["https://a.com/b/c", "https://a.com", "http://a.com/x/?q#f", "https://a.com/b/c.html?x=/y"]
    links = ["d", "/d", "//e.org/f", "?q=1", "#top", "http://z.com", "../up", "./here", "a/../b", "", "mailto:x@y.z", "javascript:void(0)", "d/e?f#g"]
    rows = [(u, b) for u in links for b in bases]
    got = [r[0] for r in spark.createDataFrame(rows, "u string, b string").coalesce(1).select(urls.resolve(F.col("u"), F.col("b"))).collect()]
    for (u, b), g in zip(rows, got):
        want = urljoin(b, u)
        assert g == (want if want.startswith("http") else None), (u, b, g)

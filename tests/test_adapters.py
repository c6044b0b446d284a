"""Adapters, provider addresses and the category cascade by rows made by hand."""

from tidemark.operators import adapters, categorize, providers

BASE = "https://acme.example.org/careers/"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_first_adapter_with_a_hit_wins(spark):
    shop = '<link href="https://cdn.shopify.com/x">'
    pages = spark.createDataFrame(
        [
            (1, BASE, shop + '<a href="/pages/welder">Welder</a><a href="https://boards.greenhouse.io/a/jobs/1">G</a>'),
            (2, BASE, shop + '<a href="/pages/FAQ">f</a><a href="pages/relative">r</a><a href="https://boards.greenhouse.io/a/jobs/1">G</a>'),
            (3, BASE, '<a href="https://x.notion.site/Role"></a><a href="https://x.notion.site/Home">h</a>'),
            (4, BASE, '<main><a href="/jobs/one">One</a></main>'),
            (5, BASE, "<urlset ><a href='/jobs/one'>One</a>"), (6, BASE, None), (7, BASE, ""),
        ],
        "page_id long, url string, html string",
    )
    host = "https://acme.example.org"
    assert rows(adapters.registry(pages).select("page_id", "adapter", "url", "title")) == [
        (1, "shopify", f"{host}/pages/welder", "Welder"), (2, "greenhouse", "https://boards.greenhouse.io/a/jobs/1", "G"),
        (3, "notion", "https://x.notion.site/Role", "Role"), (4, "anchor-job-links", f"{host}/jobs/one", "One"),
    ]
    answers = spark.createDataFrame([(4, None, None, "no json")], "company_id long, platform string, slug string, body string")
    decided = adapters.paths(pages, answers)
    assert rows(decided.select("page_id", "path", "n_listings")) == [
        (1, "adapter", 1), (2, "adapter", 1), (3, "adapter", 1), (4, "json", 0), (5, "xml_or_sitemap", 0), (6, "adapter_empty", 0), (7, "adapter_empty", 0),
    ]
    assert adapters.registry(pages.limit(0)).count() == 0
    assert {r["misses"] for r in adapters.headroom(decided).collect()} <= {1, 2} and adapters.headroom(decided.where("adapter IS NOT NULL")).count() == 0


def test_addresses_of_answers(spark):
    a = spark.createDataFrame(
        [
            (1, "lever_api", None, BASE, '[{"hostedUrl":"https://L.co:80/A/?q"},{"hostedUrl":"https://l.co/a"},null,{}]'), (2, "workable_api", "s", BASE, '{"results":[{"shortcode":"C"}]}'),
            (3, "teamtailor_api", None, BASE, '{"jobs":[{"url":"x/../y"}]}'), (4, "bamboohr_api", None, BASE, "<a href='z'>"), (5, "ashby_api", None, BASE, "[]"), (6, "lever_api", None, None, '[{"url":"/x"}]'), (7, None, None, BASE, None),
        ],
        "company_id long, provider string, slug string, base string, body string",
    )
    assert rows(providers.addresses(a)) == [(1, "https://l.co/a"), (2, "https://apply.workable.com/s/j/c"), (3, BASE + "y"), (4, BASE + "z")]


def test_cascade_falls_through_to_keywords(spark):
    companies = spark.createDataFrame([(1, ["q"], " C1 "), (2, ["a"], "c1"), (3, None, "c2"), (4, None, None), (5, [], "")], "id long, tags array<string>, code string")
    entries = spark.createDataFrame([(1, "t", "A", "First"), (2, "t", "a", None), (3, "c", "c1", "Code")], "ord int, section string, key string, category string")
    keywords = spark.createDataFrame([(1, "sun"), (3, "sun"), (4, "sun"), (4, "air")], "company_id long, keyword string")
    taxonomy = spark.createDataFrame([("Solar", "Sun"), ("Wind", "air")], "category string, keyword string")
    got = categorize.taxonomy_cascade(companies, entries, [("t", "tags", "high"), ("c", "code", "medium")], keywords, taxonomy)
    assert rows(got) == [(1, "Code", "medium", "c", False), (2, None, None, "t", True), (3, "Solar", "high", "rule", False), (4, None, None, None, False), (5, None, None, None, False)]

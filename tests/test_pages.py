"""Rows made by hand for each branch of the rules about documents and pages."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions import nested, text, urls
from tidemark.operators import builders, markup, providers, tabular


def test_placed_texts_at_any_depth(spark):
    docs = {
        1: '{"pages":[{"pageNum":"3","textItems":[{"text":" a ","x":1,"y":2},{"text":"","x":1,"y":1},{"text":"b","left":null,"top":0}]},{"textItems":[{"text":"c","x":true,"y":" 4 "}]}]}',
        2: '{"page":5,"k":[[{"content":"d","left":1,"top":2},{"page_number":null,"pageIndex":7,"z":{"value":"e","x":"1e1","y":2}}]],"twice":[{"text":"d","x":1,"y":2}]}',
        3: '{"pages":[{"textItems":[]}],"rest":{"text":"f","x":{},"y":1,"in":{"text":9,"content":"g","x":0,"y":0}}}',
        4: "{broken", 5: '{"a":1} {"b":2}', 6: None, 7: '[{"page":0,"text":" ","x":1,"y":1}]',
    }
    got = tabular.coordinate_items(spark.createDataFrame(list(docs.items()), "doc long, json string")).collect()
    assert sorted(tuple(r) for r in got) == [
        (1, 2.0, 4.0, 1.0, "c"), (1, 3.0, 0.0, 0.0, "b"), (1, 3.0, 2.0, 1.0, "a"), (2, 5.0, 2.0, 1.0, "d"), (2, 7.0, 2.0, 10.0, "e"), (3, 1.0, 0.0, 0.0, "g"), (7, 1.0, 1.0, 1.0, ""),
    ]


def test_documents_are_made_once(spark):
    """However often the steps read them, and whether their items are known or found by a walk."""
    made = spark.sparkContext.accumulator(0)

    def counted(row):
        made.add(1)
        return row

    rows = [(1, '{"pages":[{"textItems":[{"text":"a","x":1,"y":2}]}]}'), (2, '[{"text":" b","x":3,"y":4},{"text":"no place"}]'), (3, "{cut")]
    got = tabular.coordinate_items(spark.createDataFrame(spark.sparkContext.parallelize(rows, 1).map(counted), "doc long, json string")).collect()
    assert sorted(tuple(r) for r in got) == [(1, 1.0, 2.0, 1.0, "a"), (2, 1.0, 4.0, 3.0, "b")] and made.value == 3


def test_walks_are_written_once_in_many_levels(spark, monkeypatch):
    """What each level held was written before the next; deeper documents go on from what is written, with the page that the objects around name."""
    written = []
    for module in (nested, tabular):
        monkeypatch.setattr(module, "materialize", lambda df, keep=module.materialize: written.append(1) or keep(df))
    item = lambda n, page="": f'{{"text":"t{n}","x":{n},"y":1{page}}}'
    usual = [(1, f'{{"page":4,"a":{{"b":[[{{"c":[{item(1)},{item(1)}]}}]]}}}}'), (2, f'{{"pages":[{{"textItems":[{item(1)},{item(1)}]}}],"rest":{item(2)}}}')]
    read = lambda rows: sorted(tuple(r) for r in tabular.coordinate_items(spark.createDataFrame(rows, "doc long, json string")).collect())
    assert read(usual) == [(1, 4.0, 1.0, 1.0, "t1"), (2, 1.0, 1.0, 1.0, "t1"), (2, 1.0, 1.0, 1.0, "t1")] and len(written) == 1
    deep = item(0)
    for n in range(1, 13):
        deep = item(n, f',"in":[{deep}]' + (f',"page":{n}' if n in (5, 12) else ""))
    assert read([(3, deep), *usual[1:]]) == [usual_item := (2, 1.0, 1.0, 1.0, "t1"), usual_item, *((3, 5.0, 1.0, float(n), f"t{n}") for n in range(6)), *((3, 12.0, 1.0, float(n), f"t{n}") for n in range(6, 13))]
    assert len(written) == 1 + -(-27 // tabular.LEVELS)


def test_what_is_a_number(spark):
    """Strings that only some parsers take for numbers have none; neither has what a double can't hold."""
    values = {'" +.5 "': 0.5, '"5."': 5.0, '"1e2"': 100.0, "true": 1.0, "null": 0.0, '" "': 0.0, "false": 0.0, "123456789012345678901234567890123456789012345": 123456789012345678901234567890123456789012345.0}
    values |= dict.fromkeys(('"1d"', '"NaN"', '"Infinity"', '"true"', '"false"', "1e999", '"1e999"', "[1]", '{"x":1}', '"1 2"'))
    rows = [(i, f'{{"value":"v","y":{v},"left":1}}') for i, v in enumerate(values)] + [(100 + i, f'{{"pages":[{{"page":{v},"textItems":[{{"text":"k","top":{v},"x":"2"}}]}}]}}') for i, v in enumerate(values)]
    got = {r.doc: (r.page, r.top) for r in tabular.coordinate_items(spark.createDataFrame(rows, "doc long, json string")).collect()}
    # a JSON null isn't a place of its own, but where the last of the names has it, it is 0
    numbers = [None if v == "null" else n for v, n in values.items()]
    assert [got.get(i, (1.0, None)) for i in range(len(values))] == [(1.0, n) for n in numbers]
    assert [got.get(100 + i) for i in range(len(values))] == [None if n is None else (n or 1.0, n) for n in values.values()]


def test_walks_keep_their_order_and_go_as_deep_as_there_is(spark):
    deep = '{"n":' * 30 + '{"end":1}' + "}" * 30
    df = spark.createDataFrame([(1, deep), (2, '[{"b":1},[{"c":2}],3]')], "doc long, j string").select("doc", nested.parsed(F.col("j")).alias("v"))
    found = nested.objects(df, "v", ["doc"])
    assert found.where("doc = 1").count() == 31
    assert [list(r.fields) for r in found.where("doc = 2").orderBy("place").collect()] == [["b"], ["c"]]
    assert nested.objects(df.where("doc > 9"), "v", ["doc"]).count() == 0


ANSWERS = [
    ('```JSON\n[{"id":1},]\n```', "array", "1"), ('{"rows":[1,2],"id":3}', "array", "-,-"), ('so: {"id":4, } ok', "object", "4"), ('[{"id":5,"t":{"u":{}}},{"id":6},{"i', "partial", "5,6"),
    ('[{"id":7,"s":"}"},{"id":8},', None, None), ('[{"id":9},{bad},{"id":10}, cut', "partial", "9,10"), ('[{"id":11,"s":"' + "xy" * 600 + '"},{"id":12},{"i', "partial", "11,12"), ('[{"id":14},{"i', "object", "14"),
    ('[} {"id":13} {"id":1}', None, None), ('[} {"id":13} {', "object", "13"), ("none", None, None), (None, None, None), ("", None, None), ('{"a":1} {"b":2}', None, None),
]


def test_recovered_answers(spark):
    df = spark.createDataFrame([(i, a) for i, (a, _, _) in enumerate(ANSWERS)], "id long, answer string")
    got = tabular.recovered(df).select("id", "form", F.array_join(F.transform("rows", lambda r: F.coalesce(F.try_variant_get(r, "$.id", "string"), F.lit("-"))), ",").alias("ids"), "rows")
    rows = {r.id: r for r in got.collect()}
    assert [(rows[i].form, rows[i].ids) for i in range(len(ANSWERS))] == [(f, n) for _, f, n in ANSWERS]
    capped = got.where("id = 6").select(F.try_variant_get(F.col("rows")[0], "$.s", "string")).first()[0]
    assert len(capped) == 501 and capped.endswith("…")


PAGES = {
    "navigation": ('<nav><a href="/jobs/a">A</a></nav><main><a href="/jobs/b"> B <b>c</b></a><!-- <a href="/jobs/x">x</a> --></main>', {"/jobs/b": "B c"}),
    "only navigation": ('<nav><a href="/jobs/a-b"></a></nav>', {"/jobs/a-b": "A B"}),
    "only navigation, blog": ('<nav><a href="/jobs/1">1</a><a href="/jobs/2">2</a><a href="/jobs/3">3</a><i class="wp-content"></i></nav>', {"/jobs/1": "1", "/jobs/2": "2", "/jobs/3": "3"}),
    "only navigation, many": ('<nav><a href="/jobs/1">1</a><a href="/jobs/2">2</a><a href="/jobs/3">3</a></nav>', {}),
    "clusters": ('<section><a href="/openings/alone">1</a></section><ul><li><a href="/openings/p">P</a><li><a href="/openings/q">Q</a></ul><a href="/openings/out">o</a>', {"/openings/p": "P", "/openings/q": "Q"}),
    "main": ('<div role="main"><a href="/jobs/m">M</a></div><ul><a href="/jobs/n">N</a></ul><ol><a href="/jobs/o">O</a></ol>', {"/jobs/m": "M"}),
    "cards": (
        '<html data-wf-domain="x"><nav><a href="/jobs/n">n</a><div class="w-dyn-item"><a href="/jobs/c">C</a></div></nav><div class="z w-dyn-list"><a href="/lead-engineer">L</a><a href="/about-us">a</a>'
        '<a href="/careers#op">S</a><a href="/team/x-y">t</a></div><a href="/lead-nurse">outside</a>',
        {"/jobs/c": "C", "/lead-engineer": "L", "/careers#op": "S"},
    ),
    "denied": ('<main><a href="/jobs/privacy.html">p</a><a href="/careers/">i</a><a href="mailto:a@jobs.x">m</a><a href="/jobs/long">' + "t" * 130 + "</a></main>", {"/jobs/long": "t" * 117 + "..."}),
    "unclosed": ('<nav><a href="/jobs/a">A</a><main><p><a href="/jobs/b">B<a href="/jobs/c">C', {}),
    "empty": ("", {}),
}


def test_listings_by_region(spark):
    df = spark.createDataFrame([(i, "https://x.org/c/", html) for i, (html, _) in enumerate(PAGES.values())] + [(99, None, None)], "page_id long, url string, html string")
    got = {}
    for r in markup.listings(df).collect():
        got.setdefault(r.page_id, {})[r.url.removeprefix("https://x.org")] = r.title
    for i, (name, (_, expected)) in enumerate(PAGES.items()):
        assert (name, got.get(i, {})) == (name, expected)


def test_profiles(spark):
    pages = [
        ("a", 1, 1, "https://a.org/about", '<p>short</p><header><nav><a href="/careers">Work</a></nav></header><footer><nav><a href="x">Join us</a></nav></footer>'),
        ("a", 2, 2, "https://a.org/about-us", f'<p>{"w " * 50}<p>next</p><meta name="description" content=" "><a href="/careers">later</a><a href="/jobs/1"></a><nav><a href="/hiring">H</a></nav>'),
        ("a", 3, 3, "https://a.org/", '<meta content="M" name=description>' + "text " * 50), ("b", 4, 1, "https://b.org/", ""), ("b", 5, 2, "https://b.org/x", None),
    ]
    df = spark.createDataFrame(pages, "company string, page_id long, ord long, url string, html string")
    hints = sorted(tuple(r) for r in markup.careers_hints(df).select("url", "text", "location").collect())
    assert hints == [("https://a.org/careers", "Work", "header"), ("https://a.org/hiring", "H", "nav"), ("https://a.org/jobs/1", "/jobs/1", "body"), ("https://a.org/x", "Join us", "footer")]
    assert sorted(tuple(r) for r in markup.descriptions(df).collect()) == [("a", ("w " * 50).strip(), False), ("b", None, True)]


def test_builders(spark):
    html = (
        '<a href="https://boards.greenhouse.io/x/jobs/1">One</a><script>{"a":[{"absolute_url":"https://boards.greenhouse.io/x/jobs/1","title":"no"},{"absolute_url":"https://boards.greenhouse.io/x/jobs/2-two"}]}</script>'
        '<script>{"absolute_url":"https://boards.greenhouse.io/x/jobs/3"} trailing</script><script type="application/ld+json">{"@type":"JobPosting","potentialAction":[{"target":"/jobs/ld"}],"title":"LD"}</script>'
    )
    df = spark.createDataFrame([(1, "https://x.org/", html), (2, "https://x.org/", "<p>no board</p>"), (3, None, None)], "page_id long, url string, html string")
    got = sorted((r.page_id, r.url, r.title) for r in builders.listings(df, "greenhouse").collect())
    assert got == [(1, "https://boards.greenhouse.io/x/jobs/1", "One"), (1, "https://boards.greenhouse.io/x/jobs/2-two", "2 Two"), (1, "https://x.org/jobs/ld", "LD")]
    assert builders.listings(df, "lever").count() == 0 and builders.listings(df, "wix").count() == 0


@pytest.mark.parametrize(
    "url, system, slug",
    [
        ("https://jobs.lever.co/postings/beta/1", "lever", "beta"), ("https://jobs.lever.co/postings", "lever", "postings"), ("https://www.lever.co/", "lever", None), ("https://acme.lever.co", "lever", "acme"),
        ("https://boards.greenhouse.io/a/jobs/1", "greenhouse", "a"), ("https://own.greenhouse.io/a", "greenhouse", "own"), ("https://greenhouse.io/a", "greenhouse", None), ("https://boards.greenhouse.io", "greenhouse", "boards"),
        ("https://jobs.ashbyhq.com/x/y?organizationHostedJobsPageName=Z%20z", "ashby", "Z z"), ("https://jobs.ashbyhq.com/x/y", "ashby", "y"), ("https://o.ashbyhq.com", "ashby", "o"),
        ("https://t.wd1.myworkdayjobs.com/en/J", "workday", "en"), ("https://t.wd1.myworkdayjobs.com/en/J", "workday_base", "https://t.wd1.myworkdayjobs.com"), ("https://apply.workable.com/w/j", "workable", "w"),
        ("https://r.recruitee.com/o/1", "recruitee", "r"), ("https://recruitee.com/o", "recruitee", None), ("https://t.teamtailor.com/", "teamtailor", "t"), ("http://b.bamboohr.com/x", "bamboohr", "b"), ("nothing", "lever", None),
    ],
)
def test_system_slugs(spark, url, system, slug):
    assert spark.range(1).select(urls.system_slugs(F.lit(url))[system]).first()[0] == slug


def test_workday_addresses_are_seen_from_the_careers_page(spark):
    body = '{"jobPostings":[{"title":"T","externalPath":"/job/1","bulletFields":["a","b"],"description":"c"},{"jobTitle":"U","description":"d"}]}'
    df = spark.createDataFrame([(1, None, "x", body, "https://w.example.com/en/jobs?x"), (2, None, "x", body, None)], "company_id long, platform string, slug string, body string, base string")
    got = {(r.company_id, r.title): (r.url, r.description) for r in providers.listings(df).collect()}
    assert got == {(1, "T"): ("https://w.example.com/job/1", "a\nb"), (1, "U"): (None, "d"), (2, "T"): (None, "a\nb"), (2, "U"): (None, "d")}


def test_rows_of_cells_stream_by(spark):
    cells = [(p, float(t), float(i), "c") for p in ("a", "b", "c") for i, t in enumerate((1, 3, 3.5, 4, 9, 30))]
    got = tabular.group_rows(spark.createDataFrame(cells, "page string, top double, left double, text string").repartition(3)).collect()
    assert {p: sorted((r.top, r.row) for r in got if r.page == p) for p in ("a", "b", "c")} == dict.fromkeys(("a", "b", "c"), [(1, 1), (3, 1), (3.5, 1), (4, 2), (9, 3), (30, 4)])


def test_cells_lie_on_pages_of_several_keys(spark):
    """Pages are told apart by all keys, and rows that lie together already aren't dealt again."""
    cells = spark.createDataFrame([(d, p, float(t), 0.0, "c") for d in (1, 2) for p in (1.0, 2.0) for t in (1, 9, 10)], "doc long, page double, top double, left double, text string").repartition("doc")
    got = tabular.group_rows(cells, keys=("doc", "page"))
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert sorted((r.doc, r.page, r.top, r.row) for r in got.collect()) == [(d, p, t, n) for d in (1, 2) for p in (1.0, 2.0) for t, n in ((1.0, 1), (9.0, 2), (10.0, 2))]


def test_titles_of_links(spark):
    get = lambda u: spark.range(1).select(text.title_of_link(F.lit(u))).first()[0]
    assert get("https://x.org/a/senior_data-engineer.html?x") == "Senior Data Engineer" and get("https://x.org/") is None and get("https://x.org/vp-R&d") == "Vp R&D"

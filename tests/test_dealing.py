"""Tasks grow in number, not in size, with the rows of a table that is one small file."""

from tidemark.operators import categorize
from tidemark.operators.tabular import recovered
from tidemark.plans import entity_plans, markup_plans, more_plans
from tidemark.sources import shared


def test_rows_are_dealt_by_their_number(spark, tmp_path):
    spark.range(1000).coalesce(1).write.parquet(f"{tmp_path}/one")
    got = shared.dealt(spark.read.parquet(f"{tmp_path}/one"), "id", 100)
    assert got.rdd.getNumPartitions() == 10 and got.count() == 1000
    assert shared.tasks_for(spark, 0, 100) == spark.sparkContext.defaultParallelism


def test_a_taxonomy_of_any_size_gives_the_same_shortlist(spark, monkeypatch):
    companies = spark.createDataFrame([(1, "sun wind"), (2, "none"), (3, None)], "id long, text string")
    categories = spark.createDataFrame([("S", 0), ("W", 1)], "category string, ord long")
    tokens = spark.createDataFrame([("S", "sun"), ("W", "wind"), ("W", "wind")], "category string, token string")
    found = []
    for few in (categorize.FEW, 0):
        monkeypatch.setattr(categorize, "FEW", few)
        found.append(sorted(tuple(r) for r in categorize.shortlist(companies, categories, tokens).select("id", "category", "score", "rn").collect()))
    assert found[0] == found[1] == [(1, "S", 1, 2), (1, "W", 2, 1), (2, "S", 0, 1), (2, "W", 0, 2), (3, "S", 0, 1), (3, "W", 0, 2)]


def test_keywords_are_dealt_by_the_lines(spark, monkeypatch):
    monkeypatch.setattr(entity_plans, "tasks_for", lambda session, rows, size: 5 if size == 500_000 and rows > 5000 else 0)
    got = entity_plans._company_keywords(spark, "/root/testdata/sf0.001")
    assert got.rdd.getNumPartitions() == 5


def test_answers_are_made_by_many_tasks(spark, monkeypatch):
    """The heavy work begins after the deal, so the table's one file isn't one task."""
    seen = []
    monkeypatch.setattr(more_plans.tabular, "recovered", lambda df: seen.append(df.rdd.getNumPartitions()) or recovered(df))
    monkeypatch.setattr(more_plans, "dealt", lambda df, key, size: shared.dealt(df, key, 10))
    assert more_plans.recovered_answers(spark, "/root/testdata/sf0.001").count() == 150 and seen == [15]


def test_pages_are_cut_by_many_tasks(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").count()
    wanted = shared.tasks_for(spark, pages, 500)
    plan = markup_plans._tailed(spark, "/root/testdata/sf0.001")
    assert plan.rdd.getNumPartitions() == wanted and "RepartitionByExpression" in plan._jdf.queryExecution().logical().toString()

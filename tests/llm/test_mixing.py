from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tests.llm import data
from tidemark.llm import mixing
from tidemark.sources.shared import in_blocks


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, target = float(sum(sizes.values())), {}
    open_ = set(names)
    while True:
        left = total - sum(3 * sizes[s] for s in names if s not in open_)
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_} if open_ else {}
        over = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not over:
            target.update(share)
            target.update({s: 3.0 * sizes[s] for s in names if s not in open_})
            return target
        open_ -= over


def test_plan_follows_targets(spark):
    rows = [data.row(i, data.prose(5 + i % 60, i), f"s{(i * i) % 5}") for i in range(400)] + [data.row(900, None, None), data.row(901, "w " * 9, None)]
    out = mixing.plan(data.frame(spark, rows)).collect()
    assert len(out) == len(rows)
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len((r[1] or "").split())
    target = brute_targets(dict(sizes))
    taken, largest = Counter(), Counter()
    for r in out:
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - target[r["source"]]) < 1e-6
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 3
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 3 * largest[s]
    again = mixing.plan(data.frame(spark, rows, 5)).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))


def test_edges_and_repeats(spark):
    docs = data.frame(spark)
    out = mixing.plan(docs)
    assert out.count() == docs.count() and out.where("size = 0 and taken <> 0").count() == 0
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == out.agg(F.sum("copies")).first()[0]
    assert mixing.plan(data.empty(spark)).count() == 0 and mixing.mix(data.empty(spark)).count() == 0


def test_mix_repeats_rows_as_planned(spark):
    rows = [data.row(i, data.prose(5 + i % 40, i), f"s{i % 4}") for i in range(120)] + [data.row(500 + i % 3, "a b c", "s0") for i in range(9)]
    rows += [data.row(None, "x y z " * (i % 3), "s1") for i in range(12)]
    docs = data.frame(spark, rows)
    planned, mixed = Counter(), Counter()
    for r in mixing.plan(docs).collect():
        planned[r["doc_id"], r["source"], r["size"]] += r["copies"]
    for r in mixing.mix(docs).collect():
        mixed[r["doc_id"], r["source"], len((r["text"] or "").split())] += 1
    assert mixed == +planned
    texts = {(r[0], r[1], r[3]) for r in rows}
    assert all((r["doc_id"], r["text"], r["source"]) in texts for r in mixing.mix(docs).collect())


def test_tied_rows_and_null_ids_are_cut_into_blocks(spark):
    rows = spark.range(30_000).select(F.when(F.col("id") % 2 == 0, F.lit(None).cast("long")).otherwise(F.lit(5)).alias("doc_id"), F.lit("one text").alias("text"), F.lit("s").alias("source"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small blocks stay apart
    sizes = [r["count"] for r in in_blocks(rows.repartition(4), ["source", "doc_id"]).groupBy("block").count().collect()]
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 30_000 and max(sizes) < 15_000
    few = rows.limit(600)
    assert few.count() == mixing.mix(few).count()
    taken = mixing.plan(few).agg(F.sum("copies"), F.count("*")).first()
    assert tuple(taken) == (600, 600)

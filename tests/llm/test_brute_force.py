"""Operators and the pipeline against plain versions of themselves."""

from collections import Counter, defaultdict

import numpy as np
import public_tokenizers

from tests.llm import brute, data
from tests.llm.test_classifiers import labelled
from tidemark.llm import packing, quality, toxicity


def test_all_maximal_segments():
    for seed in range(80):
        r = np.random.RandomState(seed)
        s = r.normal(-0.2, 1, r.randint(0, 40))
        got, want = toxicity.segments(s), brute.maximal_segments(s)
        assert [g[:2] for g in got] == [w[:2] for w in want] and np.allclose([g[2] for g in got], [w[2] for w in want])


def test_toxicity_and_quality_scores(spark):
    rows, marks = labelled(160)
    short = [r for r in data.edge_rows() if len(r[1] or "") < 3000]
    docs, labels = data.frame(spark, rows + short), data.labels(spark, marks)
    tox, good = toxicity.fit(docs, labels), quality.fit(docs, labels)
    assert tox["nodes"] and good.pairs
    for r in toxicity.score(docs, tox).collect():
        assert abs(r["toxicity"]["score"] - brute.toxicity_score(r["text"], tox)) < 1e-9
    for r in quality.score(docs, good).collect():
        assert abs(r["quality_score"] - brute.quality_score(r["text"], good)) < 1e-9


def test_pipeline(spark, tmp_path):
    import corpus_pipeline as c

    marked, marks = labelled(140)
    rows = [(*r[:3], f"s{r[0] % 3}", *r[4:]) for r in marked]
    rows += [data.row(200 + i, data.edited(rows[7 * i + 2][1], i, 0.01), "s1") for i in range(12)]
    rows += [data.row(300, None), data.row(301, ""), data.row(302, data.prose(300, 77), None), data.row(303, data.prose(9000, 78), "s0")]
    spark.createDataFrame(rows, data.SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    data.labels(spark, marks).write.parquet(f"{tmp_path}/labels.parquet")
    docs, labels = (spark.read.parquet(f"{tmp_path}/{t}.parquet") for t in ("documents", "labels"))
    got = Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in c.run(spark, str(tmp_path)).collect())

    tox = toxicity.fit(docs, labels)
    kept = [r for r in rows if r[0] == 303 or brute.toxicity_score(r[1], tox) < 0.3]  # 303 is long and clean
    good = quality.fit(spark.createDataFrame(kept, data.SCHEMA), labels)
    kept = [r for r in kept if brute.quality_score(r[1], good) >= 0.5]
    classes = brute.near_classes([(r[0], r[1]) for r in kept])
    kept = [r for r in kept if classes[r[0]] == r[0]]
    assert 60 < len(kept) < len(rows) - 20
    vocabulary, want = public_tokenizers.path("byte_bpe_50k.json"), Counter()
    for r, n in zip(kept, brute.mix_copies([(r[0], r[1], r[3]) for r in kept])):
        for p in brute.pieces(r[1], vocabulary):
            want[(r[0], *p)] += n
    assert got == +want


def test_pipeline_of_an_empty_table(spark, tmp_path):
    import corpus_pipeline as c

    data.empty(spark).write.parquet(f"{tmp_path}/documents.parquet")
    data.labels(spark, []).write.parquet(f"{tmp_path}/labels.parquet")
    assert c.run(spark, str(tmp_path)).count() == 0


def test_both_encoders_agree(spark):
    import random

    encode = packing.Encoder(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    r = random.Random(6)
    letters = [chr(c) for c in [*range(0, 0x250), *range(0x2010, 0x2028)]]
    texts = ["".join(r.choice(letters) for _ in range(r.randint(0, 60))) for _ in range(1500)]
    texts += [" " * n + "a" + "\n" * n + "b" + "\t " * n for n in range(12)] + ["don't we'LL I'm 12345 1,000.5", "a\r\nb\r\n\r\n c", "\xa0\x85x y"]
    texts += [row["text"] or "" for row in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    fast = 0
    for t in texts:
        fast += encode.plain.fullmatch(t) is not None
        assert encode(t).tolist() == encode.slow.encode(t, add_special_tokens=False).ids
    assert fast > 1500


def test_columns_that_clash_are_replaced_and_others_pass(spark):
    from pyspark.sql import functions as F

    from tidemark.llm import line_labels

    rows, marks = labelled(60)
    docs, labels = data.frame(spark, rows), data.labels(spark, marks)
    tox, good, lines = toxicity.fit(docs, labels), quality.fit(docs, labels), line_labels.fit(docs, labels)
    for run, name in ((lambda d: toxicity.score(d, tox), "toxicity"), (lambda d: quality.score(d, good), "quality_score"), (lambda d: line_labels.annotate(d, lines), "rules")):
        out = run(docs.withColumn(name, F.lit("before")))
        assert out.columns.count(name) == 1 and set(docs.columns) < set(out.columns) and out.where(F.col(name).cast("string") == "before").count() == 0
    odd = docs.withColumnRenamed("text", "body").withColumn("toxicity", F.lit(1)).withColumn("quality_score", F.lit(2))
    assert toxicity.clean_only(odd, tox, text_col="body").columns == odd.columns and quality.good_only(odd, good, text_col="body").columns == odd.columns


def test_sequences_of_the_pack_are_gapless(spark):
    rows = [data.row(i, data.prose(30 + 37 * i % 900, i)) for i in range(120)]
    fill = defaultdict(list)
    for r in packing.pack(data.frame(spark, rows), vocabulary=public_tokenizers.path("byte_bpe_50k.json")).collect():
        fill[r["sequence_id"]].append((r["offset"], r["length"]))
    for placed in fill.values():
        ends = [0, *(o + n for o, n in sorted(placed))]
        assert [o for o, _ in sorted(placed)] == ends[:-1] and ends[-1] <= 2048

import hashlib
import zlib

from pyspark.sql import functions as F

from tests.llm import data
from tidemark.llm import media


def test_round_trip(spark):
    shared = data.prose(2000, 21)
    rows = data.edge_rows() + [data.row(60 + i, data.prose(300, 30 + i) + "\n" + shared + data.prose(200, 40 + i)) for i in range(6)]
    docs = data.frame(spark, rows)
    stored = media.store(docs)
    kinds = {r["kind"]: r["n"] for r in stored.groupBy("kind").agg(F.count("*").alias("n")).collect()}
    assert kinds["chunk"] > 0 and kinds["mixed"] > 0 and kinds["copy"] > 0
    out = media.read(stored).collect()
    want = []
    for r in rows:
        raw = (r[1] or "").encode()
        payload = raw + b"\0" * (-len(raw) % 64 if raw else 64)
        file = media.encode(payload)
        want.append((r[0], len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(file), hashlib.sha256(file).hexdigest(), media.describe(payload)))
    key = lambda t: (t[0] is None, *t)
    assert sorted(map(tuple, out), key=str) == sorted(want, key=str)
    shuffled = media.media(docs, broadcast_rows=0).collect()
    assert sorted(map(str, shuffled)) == sorted(str(r).replace("Row(id", "Row(doc_id") for r in out)
    assert media.media(data.empty(spark)).count() == 0


def test_cuts_follow_content():
    a, b = data.prose(4000, 1).encode(), data.prose(700, 2).encode()
    first, second = set(map(media.digest, media.chunks(a))), set(map(media.digest, media.chunks(b + a)))
    assert len(first & second) > len(first) / 2
    for x in (a, b, b"\0" * 64, b"z" * 50_000):
        parts = media.chunks(x)
        assert b"".join(parts) == x and all(len(p) <= media.MOST for p in parts)


def test_equal_rows_store_their_chunks_once(spark):
    shared = data.prose(900, 5)
    rows = [data.row(7, shared)] * 300 + [data.row(None, shared)] * 200 + [data.row(None, "")] * 400 + [data.row(8, data.prose(50, 9))]
    docs = data.frame(spark, rows)
    stored = media.store(docs)
    digests = {media.digest(c) for t in (shared, "") for c in media.chunks(media.payload_of(t))}
    kinds = {r["kind"]: r["n"] for r in stored.groupBy("kind").agg(F.count("*").alias("n")).collect()}
    assert kinds == {"chunk": len(digests), "mixed": 2, "copy": 900, "local": 1}
    out = media.read(stored)
    assert out.count() == 901 and out.select("payload_sha256").distinct().count() == 3


def test_a_changed_chunk_is_found(spark):
    import pytest

    stored = media.store(data.frame(spark, [data.row(1, data.prose(80, 1)), data.row(2, data.prose(80, 2))]))
    swapped = stored.withColumn("header", F.lit(media.encode(b"\1" * 64)[:44]))
    with pytest.raises(Exception, match="differs from its digest"):
        media.read(swapped).collect()


def test_hot_join_is_a_join(spark):
    from tidemark.llm.common import hot_join

    left = spark.range(3000).select(F.when(F.col("id") < 1500, 0).otherwise(F.col("id") % 900).alias("k"), "id")
    right = left.groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("top")).where("k % 3 = 0")
    for parts in (10, 1000):
        got = hot_join(left, right, "k", times="n", total=3000, parts=parts)
        assert got.columns == ["k", "id", "top"]
        assert got.exceptAll(left.join(right.drop("n"), "k")).count() == 0 and got.count() == left.join(right, "k").count()

import numpy as np

from tests.llm import data
from tidemark.llm import language


def whole(model, text):
    """The network over a whole text at once: the mean of the labels of its bytes."""
    x, n = language.padded([text])
    return model.label(x, n)[:, 0].mean(0)


def test_windows_keep_every_byte_once():
    for n in (1, 31, 32, 33, 224, 255, 256, 257, 470, 480, 481, 5000):
        kept = [i for a, b, lo, hi in language.windows(b"x" * n) for i in range(a + lo, a + hi)]
        assert kept == list(range(n)), n
        assert all(b - a <= language.WINDOW for a, b, *_ in language.windows(b"x" * n))


def test_windows_give_what_the_network_gives_over_whole_texts():
    model = language.Recurrent(["a", "b", "c"], seed=9)
    texts = [data.prose(n, n).encode() for n in (1, 2, 40, 300, 2000)] + ["é ß 日本".encode(), b"\x00\xff" * 400]
    model.train([t[:64] for t in texts], np.arange(len(texts)) % 3)
    got = model.pooled(texts)
    for p, t in zip(got, texts):
        if len(t) <= language.WINDOW:  # one window: the same sums
            assert np.allclose(p, whole(model, t), atol=1e-5)
        assert np.abs(p - whole(model, t)).max() < 0.01  # CONTEXT bytes settle the states
        assert p.argmax() == whole(model, t).argmax()


def test_stretches_are_spread_and_bounded():
    text = bytes(range(256)) * 40
    got = language.stretches(text, 64, 8)
    assert len(got) == 8 and got[0] == text[:64] and got[-1] == text[-64:] and all(len(g) == 64 for g in got)
    assert language.stretches(b"abc", 64, 8) == [b"abc"] and language.stretches(b"", 64, 8) == []


def test_texts_without_letters_are_und(spark):
    model = language.Recurrent(["a", "b"])
    rows = [data.row(1, "½ ² ③ 12 --"), data.row(2, "ª"), data.row(3, "日"), data.row(4, "½ x"), data.row(5, "\n_!\t")]
    got = {r["doc_id"]: r["language"] for r in language.identify(data.frame(spark, rows), model).collect()}
    assert [got[i]["lang"] == "und" for i in range(1, 6)] == [True, False, False, False, True]
    assert got[1]["score"] == 0
    assert language.identify(data.empty(spark), model).count() == 0


def test_identify_matches_brute_force(spark):
    model = language.Recurrent(["a", "b"], seed=2)
    rows = [r for r in data.edge_rows() if len(r[1] or "") <= 256] + [data.row(77, data.prose(30, 3))]
    got = sorted((str(r["text"]), r["language"]["lang"], round(r["language"]["score"], 4)) for r in language.identify(data.frame(spark, rows), model).collect())
    want = []
    for r in rows:
        p = whole(model, r[1].encode()) if language.has_letter(r[1]) else None
        want.append((str(r[1]), "und" if p is None else model.labels[int(p.argmax())], 0.0 if p is None else round(float(p.max()), 4)))
    assert [g[:2] for g in got] == [w[:2] for w in sorted(want)]
    assert all(abs(g[2] - w[2]) < 1e-3 for g, w in zip(got, sorted(want)))


def test_a_clashing_column_is_replaced(spark):
    docs = data.frame(spark).withColumn("language", data_col())
    out = language.identify(docs, language.Recurrent(["a"]))
    assert out.columns.count("language") == 1 and out.select("language.lang").count() == docs.count()


def data_col():
    from pyspark.sql import functions as F

    return F.lit("before")

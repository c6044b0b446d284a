import random
import zlib

import numpy as np

from tests.llm import data
from tidemark.llm import language, line_labels, quality, toxicity

BAD = ("zgrolf", "zgrolt", "zgromm", "vilbek", "vilbok")


def labelled(n=240):
    r = random.Random(0)
    rows, marks = [], []
    for i in range(n):
        text, toxic, good = data.prose(r.randint(60, 200), i), int(i % 5 == 0), int(i % 4 != 1)
        if toxic:
            words = text.split(" ")
            for _ in range(6):
                words.insert(r.randint(0, len(words)), r.choice(BAD) + r.choice("aeiou"))
            text = " ".join(words)
        if not good:
            text = " ".join(w + r.choice(("***", "$$$", "%%%")) for w in text.split(" "))
        rows.append(data.row(i, text))
        marks.append((i, good, toxic))
    return rows, marks


def test_toxicity_on_held_out(spark):
    rows, marks = labelled()
    docs = data.frame(spark, rows)
    model = toxicity.fit(docs, data.labels(spark, marks))
    got = {r["doc_id"]: r["toxicity"] for r in toxicity.score(docs, model).collect()}
    out = [i for i, *_ in marks if zlib.crc32(str(i).encode()) % 4 == 2]
    assert len(out) > 30 and np.mean([(got[i]["score"] >= 0.3) == marks[i][2] for i in out]) > 0.95
    hit = next(i for i in out if marks[i][2] and got[i]["passages"])
    assert any(any(b in rows[hit][1][p["start"] : p["end"]] for b in BAD) for p in got[hit]["passages"])
    kept = toxicity.clean_only(docs, model)
    assert kept.columns == docs.columns and kept.count() < docs.count()


def test_toxicity_of_a_phrase_that_documents_repeat(spark):
    phrase = "balanda kopersh zgrolf vilbek zgromm risitck tuvorm"
    with_it = lambda text: text.replace("\n", "\n" + phrase + "\n", 1)
    rows = [data.row(i, with_it(data.prose(80, i)) if i % 4 == 0 else data.prose(80, i)) for i in range(400)]
    marks = [(i, 1, int(i % 4 == 0)) for i in range(400)]
    docs = data.frame(spark, rows)
    model = toxicity.fit(docs, data.labels(spark, marks))
    got = {r["doc_id"]: r["toxicity"]["score"] >= 0.3 for r in toxicity.score(docs, model).collect()}
    out = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(got[i] == (i % 4 == 0) for i in out) and sum(i % 4 == 0 for i in out) > 10


def test_toxicity_counts_copies_once_and_documents_each(spark):
    phrase = "balanda kopersh zgrolf vilbek zgromm risitck tuvorm"
    texts = [(data.prose(80, i) + " " + phrase, int(i >= 3)) for i in range(20)]
    base = data.prose(300, 99) + " zcopied"
    texts += [(base, 1)] * 10 + [(base.replace(" ", "  ", i) + " end", 1) for i in range(10)] + [(base, 0)] * 5
    rows = spark.createDataFrame([(i, t, y) for i, (t, y) in enumerate(texts)], "doc_id long, text string, label int")
    counts = {r["node"]: (r["n0"] + r["n1"], r["tox0"] + r["tox1"]) for r in toxicity.node_counts(toxicity.without_copies(rows, "doc_id")).collect()}
    assert counts["=vilbek"] == (20, 17) and "=zcopied" not in counts  # one document a label


def test_segments_match_brute_force():
    for seed in range(60):
        r = np.random.RandomState(seed)
        s = np.round(r.normal(-0.3, 1, r.randint(1, 30)), 3)
        found = toxicity.segments(s)
        total = max(s[i:j].sum() for i in range(len(s)) for j in range(i + 1, len(s) + 1))
        if total > 0:
            assert abs(max(v for *_, v in found) - total) < 1e-9
        last = 0
        for i, j, v in found:
            assert i >= last and abs(s[i:j].sum() - v) < 1e-9 and v > 0
            last = j
        assert {int(i) for i in np.flatnonzero(s > 0)} <= {k for i, j, _ in found for k in range(i, j)}


def test_quality_on_held_out(spark):
    rows, marks = labelled()
    docs = data.frame(spark, rows)
    model = quality.fit(docs, data.labels(spark, marks))
    got = {r["doc_id"]: r["quality_score"] for r in quality.score(docs, model).collect()}
    out = [i for i, *_ in marks if zlib.crc32(str(i).encode()) % 3 == 1]
    assert np.mean([(got[i] >= 0.5) == marks[i][1] for i in out]) > 0.95
    kept = quality.good_only(docs, model)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()


def test_pairs_learn_an_interaction():
    r = np.random.RandomState(0)
    x = r.uniform(-1, 1, (3000, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    model = quality.train(x, y)
    assert ((model(x) > 0.5) == y).mean() > 0.9


def test_language_learns_and_says_und(spark):
    r = random.Random(1)
    make = lambda syllables, n: " ".join("".join(r.choice(syllables) for _ in range(3)) for _ in range(n))
    kinds = {"aa": ("ba", "lo", "mi"), "bb": ("sch", "öx", "ung"), "cc": ("ñe", "rr", "ció")}
    rows = [data.row(i, make(kinds[k], 30), lang=k) for i in range(120) for k in [list(kinds)[i % 3]]]
    extra = [data.row(500, None), data.row(501, "", lang=None), data.row(502, "12 34 --", lang=None), data.row(None, "balomi " * 50_000, lang=None)]
    docs = data.frame(spark, rows + extra)
    got = {r["doc_id"]: r["language"] for r in language.identify(docs, language.fit(docs)).collect()}
    assert all(got[r[0]]["lang"] == r[2] for r in rows if zlib.crc32(str(r[0]).encode()) % 4 == 2)
    assert all(got[i]["lang"] == "und" and got[i]["score"] == 0 for i in (500, 501, 502)) and got[None]["lang"] == "aa"
    assert language.fit(data.empty(spark)) is None
    assert language.identify(docs, None).where("language.lang <> 'und'").count() == 0


def test_a_rare_language_is_learned_and_a_repeated_id_counts_once(spark):
    rows = [data.row(i, f"balomi lobami {i}", lang="aa") for i in range(600)] + [data.row(7, f"mibalo {i}", lang="aa") for i in range(300)]
    rows += [data.row(i, "", lang="zz") for i in range(1000, 1200)] + [data.row(i, "schung öxsch ungöx", lang="zz") for i in (2000, 2001, 2004)]
    docs = data.frame(spark, rows)
    options = {"lang_col": "lang", "id_col": "doc_id", "text_col": "text", "modulus": 4, "held_out": 2, "max_rows": 400}
    got = language.learnable(docs, **options).collect()
    assert len({(r["id"], r["lang"]) for r in got}) == len(got) <= 400 and sum(r["lang"] == "aa" for r in got) == 200
    assert {r["id"] for r in got if r["lang"] == "zz"} == {i for i in (2000, 2001, 2004) if zlib.crc32(str(i).encode()) % 4 != 2}
    assert language.fit(docs, max_rows=4).labels == ["aa", "zz"]


def test_gradients_of_the_network():
    model = language.Recurrent(["a", "b", "c"])
    for k in model.p:
        model.p[k] = model.p[k].astype("f8")
    group, y = [b" hello", b" abcdefgh", b" x", b" zz\xff1"], np.array([0, 1, 2, 1])
    x, n = language.padded(group)

    def loss():
        p = model.label(x, n)
        return -sum(np.log(p[t, i, y[i]]) for i in range(4) for t in range(n[i])) / n.sum()

    grad = model._gradient(x, n, y)
    for k, g in grad.items():
        for at in map(tuple, np.argwhere(np.abs(g) > 1e-3)[:3]):
            keep = model.p[k][at]
            model.p[k][at] = keep + 1e-3
            up = loss()
            model.p[k][at] = keep - 1e-3
            down = loss()
            model.p[k][at] = keep
            assert abs((up - down) / 2e-3 - g[at]) < 1e-3


def test_line_labels(spark):
    rows, marks = labelled()
    docs = data.frame(spark, rows + data.edge_rows()[5:])
    model = line_labels.fit(docs, data.labels(spark, marks))
    out = [(r["doc_id"], r["text"], r["rules"]) for r in line_labels.annotate(docs, model).collect()]
    for i, text, r in out:
        words = (text or "").split()
        windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
        twice = {k + j for k, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)} if len(words) < 3000 else None
        lines = [x for x in (text or "").split("\n") if x.split()]
        assert r["n_words"] == len(words) and r["word_chars"] == sum(map(len, words)) and r["n_dup_lines"] == len(lines) - len(set(lines))
        assert r["n_symbols"] == sum((text or "").count(c) for c in "#*$%&|<>") and len(r["labels"]) == len(lines)
        if twice is not None:
            assert r["n_repeat_words"] == len(twice)
            assert r["base_failed"] == (len(words) < 50 or 100 * len(twice) > 50 * len(words))
        assert not (r["base_failed"] and r["kept"])
    good = [(r["kept"], marks[i][1]) for i, _, r in out if i is not None and i >= 20 and i < 240 and not r["base_failed"]]
    assert np.mean([k == g for k, g in good]) > 0.95


def test_viterbi_and_gradient_match_enumeration():
    r = np.random.RandomState(3)
    model = line_labels.LineModel()
    model.move = r.normal(0, 1, (2, 2))
    f = len(line_labels.LINE_FEATURES)
    x = (r.rand(5, f) > 0.5).astype(float)
    paths = [[(k >> t) & 1 for t in range(5)] for k in range(32)]
    value = lambda p: sum((x[t] @ model.emit)[p[t]] for t in range(5)) + sum(model.move[a, b] for a, b in zip(p, p[1:]))
    assert model.decode(x).tolist() == max(paths, key=value)
    y = np.array(paths[11])
    weight = np.exp([value(p) for p in paths])
    weight /= weight.sum()
    move = np.zeros((2, 2))
    for p, w in zip(paths, weight):
        for a, b in zip(p, p[1:]):
            move[a, b] -= w
    for a, b in zip(y, y[1:]):
        move[a, b] += 1
    assert np.allclose(model._gradient(x[None], y[None], np.ones((1, 5), bool))[1], move)


def test_edges_of_the_classifiers(spark):
    docs, none = data.frame(spark), data.labels(spark, [])
    tox, good = toxicity.fit(docs, none), quality.fit(docs, none)
    assert toxicity.score(docs, tox).select("toxicity.score").distinct().count() == 1
    assert quality.score(docs, good).count() == docs.count()
    assert line_labels.annotate(docs, line_labels.fit(docs, none)).count() == docs.count()
    void = data.empty(spark)
    assert toxicity.score(void, tox).count() == 0 and quality.score(void, good).count() == 0 and toxicity.clean_only(void, tox).count() == 0
    assert toxicity.held_out("doc_id") is not None and docs.where(quality.held_out("doc_id").isNull()).count() == 0


def test_line_labels_and_verdict_match_brute_force(spark):
    import itertools

    r = random.Random(8)
    kinds = ("{w}.", "{w} | {w} | {w}", "$$ {w} %%", "WIN {w}!!! !!! !!!", "{w} {w} {w} {w}")
    texts = ["\n".join(r.choice(kinds).format(w=data.prose(r.randint(4, 25), 40 * i + k)) for k in range(r.randint(1, 5))) for i in range(60)]
    model = line_labels.LineModel()
    model.emit += np.random.RandomState(1).normal(0, 0.3, model.emit.shape)
    rows = [data.row(i, t) for i, t in enumerate(texts)]
    for got in line_labels.annotate(data.frame(spark, rows), model).collect():
        lines = [x for x in got["text"].split("\n") if x.split()]
        x = line_labels.document_features(line_labels.split_lines(got["text"])) @ model.emit
        if len(lines) <= 12:
            value = lambda p: sum(x[t, k] for t, k in enumerate(p)) + sum(model.move[a, b] for a, b in zip(p, p[1:]))
            assert tuple(got["rules"]["labels"]) == max(itertools.product((0, 1), repeat=len(lines)), key=value)
        sizes = [len(line.split()) for line in lines]
        content = sum(n for n, k in zip(sizes, got["rules"]["labels"]) if k == 0)
        assert abs(got["rules"]["content_share"] - content / sum(sizes)) < 1e-12
        assert got["rules"]["kept"] == (not got["rules"]["base_failed"] and 2 * content >= sum(sizes))


def test_latent_line_labels_keep_half_of_the_document_label():
    r = np.random.RandomState(0)
    bad_line = np.zeros(len(line_labels.LINE_FEATURES))
    bad_line[[0, line_labels.LINE_FEATURES.index("pipes")]] = 1
    good_line = np.zeros_like(bad_line)
    good_line[[0, line_labels.LINE_FEATURES.index("ends_stop")]] = 1
    make = lambda share, n: np.array([bad_line if r.rand() < share else good_line for _ in range(n)])
    model = line_labels.train([(make(0.0, 12), 0) for _ in range(60)] + [(make(0.7, 12), 1) for _ in range(40)] + [(np.zeros((0, len(bad_line))), 1)])
    assert not model.decode(np.array([good_line] * 8)).any() and model.decode(np.array([bad_line] * 8)).all()
    y = line_labels._latent(make(0.0, 9), 1, model)
    assert y.sum() == 5  # of a bad document, half of the lines at least stay bad


def test_a_long_labelled_text_is_learned_from(spark):
    long = "\n".join("a | b | c | d" for _ in range(5000))
    rows = [data.row(0, long), data.row(1, data.prose(400, 1)), data.row(3, data.prose(300, 2))]
    model = line_labels.fit(data.frame(spark, rows), data.labels(spark, [(0, 0, 0), (1, 1, 0), (3, 1, 0)]))
    pipes = line_labels.LINE_FEATURES.index("pipes")
    assert model.emit[pipes, 1] > model.emit[pipes, 0]

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

from tests.llm.data import empty, frame, row
from tidemark.llm import variants


def plain(rows, least=6, min_count=5, ratio=5):
    counts = Counter()
    for doc, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= least and n >= min_count}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    around, form, out = defaultdict(list), {}, []
    for a in words:
        around[a] = [b for b in words if near(a, b)]
        best = min(around[a], key=lambda b: (-words[b], b), default=None)
        if best and words[best] >= ratio * words[a]:
            form[a] = best
    for w in words:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, words[w], len(around[w]), words.get(form.get(w))))
    return sorted(out, key=lambda r: r[0])


def result(df, **options):
    return sorted((tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in variants.variants(df, **options).collect()), key=lambda r: r[0])


def corpus():
    r, rows = random.Random(4), []
    bases = ["straße", "colour", "bookkeeper", "élèves", "ÀÉÎÕÜ" + "ab", "mississippi", "aaaaaaa"]
    for doc in range(60):
        text = []
        for base in bases:
            text += [base.upper() if r.random() < 0.3 else base] * r.choice([1, 3])
            w = list(base)
            i = r.randrange(len(w))
            text.append("".join(r.choice([w[:i] + w[i + 1 :], w[:i] + ["x"] + w[i:], w[:i] + ["ÿ"] + w[i + 1 :]])))
        rows.append(row(doc, " ".join(text) + " short ab"))
    # a chain: each form has five times as many
    chain = [("chainaaaa", 5), ("chainaaab", 25), ("chainaabb", 125), ("chainabbb", 625)]
    rows += [row(100 + i, " ".join([w] * n)) for i, (w, n) in enumerate(chain)]
    rows += [row(None, "nullid " * 9), row(None, None), row(120, ""), row(121, "x" * 3000 + " " + "x" * 2999), row(5, "colour")]
    return rows + [row(121, "x" * 3000 + " " + "x" * 2999)] * 5


def test_equals_brute_force(spark):
    rows = corpus()
    expected = plain(rows)
    assert sum(r[1] is not None for r in expected) > 10 and any(r[2] == "chainabbb" and r[1] == "chainaaab" for r in expected)
    assert result(frame(spark, rows)) == expected


def test_rounds_of_small_filters_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(variants, "PART", 7)
    rows = corpus()
    assert len(variants.rounds({6: (20, 3), 7: (5, 1)}, 20)) > 2
    assert result(frame(spark, rows), max_filter_bytes=40) == plain(rows)


def test_ties_take_the_smallest_form(spark):
    rows = [row(1, "abcdefg " * 5 + "abcdefx " * 25 + "abcdefé " * 25)]
    got = {r[0]: r for r in result(frame(spark, rows))}
    assert got["abcdefg"][1] == "abcdefx" and got["abcdefg"][4] == 2


def test_no_rows(spark):
    assert result(empty(spark)) == []


def test_filters_hold_all_words():
    words = [f"word{i:05}" for i in range(2000)]
    h = variants.word_hash(words)
    blocks = np.zeros(len(words) * variants.BITS_PER_WORD // 64, np.uint64)
    np.bitwise_or.at(blocks, variants.block_of(h, len(blocks)).astype(int), variants.bits_of(h))
    ask = lambda h: (blocks[variants.block_of(h, len(blocks)).astype(int)] & variants.bits_of(h)) == variants.bits_of(h)
    others = variants.word_hash([f"none{i:06}" for i in range(20_000)])
    assert ask(h).all() and ask(others).mean() < 0.02

import bisect
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tests.llm import data
from tidemark.llm import packing

VOCABULARY, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def best_fit_decreasing(lengths, capacity):
    gaps, bins = [], 0
    for n in sorted(lengths, reverse=True):
        i = bisect.bisect_left(gaps, n)
        bins += i == len(gaps)
        room = (capacity if i == len(gaps) else gaps.pop(i)) - n
        if room:
            bisect.insort(gaps, room)
    return bins


def test_runs_are_best_fit_decreasing():
    for seed in range(60):
        r = random.Random(seed)
        capacity = r.choice([10, 30, 2048])
        lengths = [r.randint(1, capacity if r.random() < 0.7 else max(1, capacity // 5)) for _ in range(r.randint(0, 300))]
        fill = defaultdict(list)
        for x in packing.place_runs(Counter(lengths), capacity).itertuples():
            for k in range(x.n):
                fill[x.sequence + k // x.per].append((x.offset + k % x.per * x.length, x.length))
        assert len(fill) == best_fit_decreasing(lengths, capacity)
        for placed in fill.values():
            at = 0
            for offset, length in sorted(placed):
                assert offset == at
                at += length
            assert at <= capacity


def test_pack_whole_texts(spark):
    special = [data.row(50, "a <|endoftext|> b"), data.row(51, "日本語 текст"), data.row(52, "x" * 9000)]
    docs = data.frame(spark, data.edge_rows() + special)
    out = packing.pack(docs, vocabulary=VOCABULARY, ranks=RANKS).collect()
    tokenizer, want = Tokenizer.from_file(VOCABULARY), Counter()
    for r in data.edge_rows() + special:
        ids = np.array([*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 0], "<u4")
        first = len(ids) % 2048 or 2048
        for n, start in enumerate([0, *range(first, len(ids), 2048)]):
            part = ids[start : first if n == 0 else start + 2048]
            want[r[0], n, start, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out) == want
    fill = defaultdict(list)
    for r in out:
        fill[r["sequence_id"]].append((r["offset"], r["length"]))
    for placed in fill.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(fill) == best_fit_decreasing([k[3] for k in want.elements()], 2048)
    assert packing.pack(data.empty(spark), vocabulary=VOCABULARY).count() == 0

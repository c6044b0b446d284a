"""Plain versions of the operators, one document after the other."""

import hashlib
import math
import zlib
from collections import defaultdict

import numpy as np
from tokenizers import Tokenizer

from tests.llm.test_mixing import brute_targets
from tidemark.llm import near_dedup, quality, toxicity


def maximal_segments(s):
    """The best stretch, then the same on both sides of it, while its sum is above zero."""
    best = max(((s[i:j].sum(), -(j - i), i, j) for i in range(len(s)) for j in range(i + 1, len(s) + 1)), default=(0, 0, 0, 0))
    if best[0] <= 0:
        return []
    _, _, i, j = best
    right = [(a + j, b + j, v) for a, b, v in maximal_segments(s[j:])]
    return maximal_segments(s[:i]) + [(i, j, float(best[0]))] + right


def toxicity_score(text, model):
    tokens = (text or "").split()
    scores = []
    for t in tokens:
        word = t.lower().strip("".join({c for c in t.lower() if not (c.isalnum() or c == "_")}))
        nodes = ["=" + word] + ["^" + word[:n] for n in range(9, 2, -1) if len(word) > n] if any(map(str.isalpha, word)) else []
        scores.append(next((model["nodes"][n] for n in nodes if n in model["nodes"]), 0.0) - toxicity.DRIFT)
    room = math.log(max(model["k"] * len(scores), 1.0))
    bits = sum(max(0.0, model["lam"] * v - room) for *_, v in maximal_segments(np.array(scores)))
    return 1 / (1 + math.exp(-(model["a"] + model["b"] * math.log1p(bits))))


def quality_score(text, model):
    x, total = quality.features(text), model.base
    at = [sum(edge <= v for edge in edges) for v, edges in zip(x, model.edges)]
    total += sum(table[i] for table, i in zip(model.tables, at))
    total += sum(table[model.coarse[i][at[i]], model.coarse[j][at[j]]] for (i, j), table in model.pairs.items())
    return 1 / (1 + math.exp(-max(-30, min(30, total))))


def near_classes(rows, threshold=0.8):
    """Class of each (id, text), ids being different."""
    df = np.zeros(near_dedup.SLOTS)
    for _, t in rows:
        df[list({near_dedup._slot(w) for w in near_dedup.words_of(t)})] += 1
    cut = near_dedup.Shingles(np.log1p(len(rows) / np.maximum(df, 1)) + 1.0)
    sets, up = [cut(t) for _, t in rows], list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] or "") == (rows[j][1] or "") or near_dedup.weighted_jaccard(sets[i], sets[j]) >= threshold:
                a, b = sorted((root(i), root(j)), key=lambda k: rows[k][0])
                up[b] = a
    return {rows[i][0]: rows[root(i)][0] for i in range(len(rows))}


def mix_copies(rows):
    """Copies of each (id, text, source) in order of the rows."""
    sizes, by = defaultdict(int), defaultdict(list)
    for n, (i, t, s) in enumerate(rows):
        size = len((t or "").split())
        sizes[s] += size
        by[s].append((size, hashlib.md5(("" if i is None else str(i)).encode()).hexdigest(), i, n))
    targets, copies = brute_targets(dict(sizes)), [0] * len(rows)
    for s, group in by.items():
        rate = targets[s] / sizes[s] if sizes[s] else 0.0
        u = int(hashlib.md5(("mix|" + (s or "")).encode()).hexdigest()[:8], 16) / 4294967296.0
        for k, (*_, n) in enumerate(sorted(group), 1):
            copies[n] = math.floor(k * rate + u) - math.floor((k - 1) * rate + u)
    return copies


def pieces(text, vocabulary, capacity=2048):
    ids = np.array([*Tokenizer.from_file(vocabulary).encode(text or "", add_special_tokens=False).ids, 0], "<u4")
    first = len(ids) % capacity or capacity
    for n, start in enumerate([0, *range(first, len(ids), capacity)]):
        part = ids[start : first if n == 0 else start + capacity]
        yield n, start, len(part), zlib.crc32(part.tobytes())

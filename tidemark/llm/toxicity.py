"""Toxic passages by maximum-scoring segment search.

Every token has a log-odds score of toxic against clean, smoothed by a hierarchy of Dirichlet
priors: the prior of a word is the posterior of its nine-letter prefix, whose prior is that of its
eight-letter prefix, and so on up to the base rate; so an unseen word takes the score of the longest
prefix that the labelled rows know. A linear-time scan (all maximal scoring subsequences) finds
every passage whose tokens score above the drift. The best scores follow an extreme-value law on
clean text: a passage of score S in a text of m tokens has bits lambda * S - ln(K * m). The bits of
a document's passages are added up, and a logistic curve, fitted on rows that the scoring tokens
weren't counted from, turns the sum into a probability.

Token counts come from a bounded sample of labelled rows (``max_rows``), in which copies and near
copies of a document are one document, whatever their label; counting and scoring run in Spark tasks,
the driver gets token counts of the sample and one number pair per sampled row.

Defined results: null and empty texts have no passages and score as any text without evidence; with
no labelled rows of one of the classes the score is the base rate; repeated rows score alike; a column that
is called as ``out`` is replaced, all others pass through; very long texts are read whole, one at a time; an empty
table gives no rows, and a fit on one scores by the base rate.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, crc_mod, training_rows

_word = re.compile(WORD)
_edge = re.compile(r"^\W+|\W+$")
PREFIXES = (3, 4, 5, 6, 7, 8, 9)
#: Strength of a prior in documents, cost of a token, documents that a node needs.
ALPHA, DRIFT, LEAST = 4.0, 0.5, 3
_DRAWS = np.random.RandomState(7).randint(1, 1 << 62, 64).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def core(token: str) -> str:
    """The token in lower case without marks at its ends; empty without letters."""
    word = _edge.sub("", token.lower())
    return word if any(map(str.isalpha, word)) else ""


def chain(token: str) -> list[str]:
    """The nodes of a token from the coarsest prefix to the word; empty for a token without letters."""
    word = core(token)
    return ["^" + word[:n] for n in PREFIXES if len(word) > n] + ["=" + word] if word else []


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring subsequences, as (start, end, score), in linear time; only tokens above
    zero are visited, the sums between them come from one running total."""
    total = np.concatenate([[0.0], np.cumsum(scores)])
    stack: list[tuple[int, int, float, float, int]] = []  # start, end, left sum, right sum, next one with a smaller left
    for i in np.flatnonzero(scores > 0).tolist():
        start, end, left, right = i, i + 1, float(total[i]), float(total[i + 1])
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= left:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= right:
                stack.append((start, end, left, right, j))
                break
            start, left = stack[j][0], stack[j][2]
            del stack[j:]
    return [(s, e, r - l) for s, e, l, r, _ in stack]


class TokenScores:
    """Log-odds by token; remembers a bounded number of tokens."""

    def __init__(self, nodes: dict[str, float]):
        self.nodes, self.seen = nodes, {}

    def __call__(self, tokens: list[str]) -> np.ndarray:
        seen = self.seen
        if len(seen) > 500_000:
            seen.clear()
        for t in set(tokens).difference(seen):
            seen[t] = next((s for n in reversed(chain(t)) if (s := self.nodes.get(n)) is not None), 0.0) - DRIFT
        return np.fromiter(map(seen.__getitem__, tokens), float, len(tokens))


def posterior(counts: dict[str, tuple[float, float, float, float]], base: float) -> dict[str, float]:
    """Log-odds against the base rate of the nodes that differ from their parent, from (n, t, words, rates) by node: its own evidence (a word's are
    documents, n of which t are toxic), and how many different words there are under it with the sum of their toxic shares.

    A node's prior is its parent's posterior without the node's own words. Nodes whose count agrees with
    that prior keep it and get no entry of their own; to differ, the likelihood ratio must be one that chance
    wouldn't give among so many nodes."""
    sure = max(12.0, 2 * math.log(max(1, len(counts))))
    prior: dict[str, float] = {"": base}
    kept: dict[str, float] = {}

    def parent(node: str) -> str:
        longer = [n for n in PREFIXES if n < len(node) - 1]
        return "^" + node[1 : longer[-1] + 1] if longer else ""

    def prior_of(node: str) -> float:
        if node not in prior:
            up = parent(node)
            none = (0.0, 0.0, 0.0, 0.0)
            words, rates = counts.get(node, none)[2:]
            words_up, rates_up = counts.get(up, none)[2:]
            others = max(words_up - words, 0.0)
            prior[node] = (min(max(rates_up - rates, 0.0), others) + ALPHA * prior_of(up)) / (others + ALPHA)
        return prior[node]

    logit = lambda p: math.log(p / (1 - p))
    for node, (n, t, *_) in counts.items():
        p = min(max(prior_of(node), 1e-6), 1 - 1e-6)
        if n < LEAST:
            continue
        ratio = sum(2 * x * math.log(x / e) for x, e in ((t, n * p), (n - t, n * (1 - p))) if x > 0)
        if ratio >= sure:
            kept[node] = logit((t + ALPHA * p) / (n + ALPHA)) - logit(base)
    return kept


def signature(text: str, shingle: int = 5) -> np.ndarray:
    """The least hashes of the text's word shingles: two texts agree in the share of them that their Jaccard similarity is."""
    words = text.split()
    grams = {" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))}
    h = np.fromiter((xxhash.xxh64_intdigest(g) for g in grams), np.uint64, len(grams))
    return np.array([((h ^ (h >> np.uint64(29))) * m >> np.uint64(16)).min() for m in _DRAWS]).astype(np.uint32)


def copies(signatures: np.ndarray, threshold: float = 0.15) -> np.ndarray:
    """The class of each text: texts that are alike, or joined by texts that are, have one class."""
    found, left, number = np.zeros(len(signatures), np.int64), np.arange(len(signatures)), 0
    while len(left):
        number, stack, left = number + 1, [left[0]], left[1:]
        while stack:
            i = stack.pop()
            found[i] = number
            alike = (signatures[left] == signatures[i]).mean(1) >= threshold
            stack.extend(left[alike])
            left = left[~alike]
    return found


def without_copies(rows: DataFrame, id_col: str) -> DataFrame:
    """Rows (text, label, fold, class_id) of persisted (id, text, label) rows: copies and near copies of a document
    are of one class, whatever their labels, and a class is whole in one fold."""

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"key": pdf["key"], "found": [signature(t).tobytes() for t in pdf["text"]]})

    keyed = rows.select(F.xxhash64(id_col).alias("key"), "text", "label")
    signed = sorted(keyed.mapInPandas(sign, "key long, found binary").collect())
    number = copies(np.array([np.frombuffer(r.found, np.uint32) for r in signed]).reshape(len(signed), len(_DRAWS)))
    named = [(r.key, int(c), signed[first].key) for r, c, first in zip(signed, number, np.unique(number, return_index=True)[1][number - 1])]
    classes = rows.sparkSession.createDataFrame([(k, c, zlib.crc32(f"fold{f}".encode()) % 2) for k, c, f in named], "key long, class_id long, fold int")
    # one row for each of the sampled rows
    return keyed.join(F.broadcast(classes), "key").select("text", "label", "fold", "class_id")


def node_counts(rows: DataFrame) -> DataFrame:
    """Documents by node, fold and label of (text, label, fold, class_id) rows.

    A node counts once for a class of copies and a label, however many of its words a document has and whatever words are around them: so what
    different documents repeat counts for each of them, and what one document and its copies have counts once. The classes come to tasks
    as a whole and in order; a task adds up what it has seen before anything is shuffled."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of: dict[str, list[str]] = {}
        total: dict[str, list[int]] = {}
        group, nodes = None, set()

        def add() -> None:
            for node in nodes:
                c = total.setdefault(node, [0, 0, 0, 0])
                c[2 * group[2]] += 1
                c[2 * group[2] + 1] += group[1]

        for pdf in batches:
            for text, label, fold, class_id in zip(pdf["text"], pdf["label"], pdf["fold"], pdf["class_id"]):
                if group != (class_id, label, fold):
                    add()
                    group, nodes = (class_id, label, fold), set()
                for t in set(_word.findall(text)):
                    if t not in of:
                        of[t] = chain(t)
                    nodes.update(of[t])
            if len(total) > 1_000_000:
                yield counted(total)
                total.clear()
        add()
        yield counted(total)

    def counted(total: dict[str, list[int]]) -> pd.DataFrame:
        counts = np.array(list(total.values()), np.int64).reshape(len(total), 4)
        return pd.DataFrame({"node": pd.Series(list(total), dtype=object), **{c: counts[:, i] for i, c in enumerate(columns)}})

    columns = ("n0", "tox0", "n1", "tox1")
    whole = rows.repartition("class_id").sortWithinPartitions("class_id", "label")
    counts = whole.mapInPandas(count, "node string, " + ", ".join(f"{c} long" for c in columns)).groupBy("node").agg(*(F.sum(c).alias(c) for c in columns))
    counts = counts.withColumn("n2", F.col("n0") + F.col("n1")).withColumn("tox2", F.col("tox0") + F.col("tox1"))
    kinds = (0, 1, 2)  # the folds and both
    share = lambda f: F.when(F.col(f"n{f}") > 0, F.col(f"tox{f}") / F.col(f"n{f}")).otherwise(0.0)
    seen = lambda f: (F.col(f"n{f}") > 0).cast("double")
    words = counts.where(F.col("node").startswith("="))
    prefixes = F.array_compact(F.array(*(F.when(F.length("node") - 1 > n, F.concat(F.lit("^"), F.substring("node", 2, n))) for n in PREFIXES)))
    under = words.select(F.explode(prefixes).alias("node"), *(e(f).alias(f"{c}{f}") for f in kinds for c, e in (("words", seen), ("rates", share))))
    under = under.groupBy("node").agg(*(F.sum(f"{c}{f}").alias(f"{c}{f}") for f in kinds for c in ("words", "rates")))
    own = words.select("node", *(c.cast("double").alias(f"{k}{f}") for f in kinds for k, c in (("n", F.col(f"n{f}")), ("tox", F.col(f"tox{f}")), ("words", seen(f)), ("rates", share(f)))))
    # what a prefix says of a word that no one has seen, it says by its different words, not by how often one of them is there
    n = lambda f: F.least(F.col(f"n{f}").cast("double"), F.col(f"words{f}"))
    rate = lambda f: F.when(F.col(f"words{f}") > 0, F.col(f"rates{f}") / F.col(f"words{f}")).otherwise(0.0)
    above = counts.join(under, "node")
    above = above.select("node", *(c.alias(f"{k}{f}") for f in kinds for k, c in (("n", n(f)), ("tox", n(f) * rate(f)), ("words", F.col(f"words{f}")), ("rates", F.col(f"rates{f}")))))
    return own.unionByName(above).where(f"n2 >= {LEAST} and tox2 > 0")


def _evidence(found: list[tuple[int, int, float]], m: int, lam: float, k: float) -> float:
    room = math.log(max(k * m, 1.0))
    return sum(max(0.0, lam * s - room) for _, _, s in found)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    label_col: str = "toxic",
    id_col: str = "doc_id",
    modulus: int = 4,
    held_out: int = 2,
    max_rows: int = 6000,
) -> dict:
    """Fit on at most ``max_rows`` labelled rows whose crc32(id) mod ``modulus`` isn't ``held_out``."""
    sample = training_rows(
        docs, labels, label_col, id_col=id_col, modulus=modulus, held_out=held_out, max_rows=max_rows
    ).persist()
    rows = sample
    try:
        rows = without_copies(sample, id_col).persist()
        distinct = rows.select("class_id", "label").distinct()
        sizes = {r.label: r.n for r in distinct.groupBy("label").agg(F.count("*").alias("n")).collect()}
        n, tox = sum(sizes.values()), sum(v for y, v in sizes.items() if y == 1)
        base = (tox + 0.5) / (n + 1)
        if tox == 0 or tox == n:
            return {"nodes": {}, "lam": 1.0, "k": 1.0, "a": math.log(base / (1 - base)), "b": 0.0}
        counted = node_counts(rows).collect()  # of the sample, which is bounded
        by_fold = [{r.node: tuple(r[f"{c}{f}"] for c in ("n", "tox", "words", "rates")) for r in counted} for f in (0, 1, 2)]
        nodes = posterior(by_fold[2], base)
        halves = [posterior(by_fold[1 - f], base) for f in (0, 1)]  # a fold is scored by the other's counts

        def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            by = [TokenScores(h) for h in halves]
            for pdf in batches:
                out = []
                for text, label, fold in zip(pdf["text"], pdf["label"], pdf["fold"]):
                    s = by[fold](_word.findall(text))
                    up = s[s > 0]
                    out.append((label, len(s), up.tolist(), [x[2] for x in segments(s)]))
                yield pd.DataFrame(out, columns=["label", "m", "up", "found"])

        seen = rows.mapInPandas(score, "label int, m long, up array<double>, found array<double>").collect()
    finally:
        rows.unpersist()
        sample.unpersist()
    clean = [r for r in seen if r.label == 0 and r.m]
    tokens = sum(r.m for r in clean) or 1
    # lambda solves p(up) * E[e^(lambda s) | up] + p(down) * e^(-lambda * DRIFT) = 1; one token above zero is assumed at least
    up = [s for r in clean for s in r.up] or [max((s for r in seen for s in r.up), default=1.0)]
    p = min(0.5, len(up) / tokens)
    lo, hi = 1e-3, 5.0
    for _ in range(60):
        mid = (lo + hi) / 2
        total = p * float(np.mean(np.exp(np.minimum(mid * np.array(up), 300.0)))) + (1 - p) * math.exp(-mid * DRIFT)
        lo, hi = (mid, hi) if total < 1 else (lo, mid)
    lam = lo
    k = float(np.clip(np.median([math.exp(min(lam * max(r.found, default=0.0), 50.0)) / r.m for r in clean]), 1e-4, 1.0)) if clean else 1.0
    x = np.log1p([_evidence([(0, 0, s) for s in r.found], r.m, lam, k) for r in seen])
    a, b = _logistic(x, np.array([r.label for r in seen], float))
    return {"nodes": nodes, "lam": lam, "k": k, "a": a, "b": b}


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Ridge-penalised one-feature logistic regression by Newton's method."""
    w, X = np.zeros(2), np.stack([np.ones_like(x), x], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-X @ w))
        g = X.T @ (p - y) + 0.01 * w
        h = (X * (p * (1 - p))[:, None]).T @ X + 0.01 * np.eye(2)
        w = w - np.clip(np.linalg.solve(h, g), -2, 2)
    return float(w[0]), float(max(w[1], 0.0))


def score(docs: DataFrame, model: dict, *, text_col: str = "text", out: str = "toxicity") -> DataFrame:
    """docs with a struct column ``out``: score, and passages (start and end in code points, bits)."""

    @F.pandas_udf("score double, passages array<struct<start:int,end:int,bits:double>>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tokens = TokenScores(model["nodes"])
        lam, k, a, b = (model[x] for x in ("lam", "k", "a", "b"))
        for texts in batches:
            scores, found = [], []
            for text in texts:
                words = _word.findall(text or "")
                s = tokens(words)
                hits = segments(s) if len(s) and s.max() > 0 else []
                room = math.log(max(k * len(s), 1.0))
                hits = [h for h in hits if lam * h[2] > room]
                scores.append(1 / (1 + math.exp(-(a + b * math.log1p(_evidence(hits, len(s), lam, k))))))
                if hits:
                    at = [m.span() for m in _word.finditer(text)]
                    hits = [{"start": at[i][0], "end": at[j - 1][1], "bits": lam * v - room} for i, j, v in hits]
                found.append(hits)
            yield pd.DataFrame({"score": scores, "passages": found})

    return docs.withColumn(out, run(F.col(text_col)))


def clean_only(docs: DataFrame, model: dict, *, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """The documents that score below the threshold, with their columns."""
    rows = docs.select(F.struct("*").alias("row"), F.col(text_col).alias("text"))
    return score(rows, model).where(F.col("toxicity.score") < threshold).select("row.*")


def held_out(id_col: str, modulus: int = 4, fold: int = 2):
    return F.coalesce(crc_mod(id_col, modulus) == fold, F.lit(False))

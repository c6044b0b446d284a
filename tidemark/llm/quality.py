"""Quality classifier: a generalised additive model with pairwise interactions.

Each text gives a few numbers (ratios of symbols, repeats, lines, letters). Per feature a lookup
table over quantile bins is learned by cyclic boosting: in turn each feature fits a tree of few
leaves to the current residuals and adds a small step of it to its table. Then the pairs of
features whose joint residuals are the largest get two-dimensional tables in the same way. A score
is the sum of one table entry per feature and pair, so scoring is a few vectorised additions.

The features are computed in Spark tasks; the driver gets the numbers of at most ``max_rows``
labelled rows, never texts.

Defined results: null and empty texts have all-zero features and score by them; without labelled
rows of both classes every score is the base rate; repeated rows score alike; a column that is
called as ``out`` is replaced, all others pass through; very long texts are read whole, one at a time; an empty table
gives no rows, and a fit on one scores by the base rate.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, crc_mod, training_rows

_word = re.compile(WORD)
_symbols, _letters, _upper, _digits = (
    re.compile(x) for x in (r"[#*$%&|<>@~^_={}\[\]\\/+]", r"[^\W\d_]", r"[A-ZÀ-ÖØ-Þ]", r"\d")
)
_stops = re.compile(r"[.,;:!?]")
FEATURES = (
    "log_words", "word_length", "symbols", "symbol_words", "stops", "bangs", "pipes", "upper", "digits", "letters",
    "same_next", "distinct", "repeat_lines", "line_words", "short_lines", "longest_word", "links", "top_word", "repeat_pairs",
)


def features(text: str | None) -> list[float]:
    text = text or ""
    words = _word.findall(text)
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    chars = len(text)
    lines = [x for x in text.split("\n") if x and not x.isspace()]
    counts: dict[str, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    pairs = set(zip(words, words[1:]))
    return [
        float(np.log1p(n)),
        sum(map(len, words)) / n,
        len(_symbols.findall(text)) / chars,
        sum(map(counts.__getitem__, filter(_symbols.search, counts))) / n,
        len(_stops.findall(text)) / n,
        text.count("!") / n,
        text.count("|") / n,
        len(_upper.findall(text)) / chars,
        len(_digits.findall(text)) / chars,
        len(_letters.findall(text)) / chars,
        sum(map(str.__eq__, words, words[1:])) / n,
        len(counts) / n,
        1 - len(set(lines)) / len(lines),
        n / len(lines),
        sum(len(x) < 25 for x in lines) / len(lines),
        float(max(map(len, counts))),
        (text.count("http") + text.count("www.")) / n,
        max(counts.values()) / n,
        1 - len(pairs) / max(1, n - 1),
    ]


def _tree(grad: np.ndarray, hess: np.ndarray, leaves: int, ridge: float) -> np.ndarray:
    """A piecewise constant step over ordered bins: the best splits, one after the other."""
    n = len(grad)
    g, h = np.concatenate([[0], np.cumsum(grad)]), np.concatenate([[0], np.cumsum(hess)])
    cuts = [0, n]
    for _ in range(leaves - 1):
        best = (1e-9, -1)
        for lo, hi in zip(cuts, cuts[1:]):
            if hi - lo < 2:
                continue
            m = np.arange(lo + 1, hi)
            gl, hl, gr, hr = g[m] - g[lo], h[m] - h[lo], g[hi] - g[m], h[hi] - h[m]
            gain = gl**2 / (hl + ridge) + gr**2 / (hr + ridge) - (g[hi] - g[lo]) ** 2 / (h[hi] - h[lo] + ridge)
            i = int(np.argmax(gain))
            best = max(best, (float(gain[i]), lo + 1 + i))
        if best[1] < 0:
            break
        cuts = sorted([*cuts, best[1]])
    out = np.zeros(n)
    for lo, hi in zip(cuts, cuts[1:]):
        out[lo:hi] = (g[hi] - g[lo]) / (h[hi] - h[lo] + ridge)
    return out


def _pair_tree(grad: np.ndarray, hess: np.ndarray, ridge: float) -> np.ndarray:
    """A tree of depth two over a grid: the row cut whose two sides gain most by a column cut each."""
    best, out = -1.0, np.zeros_like(grad)
    for cut in range(1, len(grad)):
        step = np.zeros_like(grad)
        for part in (slice(None, cut), slice(cut, None)):
            step[part] = _tree(grad[part].sum(0), hess[part].sum(0), 2, ridge)
        if (gain := float((step * grad).sum())) > best:
            best, out = gain, step
    return out


class Additive:
    """Bin edges, one table per feature, and tables per pair; ``__call__`` gives probabilities."""

    def __init__(self, base: float, edges: list[np.ndarray]):
        self.base, self.edges = base, edges
        self.tables = [np.zeros(len(e) + 1) for e in edges]
        self.coarse: list[np.ndarray] = []
        self.pairs: dict[tuple[int, int], np.ndarray] = {}

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], 1)

    def raw(self, b: np.ndarray) -> np.ndarray:
        total = np.full(len(b), self.base)
        for j, t in enumerate(self.tables):
            total += t[b[:, j]]
        for (i, j), t in self.pairs.items():
            total += t[self.coarse[i][b[:, i]], self.coarse[j][b[:, j]]]
        return total

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(self.bins(x)), -30, 30)))


def train(x: np.ndarray, y: np.ndarray, *, rounds: int = 120, rate: float = 0.15, bins: int = 32, pairs: int = 4) -> Additive:
    p = (y.sum() + 0.5) / (len(y) + 1)
    model = Additive(float(np.log(p / (1 - p))), [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T])
    if len(set(y.tolist())) < 2:
        return model
    b = model.bins(x)
    raw, ridge = model.raw(b), 2.0

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        q = 1 / (1 + np.exp(-raw))
        return y - q, q * (1 - q)

    for _ in range(rounds):
        for j, t in enumerate(model.tables):
            g, h = slopes()
            step = rate * _tree(np.bincount(b[:, j], g, len(t)), np.bincount(b[:, j], h, len(t)), 3, ridge)
            t += step
            raw += step[b[:, j]]
    model.coarse = [np.minimum(np.arange(len(t)) * 8 // max(len(t), 1), 7) for t in model.tables]
    c = np.stack([model.coarse[j][b[:, j]] for j in range(b.shape[1])], 1)
    g, h = slopes()

    def cell(i: int, j: int) -> np.ndarray:
        return c[:, i] * 8 + c[:, j]

    def gain(i: int, j: int) -> float:
        k = cell(i, j)
        return float((np.bincount(k, g, 64) ** 2 / (np.bincount(k, h, 64) + ridge)).sum())

    ranked = sorted(((gain(i, j), i, j) for i in range(b.shape[1]) for j in range(i)), reverse=True)[:pairs]
    for _, i, j in ranked:
        model.pairs[i, j] = np.zeros((8, 8))
    for _ in range(rounds // 2):
        for (i, j), t in model.pairs.items():
            g, h = slopes()
            k = cell(i, j)
            gs, hs = np.bincount(k, g, 64).reshape(8, 8), np.bincount(k, h, 64).reshape(8, 8)
            step = _pair_tree(gs, hs, ridge)
            t += rate * step
            raw += rate * step[c[:, i], c[:, j]]
    return model


def _feature_frame(texts: pd.Series) -> np.ndarray:
    return np.array([features(t) for t in texts], float).reshape(-1, len(FEATURES))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    label_col: str = "quality",
    id_col: str = "doc_id",
    modulus: int = 3,
    held_out: int = 1,
    max_rows: int = 6000,
) -> Additive:
    """Fit on at most ``max_rows`` labelled rows whose crc32(id) mod ``modulus`` isn't ``held_out``."""
    rows = training_rows(
        docs, labels, label_col, id_col=id_col, modulus=modulus, held_out=held_out, max_rows=max_rows
    )

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"id": pdf["id"], "label": pdf["label"], "x": list(_feature_frame(pdf["text"]))})

    found = rows.select(F.col(id_col).cast("string").alias("id"), "text", "label").mapInPandas(
        measure, "id string, label int, x array<double>"
    )
    got = sorted(map(tuple, found.collect()))
    x = np.array([r[2] for r in got], float).reshape(-1, len(FEATURES))
    return train(x if len(x) else np.zeros((1, len(FEATURES))), np.array([r[1] for r in got] or [0], float))


def score(docs: DataFrame, model: Additive, *, text_col: str = "text", out: str = "quality_score") -> DataFrame:
    """docs with a column ``out``: the probability of label 1."""

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(model(_feature_frame(texts)))

    return docs.withColumn(out, run(F.col(text_col)))


def good_only(docs: DataFrame, model: Additive, *, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The documents that score at least the threshold, with their columns."""
    rows = docs.select(F.struct("*").alias("row"), F.col(text_col).alias("text"))
    return score(rows, model).where(F.col("quality_score") >= threshold).select("row.*")


def held_out(id_col: str, modulus: int = 3, fold: int = 1):
    return F.coalesce(crc_mod(id_col, modulus) == fold, F.lit(False))

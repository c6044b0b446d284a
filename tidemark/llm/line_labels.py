"""Quality rules with line labels from a linear-chain conditional random field.

The base rules count words, symbols, repeated lines and repeated three-word windows. A document
that passes them goes to the line labeller: every line with a word is described by a few binary
features, a trained linear-chain CRF decodes the best sequence of content and boilerplate (Viterbi),
and the document stays if at least ``keep_share`` of its words stand in content lines.

The CRF is trained in numpy by gradient ascent on the exact conditional likelihood (forward-backward). Nobody
has labelled lines, only documents; so the line labels are latent. To begin with every line has its document's
label (content in good ones, boilerplate in bad ones); then, ``rounds`` times, the model that these labels give decodes the
lines anew, under the constraint that at least half of a document's lines keep the document's label (those for
which the model is surest), and is trained on what it found. No rule over the features names a label.

Bounds of the fit, all parameters: ``max_rows`` labelled documents outside the held-out fold, and of each at most ``stretches``
stretches of ``stretch`` lines, spread over all of it. Without labelled rows of both kinds the model keeps fixed
starting weights. Every text is read whole when lines are labelled.

Defined results: null and empty texts have zero counts and fail the base rules; lines without a
word take no label; repeated rows get the same result; a column that is called as ``out`` is replaced, all others pass
through; very long texts are read whole, one at a time; an empty table gives no rows.
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
_symbol = re.compile(r"[#*$%&|<>]")
CONTENT, BOILERPLATE = 0, 1
LINE_FEATURES = (
    "bias", "first", "last", "seen_before", "one_word", "under_four_words", "over_thirty_words", "symbol", "symbol_tenth",
    "pipes", "bangs", "shouting", "same_next", "half_same_next", "few_distinct", "ends_stop", "digits", "link", "braces",
)


def line_features(line: str, words: list[str], seen: bool, first: bool, last: bool) -> list[float]:
    n = len(words)
    same = sum(map(str.__eq__, words, words[1:]))
    symbols = len(_symbol.findall(line))
    letters = sum(map(str.isalpha, line))
    return [
        1.0, first, last, seen, n == 1, n < 4, n > 30, symbols > 0, symbols * 10 > n, line.count("|") > 1,
        line.count("!") * 3 > n, letters > 3 and sum(map(str.isupper, line)) * 2 > letters, same > 1, same * 2 > n,
        n > 5 and len(set(words)) * 2 < n, line.rstrip()[-1:] in ".!?", sum(map(str.isdigit, line)) * 5 > len(line),
        "http" in line or "www." in line, "{" in line or "}" in line,
    ]


def split_lines(text: str) -> list[tuple[str, list[str], bool]]:
    """(line, words, equal to an earlier line) of every line with a word."""
    seen, out = set(), []
    for line in text.split("\n"):
        if words := _word.findall(line):
            out.append((line, words, line in seen))
            seen.add(line)
    return out


def document_features(lines: list[tuple[str, list[str], bool]]) -> np.ndarray:
    end = len(lines) - 1
    rows = [line_features(x, w, s, i == 0, i == end) for i, (x, w, s) in enumerate(lines)]
    return np.array(rows, float).reshape(-1, len(LINE_FEATURES))


def repeated_words(words: list[str]) -> int:
    """Words that stand in a three-word window found twice or more in the text."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[str, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    pair = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)[1].astype(np.int64)
    _, window, times = np.unique(pair[:-1] * len(number) + ids[2:], return_inverse=True, return_counts=True)
    twice = times[window] > 1
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k : n - 2 + k] |= twice
    return int(covered.sum())


class LineModel:
    """Weights of a two-label linear-chain CRF: fixed ones to be used without labels, or zeros to be trained."""

    def __init__(self, *, zero: bool = False):
        self.emit, self.move = np.zeros((len(LINE_FEATURES), 2)), np.zeros((2, 2))
        if zero:
            return
        for name in ("seen_before", "symbol_tenth", "pipes", "bangs", "shouting", "half_same_next", "few_distinct"):
            self.emit[LINE_FEATURES.index(name), BOILERPLATE] = 2.0
        self.emit[0, CONTENT] = 1.0
        self.move = np.array([[0.5, -0.5], [-0.5, 0.5]])

    def decode(self, x: np.ndarray) -> np.ndarray:
        """Viterbi: the best label of every line."""
        score = x @ self.emit
        if not (len(score) > 1):
            return score.argmax(1)
        (m00, m01), (m10, m11) = self.move.tolist()
        a, b = score[0].tolist()
        back = []
        for e0, e1 in score[1:].tolist():
            from_0, from_1 = (a + m00 < b + m10), (a + m01 < b + m11)
            back.append((from_0, from_1))
            a, b = max(a + m00, b + m10) + e0, max(a + m01, b + m11) + e1
        label = int(b > a)
        out = [label]
        for step in reversed(back):
            label = int(step[label])
            out.append(label)
        return np.array(out[::-1])

    def train(self, sequences: list[tuple[np.ndarray, np.ndarray]], *, rounds: int = 60, rate: float = 0.5, ridge: float = 1e-3):
        """Gradient ascent on the mean log likelihood; sequences of a like length are done together."""
        sequences = sorted((s for s in sequences if len(s[1])), key=lambda s: len(s[1]))
        if not sequences:
            return self
        groups = []
        for i in range(0, len(sequences), 256):
            part = sequences[i : i + 256]
            t = max(len(y) for _, y in part)
            x = np.zeros((len(part), t, len(LINE_FEATURES)))
            y = np.zeros((len(part), t), int)
            on = np.zeros((len(part), t), bool)
            for k, (xs, ys) in enumerate(part):
                x[k, : len(ys)], y[k, : len(ys)], on[k, : len(ys)] = xs, ys, True
            groups.append((x, y, on))
        total = sum(int(on.sum()) for _, _, on in groups)
        speed_e, speed_m = np.zeros_like(self.emit), np.zeros_like(self.move)
        for _ in range(rounds):
            ge, gm = -ridge * self.emit, -ridge * self.move
            for x, y, on in groups:
                e, m = self._gradient(x, y, on)
                ge, gm = ge + e / total, gm + m / total
            speed_e, speed_m = 0.9 * speed_e + ge, 0.9 * speed_m + gm
            self.emit, self.move = self.emit + rate * speed_e, self.move + rate * speed_m
        return self

    def _gradient(self, x: np.ndarray, y: np.ndarray, on: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        score = x @ self.emit
        n, t, _ = score.shape
        fore, aft = np.zeros((n, t, 2)), np.zeros((n, t, 2))
        fore[:, 0] = score[:, 0]
        for i in range(1, t):
            step = np.logaddexp.reduce(fore[:, i - 1, :, None] + self.move, axis=1) + score[:, i]
            fore[:, i] = np.where(on[:, i, None], step, fore[:, i - 1])
        for i in range(t - 2, -1, -1):
            step = np.logaddexp.reduce(self.move + (score[:, i + 1] + aft[:, i + 1])[:, None, :], axis=2)
            aft[:, i] = np.where(on[:, i + 1, None], step, 0.0)
        z = np.logaddexp.reduce(fore[:, -1], axis=1)
        p = np.exp(fore + aft - z[:, None, None]) * on[..., None]
        truth = np.eye(2)[y] * on[..., None]
        emit = np.einsum("ntf,ntk->fk", x, truth - p)
        pair = fore[:, :-1, :, None] + self.move + (score[:, 1:] + aft[:, 1:])[:, :, None, :] - z[:, None, None, None]
        both = on[:, 1:, None, None]
        move = (truth[:, :-1, :, None] * truth[:, 1:, None, :] * both - np.exp(np.minimum(pair, 0.0)) * both).sum((0, 1))
        return emit, move


def _latent(x: np.ndarray, bad: int, model: LineModel) -> np.ndarray:
    """Line labels of a document of a known label: as the model decodes them, but half of the lines at least keep the label."""
    y = model.decode(x)
    need = -(-len(y) // 2) - int((y == bad).sum())
    if need > 0:
        score = x @ model.emit
        surest = np.argsort(-(score[:, bad] - score[:, 1 - bad]), kind="stable")
        y[surest[y[surest] != bad][:need]] = bad
    return y


def train(documents: list[tuple[np.ndarray, int]], *, rounds: int = 2) -> LineModel:
    """Train on (line features, 1 for a bad document) pairs, with latent line labels."""
    model = LineModel()
    documents = [(x, bad) for x, bad in documents if len(x)]
    if len({bad for _, bad in documents}) < 2:
        return model
    labels = [np.full(len(x), bad) for x, bad in documents]
    for k in range(rounds + 1):
        if k:
            labels = [_latent(x, bad, model) for x, bad in documents]
        model = LineModel(zero=True).train([(x, y) for (x, _), y in zip(documents, labels)])
    return model


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    label_col: str = "quality",
    id_col: str = "doc_id",
    modulus: int = 4,
    held_out: int = 2,
    max_rows: int = 1500,
    stretch: int = 400,
    stretches: int = 8,
) -> LineModel:
    """Train on labelled documents whose crc32(id) mod ``modulus`` isn't ``held_out``, within the bounds that the parameters name."""
    rows = training_rows(docs, labels, label_col, id_col=id_col, modulus=modulus, held_out=held_out, max_rows=max_rows)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for text, label in zip(pdf["text"], pdf["label"]):
                x = document_features(split_lines(text)).astype("int8")
                starts = range(0, len(x), stretch)
                for i in np.unique(np.linspace(0, len(starts) - 1, min(stretches, len(starts))).astype(int)) if len(x) else ():
                    out.append((x[starts[i] : starts[i] + stretch].tobytes(), int(label == 0)))
            yield pd.DataFrame(out, columns=["x", "bad"]).astype({"bad": "int64"})

    got = sorted((bytes(r.x), r.bad) for r in rows.select("text", "label").mapInPandas(measure, "x binary, bad long").collect())
    return train([(np.frombuffer(x, "int8").reshape(-1, len(LINE_FEATURES)).astype(float), bad) for x, bad in got])


def held_out(id_col: str, modulus: int = 4, fold: int = 2):
    return F.coalesce(crc_mod(id_col, modulus) == fold, F.lit(False))


def annotate(docs: DataFrame, model: LineModel, *, text_col: str = "text", keep_share: float = 0.5, out: str = "rules") -> DataFrame:
    """docs with a struct column ``out``: the base counts, the line labels (0 content, 1 boilerplate, one
    for each line with a word), the content share of the words, and the verdicts."""
    fields = (
        "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, labels array<tinyint>, content_share double, kept boolean"
    )

    @F.pandas_udf(fields)
    def run(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            text = text or ""
            lines = split_lines(text)
            words = [w for _, ws, _ in lines for w in ws]
            n, repeats = len(words), repeated_words(words)
            failed = n < 50 or 100 * repeats > 50 * n
            labels = model.decode(document_features(lines)) if lines else np.zeros(0, int)
            size = np.array([len(ws) for _, ws, _ in lines])
            share = float(size[labels == CONTENT].sum() / n) if n else 0.0
            rows.append(
                (n, sum(map(len, words)), len(_symbol.findall(text)), sum(s for _, _, s in lines), repeats, failed,
                 labels.tolist(), share, not failed and share >= keep_share)
            )
        return pd.DataFrame(rows, columns=[f.split()[0] for f in fields.split(", ")])

    return docs.withColumn(out, run(F.col(text_col)))

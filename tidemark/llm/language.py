"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads the UTF-8 bytes of the whole text, blanks and marks included: a forward and a backward
gated recurrent unit run over them, and a softmax over both states labels every byte; a document's
probabilities are the mean over all its bytes. It is trained in numpy by backpropagation through time on
stretches of a bounded sample of documents, with a fixed seed.

So that long and short texts run together, a text is read in windows of ``WINDOW`` bytes that overlap by
twice ``CONTEXT``: the states run through that many bytes before the first byte whose label counts, and every
byte is counted once, in the window where it has context on both sides (or the text's own end).

Bounds of the fit, all parameters: ``max_rows`` documents, dealt evenly over the languages; from each at most
``per_document`` stretches of ``stretch`` bytes, spread over all of it; ``max_stretches`` in all. Every text is
read whole when languages are identified.

Defined results: ``und`` with score 0 for a null text or one without a letter (a character that Unicode calls
alphabetic: not a number such as a fraction), or where nothing could be learned; ties go to the first language by
name; repeated rows agree; a column that is called as ``out`` is replaced, all others pass through; very long texts
are read whole in bounded memory; an empty table gives no rows, and nothing is learned from one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import crc_mod, slices

STATE, WINDOW, CONTEXT, BATCH = 12, 256, 16, 2048


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def windows(data: bytes) -> list[tuple[int, int, int, int]]:
    """(start, end, first, last) of the windows of a text: bytes start to end are read, and the labels of bytes first to
    last, counted from start, are kept. Every byte is kept once."""
    n, step, out, k = len(data), WINDOW - 2 * CONTEXT, [], 0
    while k == 0 or k + 2 * CONTEXT < n:
        end = min(n, k + WINDOW)
        out.append((k, end, CONTEXT if k else 0, end - k if end == n else WINDOW - CONTEXT))
        if end == n:
            break
        k += step
    return out


def stretches(data: bytes, size: int, number: int) -> list[bytes]:
    """At most ``number`` stretches of a text, spread over all of it."""
    last = max(0, len(data) - size)
    starts = np.unique(np.linspace(0, last, min(number, -(-len(data) // size))).astype(int)) if data else []
    return [data[i : i + size] for i in starts]


def padded(group: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes as (time, window), and their lengths."""
    length = np.fromiter(map(len, group), np.int64, len(group))
    t = int(length.max())
    flat = np.frombuffer(b"".join(b.ljust(t, b"\0") for b in group), np.uint8)
    return flat.reshape(len(group), t).T, length


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


class Recurrent:
    """Two gated recurrent units and a softmax; a unit has byte tables (256, 3S), U (S, 3S)."""

    def __init__(self, labels: list[str], seed: int = 5):
        draw, s = np.random.RandomState(seed), STATE
        self.labels = labels
        self.p = {}
        for d in "fb":
            self.p[f"x{d}"] = draw.normal(0, 0.3, (256, 3 * s)).astype(np.float32)
            self.p[f"u{d}"] = draw.normal(0, 1 / np.sqrt(s), (s, 3 * s)).astype(np.float32)
        self.p["o"] = draw.normal(0, 0.3, (2 * s, len(labels))).astype(np.float32)
        self.p["ob"] = np.zeros(len(labels), np.float32)

    def _run(self, x: np.ndarray, on: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        """States (time, window, S) of one direction; a padded place keeps the state before it."""
        table, u, s = self.p[f"x{d}"], self.p[f"u{d}"], STATE
        t, n = x.shape
        out, h = np.zeros((t, n, s), np.float32), np.zeros((n, s), np.float32)
        for i in range(t) if d == "f" else range(t - 1, -1, -1):
            a, b = table[x[i]], h @ u
            zr = _sigmoid(a[:, : 2 * s] + b[:, : 2 * s])
            z, r = zr[:, :s], zr[:, s:]
            c = np.tanh(a[:, 2 * s :] + r * b[:, 2 * s :])
            new = h + on[i][:, None] * z * (c - h)
            if keep is not None:
                keep.append((i, h, z, r, c, b[:, 2 * s :]))
            h = out[i] = new
        return out

    def label(self, x: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Probabilities (time, window, label) of every byte."""
        on = (np.arange(len(x))[:, None] < length).astype(np.float32)
        h = np.concatenate([self._run(x, on, "f"), self._run(x, on, "b")], 2)
        e = h @ self.p["o"] + self.p["ob"]
        e = np.exp(e - e.max(2, keepdims=True))
        return e / e.sum(2, keepdims=True) * on[..., None]

    def pooled(self, texts: list[bytes]) -> np.ndarray:
        """Mean probabilities of the bytes of each text that isn't empty; windows of a like length run together."""
        cut = [(i, *w) for i, data in enumerate(texts) if data for w in windows(data)]
        cut.sort(key=lambda w: w[1] - w[2])  # the longest first, so those still running are the first columns
        out = np.zeros((len(texts), len(self.labels)))
        fast = self._prepared()
        for i in range(0, len(cut), BATCH):
            part = cut[i : i + BATCH]
            total = self._sums([texts[k][a:b] for k, a, b, *_ in part], np.array([w[3:] for w in part]).T, fast)
            np.add.at(out, [w[0] for w in part], total.T)
        return out / np.maximum([[len(t)] for t in texts], 1)

    def _prepared(self) -> dict[str, np.ndarray]:
        """Weights with features first, halved where a sigmoid is written as a tanh."""
        s, out = STATE, {}
        for d in "fb":
            x, u = self.p[f"x{d}"].T.astype(np.float32), self.p[f"u{d}"].T.astype(np.float32)
            x[: 2 * s] *= 0.5
            out[f"x{d}"], out[f"u{d}"] = np.ascontiguousarray(x), np.ascontiguousarray(u * np.float32(0.5))
        out["of"], out["ob"] = (np.ascontiguousarray(o.T, np.float32) for o in np.split(self.p["o"], 2))
        out["bias"] = self.p["ob"].astype(np.float32)[:, None]
        return out

    def _sums(self, group: list[bytes], kept: np.ndarray, w: dict[str, np.ndarray]) -> np.ndarray:
        """Sums (label, window) of the probabilities of the kept bytes; windows come with the longest first."""
        length = np.fromiter(map(len, group), np.int64, len(group))
        t, n, s = int(length[0]), len(group), STATE
        x = np.frombuffer(b"".join(b.ljust(t, b"\0") for b in group), np.uint8).reshape(n, t).T.copy()
        live = [int(m) for m in np.searchsorted(-length, -np.arange(t), side="left")]
        states = np.empty((t, s, n), np.float32)
        a, b = np.empty((3 * s, n), np.float32), np.empty((3 * s, n), np.float32)

        def step(d: str, i: int, h: np.ndarray, m: int) -> np.ndarray:
            gate, new = (a, b) if m == n else (a[:, :m], b[:, :m])
            if m == n:
                np.take(w[f"x{d}"], x[i], axis=1, out=a, mode="clip")
                np.matmul(w[f"u{d}"], h, out=b)
            else:
                gate[:], new[:] = w[f"x{d}"][:, x[i, :m]], w[f"u{d}"] @ h[:, :m]
            zr, c = gate[: 2 * s], new[2 * s :]
            zr += new[: 2 * s]
            np.tanh(zr, out=zr)
            zr += 1
            c *= zr[s:]
            c += gate[2 * s :]
            np.tanh(c, out=c)
            c -= h[:, :m]
            c *= zr[:s]
            c *= 0.5
            c += h[:, :m]
            return c

        h = np.zeros((s, n), np.float32)
        for i in range(t):
            h[:, : live[i]] = step("f", i, h, live[i])
            states[i] = h
        h, total = np.zeros((s, n), np.float32), np.zeros((len(self.labels), n))
        for i in range(t - 1, -1, -1):
            m = live[i]
            h[:, :m] = step("b", i, h, m)
            e = w["of"] @ states[i, :, :m] + w["ob"] @ h[:, :m] + w["bias"]
            np.exp(e - e.max(0), out=e)
            e *= ((kept[0, :m] <= i) & (i < kept[1, :m])) / e.sum(0)
            total[:, :m] += e
        return total

    def _gradient(self, x: np.ndarray, length: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        on = (np.arange(len(x))[:, None] < length).astype(np.float32)
        kept: dict[str, list] = {"f": [], "b": []}
        h = np.concatenate([self._run(x, on, d, kept[d]) for d in "fb"], 2)
        e = h @ self.p["o"] + self.p["ob"]
        e = np.exp(e - e.max(2, keepdims=True))
        slope = (e / e.sum(2, keepdims=True) - np.eye(len(self.labels), dtype=np.float32)[y]) * on[..., None] / on.sum()
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        g["o"], g["ob"] = np.einsum("tns,tnk->sk", h, slope), slope.sum((0, 1))
        below, s = slope @ self.p["o"].T, STATE
        for d, part in (("f", below[..., :s]), ("b", below[..., s:])):
            u, back = self.p[f"u{d}"], np.zeros((x.shape[1], s), np.float32)
            seen, below_x = [], []
            for i, before, z, r, c, uc in reversed(kept[d]):
                back = back + part[i]
                gate = on[i][:, None]
                dz = back * gate * (c - before) * z * (1 - z)
                dc = back * gate * z * (1 - c * c)
                dr = dc * uc * r * (1 - r)
                inner = np.concatenate([dz, dr, dc], 1)
                seen.append(x[i])
                below_x.append(inner)
                recurrent = np.concatenate([dz, dr, dc * r], 1)
                g[f"u{d}"] += before.T @ recurrent
                back = back * (1 - gate * z) + recurrent @ u.T
            at, inner = np.concatenate(seen), np.concatenate(below_x)
            g[f"x{d}"][:] = np.stack([np.bincount(at, column, 256) for column in inner.T], 1)
        return g

    def train(self, group: list[bytes], y: np.ndarray, *, epochs: int = 6, batch: int = 128, rate: float = 0.02, seed: int = 5):
        draw = np.random.RandomState(seed)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        for epoch in range(epochs):
            order = draw.permutation(len(group))
            for i in range(0, len(group), batch):
                part = order[i : i + batch]
                grad = self._gradient(*padded([group[k] for k in part]), y[part])
                step += 1
                for k, v in grad.items():  # Adam
                    first[k] = 0.9 * first[k] + 0.1 * v
                    second[k] = 0.99 * second[k] + 0.01 * v * v
                    move = (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)
                    self.p[k] -= (rate * (1 - epoch / epochs) * move).astype(np.float32)
        return self


def learnable(
    docs: DataFrame, *, lang_col: str, id_col: str, text_col: str, modulus: int, held_out: int, max_rows: int
) -> DataFrame:
    """(id, text, lang) of rows outside the held-out fold, one for each chosen id and language: every language that
    has a text to learn from has its share of ``max_rows``, one row at least."""
    known = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where(
        F.col("lang").isNotNull() & (crc_mod(id_col, modulus) != held_out) & F.col("text").rlike(r"[^\x20\x09-\x0D]{2}|[^\x00-\x7F]")
    )
    ids = known.select("id", "lang").distinct()
    sizes = ids.groupBy("lang").agg(F.count("*").alias("n")).collect()
    each = max(1, max_rows // max(1, len(sizes)))
    # somewhat more than ``each`` ids of a language are drawn by their hash, so ranking them is a small task
    shares = docs.sparkSession.createDataFrame([(r.lang, min(1.0, (each + 6 * each**0.5 + 20) / r.n)) for r in sizes], "lang string, share double")
    drawn = F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(1 << 32)) / float(1 << 32)
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.md5(F.col("id").cast("string")), "id"))
    some = ids.join(F.broadcast(shares), "lang").where(drawn < F.col("share"))
    chosen = some.withColumn("place", place).where(F.col("place") <= each).select("id", "lang")
    # max_rows bounds the broadcast side, or one row a language
    return known.join(F.broadcast(chosen), ["id", "lang"]).groupBy("id", "lang").agg(F.min("text").alias("text"))


def fit(
    docs: DataFrame,
    *,
    lang_col: str = "lang",
    id_col: str = "doc_id",
    text_col: str = "text",
    modulus: int = 4,
    held_out: int = 2,
    max_rows: int = 2000,
    per_document: int = 8,
    stretch: int = 64,
    max_stretches: int = 4096,
) -> Recurrent | None:
    """Learn from documents outside the held-out fold, within the bounds that the parameters name."""
    rows = learnable(
        docs, lang_col=lang_col, id_col=id_col, text_col=text_col, modulus=modulus, held_out=held_out, max_rows=max_rows
    )

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [stretches(t.encode("utf-8", "replace"), stretch, per_document) if has_letter(t) else [] for t in pdf["text"]]
            yield pd.DataFrame({"id": pdf["id"], "lang": pdf["lang"], "found": found})

    named = rows.select(F.col("id").cast("string").alias("id"), "text", "lang")
    got = sorted(named.mapInPandas(draw, "id string, lang string, found array<binary>").collect(), key=lambda r: (r.id, r.lang))
    labels = sorted({r.lang for r in got if len(r.found)})
    if not labels:
        return None
    by: dict[str, list[bytes]] = {k: [bytes(w) for r in got if r.lang == k for w in r.found] for k in labels}
    pick, share = np.random.RandomState(3), max_stretches // len(labels) + 1
    group, y = [], []
    for i, k in enumerate(labels):
        own = by[k] if len(by[k]) <= share else [by[k][j] for j in pick.choice(len(by[k]), share, replace=False)]
        group, y = group + own, y + [i] * len(own)
    return Recurrent(labels).train(group, np.array(y))


def identify(docs: DataFrame, model: Recurrent | None, *, text_col: str = "text", out: str = "language") -> DataFrame:
    """docs with a struct column ``out``: lang, and score, its pooled probability."""

    @F.pandas_udf("lang string, score double")
    def run(texts: pd.Series) -> pd.DataFrame:
        lang, score = ["und"] * len(texts), [0.0] * len(texts)
        if model is not None:
            read = [(i, t.encode("utf-8", "replace")) for i, t in enumerate(texts) if has_letter(t)]
            for part in slices([d for _, d in read]):
                for (i, _), p in zip(read[part], model.pooled([d for _, d in read[part]])):
                    lang[i], score[i] = model.labels[int(p.argmax())], float(min(p.max(), 1.0))
        return pd.DataFrame({"lang": lang, "score": score})

    return docs.withColumn(out, run(F.col(text_col)))


def held_out(id_col: str, modulus: int = 4, fold: int = 2):
    return F.coalesce(crc_mod(id_col, modulus) == fold, F.lit(False))

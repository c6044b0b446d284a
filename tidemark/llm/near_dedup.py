"""Near duplicates by consistent weighted sampling over TF-IDF shingles.

A text is a weighted set of five-word shingles: the weight is the shingle's count times the mean
inverse document frequency of its words. (The frequency is that of the words: with the frequency of
whole shingles, the shared shingles of a large group of copies would weigh next to nothing against
an edited one, and links would be lost; README has the figures.) Word frequencies are counted over
all documents into 2**16 hashed slots.

1. Equal texts collapse to one by digest (a task sketches the copies that it meets once); a text has a number from then on.
2. Improved consistent weighted sampling gives every text ``bands * rows`` samples; the ``rows``
   samples of a band make a bucket key.
3. In every bucket the member whose buckets are the fullest is the centre, and every other member is
   verified against it by exact weighted Jaccard similarity. A centre with many members is salted.
4. Links make components. Buckets that still hold several components are verified again, in blocks:
   every member outside the bucket's main component against every member of another component whose
   weight allows the similarity. So no link within a bucket is lost, and what is compared is what
   transitivity couldn't settle.
5. Components over all links are the classes.

No bucket, partner or candidate is capped. Two texts of similarity s share a bucket with a chance of
1 - (1 - s**rows)**bands: 0.9998 at 0.8.

Defined results: null texts are empty texts; equal texts are always one class, empty ones included;
texts of one to four words have one shingle, all their words; texts without words have none and only
match equal ones; a null id gets a null class and is never dropped, and texts that only null ids have link nothing; rows that
repeat an id are one document: the texts under one id are of one class; ids must be numbers (others fail the cast to long);
extra columns don't matter, whatever their names; texts of any length are read whole; an empty table has no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialize
from tidemark.llm.components import components

SLOTS, TABLE, MEMBERS, BLOCK, CELLS = 1 << 16, 4096, 64, 128, 1 << 23
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


#: Of a word's bytes a polynomial in BASE is taken, modulo 2**64, and mixed with the word's length.
BASE, WORDS, LONGEST = 0x9DDFEA08EB382D69, 1 << 14, 1 << 18
_tables: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of BASE and of its inverse; up to LONGEST of them are made once a process."""
    if n > LONGEST:
        return _made(n)
    if not _tables:
        _tables.extend(_made(LONGEST))
    return _tables[0][:n], _tables[1][:n]


def _made(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = tuple(np.full(n, x, np.uint64) for x in (BASE, pow(BASE, -1, 1 << 64)))
    for x in out:
        x[0] = 1
        np.cumprod(x, out=x)
    return out


def words_of(text: str | None) -> list[bytes]:
    """The words of a text in UTF-8; splitting bytes parts at the blanks of WORD and nothing else."""
    return _utf8(text).split()


def word_hashes(utf8: bytes) -> np.ndarray:
    """The hashes of a text's words (``words_of``), in order. WORDS words are hashed at a time, from differences of one running sum."""
    data = np.frombuffer(utf8, np.uint8)
    blank = np.ones(len(data) + 2, bool)
    np.less(data - np.uint8(9), 5, out=blank[1:-1])
    blank[1:-1] |= data == 32
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    starts, ends = edges[::2], edges[1::2]
    h = (ends - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for i in range(0, len(starts), WORDS):
        first, last = starts[i], ends[min(i + WORDS, len(ends)) - 1]
        up, down = _powers(last - first)
        sums = np.zeros(last - first + 1, np.uint64)
        np.cumsum(up * data[first:last].astype(np.uint64), out=sums[1:])
        at = starts[i : i + WORDS] - first
        h[i : i + WORDS] ^= (sums[ends[i : i + WORDS] - first] - sums[at]) * down[at]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def _slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(SLOTS - 1)).astype(np.int64)


def _slot(word: bytes) -> int:
    return int(_slots(word_hashes(word))[0])


def _utf8(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "replace")


def document_frequency(docs: DataFrame, *, text_col: str = "text") -> tuple[np.ndarray, int]:
    """Documents by hashed word, over all documents, and their number. Each task adds up its own
    first; the driver gets SLOTS sums at most."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros(SLOTS, np.int64), 0
        for pdf in batches:
            for text in pdf["text"]:
                n += 1
                total[_slots(word_hashes(_utf8(text)))] += 1  # an index that repeats counts once
        found = np.flatnonzero(total)
        yield pd.DataFrame({"slot": np.append(found, -1), "n": np.append(total[found], n)})

    parts = docs.select(F.col(text_col).alias("text")).mapInPandas(count, "slot long, n long")
    df, n = np.ones(SLOTS, np.float64), 0
    for slot, k in parts.groupBy("slot").agg(F.sum("n").alias("n")).collect():
        if slot < 0:
            n = k
        else:
            df[slot] = k
    return df, n


class Shingles:
    """(hashes, weights) of the distinct shingles of a text."""

    def __init__(self, idf: np.ndarray, size: int = 5):
        self.idf, self.size = idf, size

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        ids = word_hashes(_utf8(text))
        n = len(ids)
        if not n:
            return np.zeros(0, np.uint64), np.zeros(0)
        idf = self.idf[_slots(ids)]
        k = min(self.size, n)
        m = n - k + 1
        h, weight = ids[:m] * _ODD[0], idf[:m].copy()
        for i in range(1, k):
            h += ids[i : i + m] * _ODD[i % 5]
            weight += idf[i : i + m]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        order = np.argsort(h)
        h, weight = h[order], weight[order]
        new = np.empty(m, bool)
        new[0], new[1:] = True, h[1:] != h[:-1]
        if new.all():
            return h, weight / k
        first = np.flatnonzero(new)
        return h[first], weight[first] / k * np.diff(np.append(first, m))


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    if not len(a[0]) or not len(b[0]):
        return 0.0
    at = np.searchsorted(b[0], a[0])
    at[at == len(b[0])] = 0
    hit = b[0][at] == a[0]
    both = float(np.minimum(a[1][hit], b[1][at[hit]]).sum())
    return both / (float(a[1].sum()) + float(b[1].sum()) - both)


class Sampler:
    """Improved consistent weighted sampling. A shingle's draws (r, c ~ Gamma(2, 1), beta ~ U(0, 1)) are
    looked up by two parts of its hash in tables that every task makes from the same seed."""

    def __init__(self, samples: int, seed: int = 7):
        draw = np.random.RandomState(seed)
        self.r = draw.gamma(2.0, 1.0, (TABLE, samples)).astype(np.float32)
        self.inverse = (1.0 / self.r).astype(np.float32)
        self.beta = draw.uniform(0, 1, (TABLE, samples)).astype(np.float32)
        self.log_c = np.log(draw.gamma(2.0, 1.0, (TABLE, samples))).astype(np.float32)

    def __call__(self, h: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The sampled shingle and its quantised weight, for each sample."""
        samples = self.r.shape[1]
        best, who, level = np.full(samples, np.inf, np.float32), np.zeros(samples, np.uint64), np.zeros(samples, np.int64)
        one, two = (h & np.uint64(TABLE - 1)).astype(np.int64), ((h >> np.uint64(20)) & np.uint64(TABLE - 1)).astype(np.int64)
        log_w = np.log(weight).astype(np.float32)[:, None]
        columns = np.arange(samples)
        for i in range(0, len(h), 512):
            k = one[i : i + 512]
            beta, t = self.beta.take(k, 0), self.inverse.take(k, 0)
            t *= log_w[i : i + 512]
            t += beta
            np.floor(t, out=t)
            a = np.subtract(t, beta, out=beta)
            a += np.float32(1.0)
            a *= self.r.take(k, 0)
            np.subtract(self.log_c.take(two[i : i + 512], 0), a, out=a)
            low = a.argmin(0)
            value = a[low, columns]
            new = value < best
            best[new], who[new], level[new] = value[new], h[i + low[new]], t[low[new], columns[new]].astype(np.int64)
        return who, level


def band_keys(who: np.ndarray, level: np.ndarray, bands: int) -> np.ndarray:
    mixed = (who ^ (level.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))).reshape(bands, -1)
    key = np.arange(1, bands + 1).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for column in mixed.T:
        key = (key ^ column) * np.uint64(0xBF58476D1CE4E5B9)
        key ^= key >> np.uint64(31)
    return key.view(np.int64)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("id"), F.unhex(F.md5(text)).alias("digest"), text.alias("text"))


def sketch(rows_in: DataFrame, idf: np.ndarray, *, bands: int, rows: int, shingle: int) -> DataFrame:
    """(id, digest, weight, keys) of rows (id, digest, text): the weight of all shingles and the bucket keys, none for a text
    without words. A task remembers some thousand texts by digest, so it sketches the copies that it meets once."""
    sent = rows_in.sparkSession.sparkContext.broadcast(idf)  # SLOTS numbers, whatever the input

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cut, sample, seen = Shingles(sent.value, shingle), Sampler(bands * rows), {}
        for pdf in batches:
            out = []
            for name, text in zip(pdf["digest"], pdf["text"]):
                got = seen.get(name)
                if got is None:
                    h, w = cut(text)
                    got = float(w.sum()), band_keys(*sample(h, w), bands) if len(h) else np.zeros(0, np.int64)
                    if len(seen) > 4096:
                        seen.clear()
                    seen[name] = got
                out.append(got)
            yield pd.DataFrame({"id": pdf["id"], "digest": pdf["digest"], "weight": [x for x, _ in out], "keys": [k for _, k in out]})

    return rows_in.mapInPandas(run, "id long, digest binary, weight double, keys array<long>")


def _verified(members: DataFrame, texts: DataFrame, idf: np.ndarray, *, shingle: int, threshold: float) -> DataFrame:
    """Links (a, b) of similarity ``threshold`` or more between the sides of a group.

    members: (g1, g2, g3, node, side, comp); within a group (g1, g2, g3) every node of side 0 is compared
    with every node of side 1 of another comp. Groups are small by their making; a task holds the shingles of
    a group's texts, and a matrix of CELLS weights."""
    sent = members.sparkSession.sparkContext.broadcast(idf)
    held: list[Shingles] = []  # one for a task

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        if not held:
            held.append(Shingles(sent.value, shingle))
        cut = held[0]
        pdf = pdf.drop_duplicates(["node", "side"])
        sets = {node: cut(text) for node, text in zip(pdf["node"], pdf["text"])}
        sides = [[(n, c) for n, c, s in zip(pdf["node"], pdf["comp"], pdf["side"]) if s == k] for k in (0, 1)]
        out = []
        if len(sides[0]) <= 2:
            for n0, c0 in sides[0]:
                for n1, c1 in sides[1]:
                    if c0 != c1 and n0 != n1 and weighted_jaccard(sets[n0], sets[n1]) >= threshold:
                        out.append((n0, n1))
            return pd.DataFrame(out, columns=["a", "b"], dtype="int64")
        # shingles of the group as numbers; the other side's weights as rows of a matrix of at most CELLS cells at a time
        axis = np.unique(np.concatenate([sets[n][0] for side in sides for n, _ in side]))
        at = {n: np.searchsorted(axis, sets[n][0]) for side in sides for n, _ in side}
        step = max(1, CELLS // max(1, len(axis)))
        for k in range(0, len(sides[1]), step):
            part = sides[1][k : k + step]
            dense = np.zeros((len(part), len(axis)), np.float32)
            for i, (n, _) in enumerate(part):
                dense[i, at[n]] = sets[n][1]
            total1 = dense.sum(1, dtype=np.float64)
            node1, comp1 = (np.array(x) for x in zip(*part))
            for n0, c0 in sides[0]:
                w = sets[n0][1].astype(np.float32)
                both = np.minimum(dense[:, at[n0]], w).sum(1, dtype=np.float64)
                union = total1 + float(w.sum()) - both
                near = np.flatnonzero((both >= (threshold - 1e-4) * np.maximum(union, 1e-9)) & (comp1 != c0) & (node1 != n0))
                out += [(n0, int(node1[i])) for i in near if weighted_jaccard(sets[n0], sets[int(node1[i])]) >= threshold]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return (
        members.join(texts, "node").groupBy("g1", "g2", "g3").applyInPandas(compare, "a long, b long")
    )


def _same_ids(named: DataFrame) -> DataFrame:
    """Links (a, b) between the texts under one id, of (id, node) rows."""
    several = named.groupBy("id").agg(F.min("node").alias("a"), F.max("node").alias("z")).where("a < z").drop("z")
    return named.join(several, "id").select("a", F.col("node").alias("b")).where("a != b").distinct()


def _classed(
    docs: DataFrame, *, id_col: str, text_col: str, threshold: float, shingle: int, bands: int, rows: int
) -> DataFrame:
    """(id, digest, class_id) of every row."""
    every = _keyed(docs, id_col, text_col)
    df, n = document_frequency(every)
    idf = np.log1p(max(n, 1) / df) + 1.0 if n else np.ones(SLOTS)
    options = {"shingle": shingle, "threshold": threshold}
    sketched = materialize(sketch(every, idf, bands=bands, rows=rows, shingle=shingle))
    # one row a text; its number is short, and fixed as it is written
    unique = sketched.groupBy("digest").agg(F.min("id").alias("least"), F.first("weight").alias("weight"), F.first("keys").alias("keys")).where("least is not null")
    unique = materialize(unique.withColumn("rep", F.monotonically_increasing_id()))
    all_rows = unique.select("rep", "weight", F.explode("keys").alias("key")).distinct()
    shared = all_rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    buckets = materialize(all_rows.join(shared, "key"))
    # the texts that share a bucket with another are taken out once, for both verifications
    wanted = unique.select(F.col("rep").alias("node"), "digest").join(buckets.select(F.col("rep").alias("node")).distinct(), "node")
    texts = materialize(every.select("digest", "text").join(wanted.hint("merge"), "digest").dropDuplicates(["digest"]).select("node", "text"))
    ranked = buckets.join(buckets.groupBy("rep").agg(F.sum("n").alias("full")), "rep")
    centres = ranked.groupBy("key").agg(F.max_by(F.struct("rep", "weight"), F.struct("full", -F.col("rep"))).alias("c"))
    # a similarity of t needs weights that differ by a factor of t at most
    alike = F.least("weight", "c.weight") >= F.greatest("weight", "c.weight") * (threshold - 1e-9)
    # written, as all that is used twice: a plan that holds its input twice over is twice the driver's
    stars = materialize(buckets.join(centres, "key").where((F.col("rep") != F.col("c.rep")) & alike).select(F.col("c.rep").alias("centre"), "rep").distinct())
    salts = stars.groupBy("centre").agg(F.ceil(F.count("*") / MEMBERS).alias("salts"))
    stars = materialize(
        stars.join(salts, "centre").select("centre", "rep", F.pmod(F.xxhash64("rep"), F.col("salts")).alias("salt"))
    )
    member = stars.select(
        F.col("centre").alias("g1"), F.col("salt").alias("g2"), F.lit(0).alias("g3"),
        F.col("rep").alias("node"), F.lit(1).alias("side"), F.col("rep").alias("comp"),
    )
    centre = member.select("g1", "g2", "g3", F.col("g1").alias("node"), F.lit(0).alias("side"), F.col("g1").alias("comp")).distinct()
    links = materialize(_verified(member.unionByName(centre), texts, idf, **options))

    labels = components(links)
    # bins of weight: texts of a similarity of ``threshold`` are in the same bin or in neighbours
    width = -math.log(threshold) if 0 < threshold < 1 else 1.0
    held = materialize(
        buckets.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select(
            "key", "rep", F.coalesce("label", "rep").alias("comp"), F.floor(F.log("weight") / (width + 1e-9)).alias("bin")
        )
    )
    by_comp = held.groupBy("key", "comp").agg(F.count("*").alias("n"))
    mixed = by_comp.groupBy("key").agg(
        F.max_by("comp", F.struct("n", -F.col("comp"))).alias("main"), F.count("*").alias("comps")
    ).where("comps > 1")
    open_rows = materialize(held.join(mixed.drop("comps"), "key"))
    near_bins = F.explode(F.array(F.col("bin") - 1, F.col("bin"), F.col("bin") + 1))
    minor = open_rows.where("comp != main").select("key", "rep", "comp", near_bins.alias("bin"))
    whole = open_rows.select("key", "rep", "comp", "bin")
    # both sides of a bin are dealt over blocks; a group is one block of each
    count = lambda df, name: df.groupBy("key", "bin").agg(F.ceil(F.count("*") / BLOCK).alias(name), F.min("comp").alias(f"{name}_low"), F.max("comp").alias(f"{name}_high"))
    bins = count(minor, "minors").join(count(whole, "blocks"), ["key", "bin"])
    bins = materialize(bins.where("least(minors_low, blocks_low) != greatest(minors_high, blocks_high)").select("key", "bin", "minors", "blocks"))
    upto = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    group, node = F.xxhash64("key", "bin").alias("g1"), F.col("rep").alias("node")
    mine = F.pmod(F.xxhash64("rep"), F.col("minors")).alias("g2")
    theirs = F.pmod(F.xxhash64("rep", F.lit(1)), F.col("blocks")).alias("g3")
    left = minor.join(bins, ["key", "bin"]).select(group, mine, upto("blocks").alias("g3"), node, F.lit(0).alias("side"), "comp")
    right = whole.join(bins, ["key", "bin"]).select(group, upto("minors").alias("g2"), theirs, node, F.lit(1).alias("side"), "comp")
    more = materialize(_verified(left.unionByName(right), texts, idf, **options))
    named = materialize(sketched.where("id is not null").select("id", "digest").join(unique.select("digest", F.col("rep").alias("node")), "digest"))
    joined = labels.select(F.col("node").alias("a"), F.col("label").alias("b")).unionByName(more).unionByName(_same_ids(named.select("id", "node")))
    final = components(joined)
    labelled = unique.select(F.col("rep").alias("node"), "least").join(final, "node", "left").withColumn("label", F.coalesce("label", "node"))
    labelled = materialize(labelled)
    of_text = labelled.join(labelled.groupBy("label").agg(F.min("least").alias("class_id")), "label").select("node", "class_id")
    known = named.join(of_text, "node").select("id", "digest", "class_id")
    return known.unionByName(sketched.where("id is null").select("id", "digest", F.lit(None).cast("long").alias("class_id")))


def classes(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = 0.8,
    shingle: int = 5,
    bands: int = 16,
    rows: int = 4,
) -> DataFrame:
    """(id, class_id) of every row: class_id is the least id of its class."""
    found = _classed(docs, id_col=id_col, text_col=text_col, threshold=threshold, shingle=shingle, bands=bands, rows=rows)
    return found.select(F.col("id").alias(id_col), "class_id")


def one_of_each(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = 0.8,
    shingle: int = 5,
    bands: int = 16,
    rows: int = 4,
) -> DataFrame:
    """One row of the document that names its class (of its texts the one with the least digest), and the rows without an id;
    columns as they came."""
    found = _classed(docs, id_col=id_col, text_col=text_col, threshold=threshold, shingle=shingle, bands=bands, rows=rows)
    kept = found.where("id = class_id").groupBy(F.col("id").alias("_id")).agg(F.min("digest").alias("_name"))
    whole = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("_key"), F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit("")))).alias("_digest"))
    named = whole.join(kept, (F.col("_key") == F.col("_id")) & (F.col("_digest") == F.col("_name"))).dropDuplicates(["_key", "_digest"]).select("row.*")
    return named.unionByName(docs.where(F.col(id_col).isNull()))

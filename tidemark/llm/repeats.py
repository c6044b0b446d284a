"""Removal of long repeated strings with a suffix array that is built blockwise from a difference cover.

Two bytes' suffixes belong together if they agree in their first ``length`` bytes; a byte goes if such a suffix
covers it. The suffixes of a corpus are as many as its bytes, so the array is never there as a
whole:

1. Cover sample. D is a difference cover of the numbers modulo v: any two positions reach, by one common step
   of less than v, two positions in D. If the suffixes at i and j agree in ``length`` bytes, then the sampled suffixes at
   i + step and j + step agree in length - v + 1. The sampled suffixes (an eighth of all) are sorted
   bucket by bucket to this depth and ranked; the rank that the next step needs is whether another
   sampled suffix ties with it.
2. Buckets. A suffix none of whose next v sampled positions ties can't tie itself. Only the others are
   dealt to buckets, and one bucket at a time is sorted; a long tie between them has been carried by the ranks of
   the sample, so a bucket never looks further than ``length`` bytes.
3. Suffixes that tie mark their bytes.

A sort key is a fingerprint of a suffix's first bytes, not the bytes: only ties matter here, not the order of what differs, and a key
of 200 bytes for each suffix would be 200 times the corpus. A fingerprint is a polynomial over random values of the bytes modulo 2^64; keys of step 2 have
64 bits and those of their bucket, from a second polynomial, so an accidental tie is expected less than once in 10^6 corpora of a
GB (in step 1 it costs time only, and 40 bits suffice).

Texts lie in blocks of some MB in a table that is bucketed by block. A block sends each bucket its keys, sorted and each once, as
planes of bytes, whose upper planes compress to nothing; a bucket answers with a bit for each key. Blocks meet the
answers without being shuffled again, so neither text nor position is ever sent. Hot strings (a passage of a third
of the documents) are one key a block. A bucket has a bounded number of keys, however large the corpus. Exact copies
take no part but for the first.

Defined results: strings are over UTF-8 bytes and never cross documents; a null text is empty; an empty text keeps
nothing (the digest of no bytes); documents shorter than ``length`` lose nothing; repeated rows are copies, with a row each in the
result; null ids are documents like any others; an empty table gives no rows; other columns are ignored. Documents
longer than a block are cut into overlapping pieces and put together again.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import hot_join, materialize, shared_dir

LENGTH, BLOCK = 200, 4 << 20
#: A perfect difference cover (every difference modulo COVER occurs).
COVER, SAMPLE = 73, (0, 1, 12, 20, 26, 30, 33, 35, 57)
#: Keys of a bucket.
KEYS = 1 << 21
FILTER_BYTES, KEY_BYTES = 5, 8


# -- fingerprints -------------------------------------------------------------------------------

BASE = 0x9E3779B97F4A7C15
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, kept for the worker's next block."""
    if len(_powers.get("up", ())) < n:
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            out = np.full(n, base, np.uint64)
            out[0] = 1
            _powers[name] = np.multiply.accumulate(out)
    return _powers["up"][:n], _powers["down"][:n]


def values(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**64, 256, dtype=np.uint64)


def sums(data: np.ndarray, seed: int) -> np.ndarray:
    """Prefix sums of the polynomial."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values(seed)[data] * powers(len(data) + 1)[0][:-1], out=out[1:])
    return out


def prints(prefix: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Fingerprints of the ``length`` bytes from each position."""
    h = (prefix[at + length] - prefix[at]) * powers(len(prefix))[1][at]
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


# -- blocks -------------------------------------------------------------------------------------


def blocks(docs: DataFrame, id_col: str, text_col: str, length: int, size: int) -> DataFrame:
    """The texts in blocks: block, and arrays of row, id, piece, start (of a piece in its text), n (bytes of the text) and bytes
    (of the piece), with the pieces' bytes one after the other in ``data``. ``digest`` tells copies."""
    schema = (
        "block long, row array<long>, id array<long>, piece array<int>, start array<long>, n array<long>, bytes array<long>, "
        "digest array<binary>, data binary"
    )
    names = ("row", "id", "piece", "start", "n", "bytes", "digest")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first, row, block = TaskContext.get().partitionId() << 33, 0, 0
        held: list[tuple] = []
        data, total = [], 0

        def done() -> pd.DataFrame:
            return pd.DataFrame({"block": [first + block], **{k: [[h[i] for h in held]] for i, k in enumerate(names)}, "data": [b"".join(data)]})

        for pdf in batches:
            for doc, text in zip(pdf["id"], pdf["text"]):
                raw = text.encode("utf-8", "replace")
                digest = hashlib.sha256(raw).digest()
                for piece, start in enumerate(range(0, max(1, len(raw) - length + 1), size)):
                    part = raw[start : start + size + length - 1]
                    if held and total + len(part) > size:
                        yield done()
                        held, data, total, block = [], [], 0, block + 1
                    held.append((first + row, None if pd.isna(doc) else int(doc), piece, start, len(raw), len(part), digest))
                    data.append(part)
                    total += len(part)
                row += 1
        if held:
            yield done()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInPandas(cut, schema)


def stored(df: DataFrame, parts: int) -> DataFrame:
    """The blocks as a table in the shared folder, bucketed by block: later joins leave them where they are."""
    spark, name = df.sparkSession, f"tidemark_{uuid.uuid4().hex}"
    df.write.bucketBy(parts, "block").option("path", f"{shared_dir(spark)}/{name}").option("compression", "zstd").format("parquet").saveAsTable(name)
    return spark.table(name)


class Block:
    """A block's positions: ``enough``, whether a suffix has ``length`` bytes; ``sample``, the cover's with ``depth`` bytes. Copies have none."""

    def __init__(self, r, length: int):
        self.data = np.frombuffer(r.data, np.uint8)
        n = np.asarray(r.bytes, np.int64)
        self.starts = np.concatenate([[0], np.cumsum(n)])[:-1]
        self.live = np.ones(len(n), bool)
        if r.copies is not None:
            self.live[np.asarray(r.copies, np.int64)] = False
        self.length, self.depth = length, length - COVER + 1
        local = np.arange(len(self.data)) - np.repeat(self.starts, n)
        room = np.repeat(n, n) - local
        live = np.repeat(self.live, n)
        cover = np.zeros(COVER, bool)
        cover[list(SAMPLE)] = True
        self.enough = live & (room >= length)
        self.sample = np.flatnonzero(live & (room >= self.depth) & cover[local % COVER])

    def candidates(self, tied: np.ndarray) -> np.ndarray:
        """Positions of suffixes with a tied sample among their next COVER positions."""
        marks = np.zeros(len(self.data) + 1, np.int32)
        np.add.at(marks, np.maximum(tied - COVER + 1, 0), 1)
        np.add.at(marks, tied + 1, -1)
        return np.flatnonzero((np.cumsum(marks)[:-1] > 0) & self.enough)


# -- one sorted bucket at a time -----------------------------------------------------------------


def planes(keys: np.ndarray, width: int) -> bytes:
    """Sorted keys as planes of bytes, the upper ones first."""
    return keys.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - width :].T.tobytes()


def from_planes(data: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(data) // width, 8), np.uint8)
    out[:, 8 - width :] = np.frombuffer(data, np.uint8).reshape(width, -1).T
    return out.reshape(-1).view(">u8").astype(np.uint64)


class Dealt:
    """Keys of a block, dealt to 2^bits buckets: ``distinct`` in the order of (bucket, key), ``bucket`` of each, ``often`` (more than once
    in this block) and ``of`` (the index of each position's key)."""

    def __init__(self, bucket: np.ndarray, keys: np.ndarray, bits: int):
        order = np.lexsort((keys, bucket))
        k, b = keys[order], bucket[order]
        new = np.ones(len(k), bool)
        new[1:] = (k[1:] != k[:-1]) | (b[1:] != b[:-1])
        self.distinct, self.bucket = k[new], b[new]
        index = np.cumsum(new) - 1
        self.of = np.empty(len(k), np.int64)
        self.of[order] = index
        self.often = np.bincount(index, minlength=len(self.distinct)) > 1
        self.bounds = np.searchsorted(self.bucket, np.arange((1 << bits) + 1))

    def messages(self, block: int, width: int) -> pd.DataFrame:
        at = self.bounds
        full = np.flatnonzero(np.diff(at))
        return pd.DataFrame({"bucket": full, "block": block, "keys": [planes(self.distinct[at[b] : at[b + 1]], width) for b in full]})

    def tied(self, answers) -> np.ndarray:
        """Which positions tie with another, by the answers (bucket, bits) of all buckets."""
        hit = self.often.copy()
        for a in answers if answers is not None else ():
            lo, hi = self.bounds[a["bucket"]], self.bounds[a["bucket"] + 1]
            hit[lo:hi] |= np.unpackbits(np.frombuffer(a["bits"], np.uint8), count=hi - lo).astype(bool)
        return hit[self.of]


def bucket_bits(keys: float) -> int:
    return max(2, int(np.ceil(np.log2(max(keys, 1) / KEYS))))


def sorted_buckets(messages: DataFrame, width: int) -> DataFrame:
    """(block, answers): which of a block's keys another block has too. Each bucket is sorted alone."""

    def sort(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = [from_planes(k, width) for k in pdf["keys"]]
        every = np.sort(np.concatenate(parts))
        ties = np.unique(every[1:][every[1:] == every[:-1]])
        bits = [np.packbits(np.isin(p, ties, assume_unique=True)).tobytes() for p in parts]
        return pd.DataFrame({"block": pdf["block"], "bucket": pdf["bucket"], "bits": bits})

    answers = messages.groupBy("bucket").applyInPandas(sort, "block long, bucket int, bits binary")
    # as many answers as there are buckets, with a bit for each of the block's keys
    return answers.groupBy("block").agg(F.collect_list(F.struct("bucket", "bits")).alias("answers"))


def sample_keys(b: Block, bits: int) -> Dealt:
    h = prints(sums(b.data, 1), b.sample, b.depth)
    return Dealt((h >> np.uint64(64 - bits)).astype(np.int64), (h << np.uint64(bits)) >> np.uint64(64 - 8 * FILTER_BYTES), bits)


def suffix_keys(b: Block, at: np.ndarray, bits: int) -> Dealt:
    which = prints(sums(b.data, 2), at, b.length) >> np.uint64(64 - bits)
    return Dealt(which.astype(np.int64), prints(sums(b.data, 1), at, b.length), bits)


# -- the operator -------------------------------------------------------------------------------


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, block_bytes: int = BLOCK) -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans, kept_sha256, and ``spans`` (start, end) of what goes."""
    if length < 2 * COVER:
        raise ValueError(f"length must be {2 * COVER} at least")
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = stored(blocks(docs, id_col, text_col, length, block_bytes), parts)
    size = F.aggregate("bytes", F.lit(0).cast("long"), lambda a, x: a + x)
    whole, n_pieces = texts.agg(F.coalesce(F.sum(size), F.lit(0)), F.coalesce(F.sum(F.size("row")), F.lit(0))).first()

    # of texts with copies the first takes part, the others are gone as a whole, as it is
    item = F.posexplode(F.arrays_zip("digest", "piece", "row", "n")).alias("at", "item")
    pieces = texts.select("block", item).select("block", "at", "item.*").where(f"n >= {length}")
    twins = pieces.where("piece = 0").groupBy("digest").agg(F.min("row").alias("least"), F.count("*").alias("rows")).where("rows > 1")
    named = hot_join(pieces, twins, "digest", times="rows", total=n_pieces).groupBy("block").agg(
        F.collect_list(F.when(F.col("row") != F.col("least"), F.col("at"))).alias("copies"), F.collect_list("at").alias("twins")
    )
    texts = texts.join(materialize(named).hint("shuffle_hash"), "block", "left")

    bits = bucket_bits(whole * len(SAMPLE) / COVER)

    def samples(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples():
                yield sample_keys(Block(r, length), bits).messages(r.block, FILTER_BYTES)

    message = "bucket int, block long, keys binary"
    ranks = materialize(sorted_buckets(texts.select("block", "bytes", "copies", "data").mapInPandas(samples, message), FILTER_BYTES))
    ranked = texts.join(ranks.withColumnRenamed("answers", "ranks").hint("shuffle_hash"), "block", "left")

    def suffixes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples():
                b = Block(r, length)
                at = b.candidates(b.sample[sample_keys(b, bits).tied(r.ranks)])
                yield suffix_keys(b, at, bits).messages(r.block, KEY_BYTES)

    ties = materialize(sorted_buckets(ranked.select("block", "bytes", "copies", "data", "ranks").mapInPandas(suffixes, message), KEY_BYTES))
    final = ranked.join(ties.withColumnRenamed("answers", "ties").hint("shuffle_hash"), "block", "left")

    schema = "row long, id long, n long, start long, spans array<struct<start:long,end:long>>, kept_sha256 string, data binary"

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples():
                b = Block(r, length)
                at = b.candidates(b.sample[sample_keys(b, bits).tied(r.ranks)])
                at = at[suffix_keys(b, at, bits).tied(r.ties)]
                whole_texts = set() if r.twins is None else set(map(int, r.twins))
                bounds = np.searchsorted(at, b.starts)
                out = []
                for i, start in enumerate(b.starts):
                    size = int(r.bytes[i])
                    own = at[bounds[i] : bounds[i + 1] if i + 1 < len(bounds) else len(at)] - start
                    spans = [(0, size)] if i in whole_texts else spans_of(own, length)
                    part = r.data[start : start + size]
                    alone = size == r.n[i]
                    digest = kept_digest(part, spans) if alone else None
                    shifted = [{"start": s + int(r.start[i]), "end": e + int(r.start[i])} for s, e in spans]
                    out.append((r.row[i], r.id[i], r.n[i], r.start[i], shifted, digest, None if alone else part))
                frame = pd.DataFrame(out, columns=["row", "id", "n", "start", "spans", "kept_sha256", "data"])
                frame["id"] = frame["id"].astype("Int64")
                yield frame

    def join_pieces(pdf: pd.DataFrame) -> pd.DataFrame:
        """A text that is longer than a block: its pieces overlap by length - 1."""
        pdf = pdf.sort_values("start")
        text, spans = bytearray(), []
        for r in pdf.itertuples():
            text[r.start :] = r.data
            for s in r.spans:
                if spans and s["start"] <= spans[-1][1]:
                    spans[-1] = (spans[-1][0], max(spans[-1][1], s["end"]))
                else:
                    spans.append((s["start"], s["end"]))
        one = pdf.iloc[:1].copy()
        one["spans"] = [[{"start": s, "end": e} for s, e in spans]]
        one["kept_sha256"], one["data"] = kept_digest(bytes(text), spans), None
        return one

    marked = materialize(final.mapInPandas(mark, schema))
    long_texts = marked.where("data IS NOT NULL").groupBy("row").applyInPandas(join_pieces, schema)
    every = marked.where("data IS NULL").unionByName(long_texts)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return every.select(
        F.col("id").alias(id_col), F.col("n").alias("n_bytes"), removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), "kept_sha256", "spans"
    )


def spans_of(at: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes that suffixes at these sorted positions cover."""
    if not len(at):
        return []
    cut = np.flatnonzero(np.diff(at) > length) + 1
    return [(int(a[0]), int(a[-1]) + length) for a in np.split(at, cut)]


def kept_digest(data: bytes, spans: list[tuple[int, int]]) -> str:
    kept, at = hashlib.sha256(), 0
    for start, end in spans:
        kept.update(data[at:start])
        at = end
    kept.update(data[at:])
    return kept.hexdigest()

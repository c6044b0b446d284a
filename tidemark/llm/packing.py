"""Best-fit packing of tokenised documents into sequences of a fixed length.

A document is its token ids and an end id. Documents longer than a sequence are cut into full
pieces, the first piece takes the remainder. Packing is bulk-synchronous best-fit, largest first:
pieces are range-sorted by length, and one superstep places all pieces of one length at once. It
sweeps the open gaps upwards from that length (each gap takes the pieces that fit, the smallest gaps
first), the pieces' rank among their equals decides which piece takes which place, the gaps are
updated, and what found no gap opens new sequences.

Lengths are integers up to the capacity, so pieces of one length and gaps of one kind are runs: a
superstep works on runs with counts, and all supersteps together see at most ``capacity`` lengths,
whatever the number of documents. The driver gets one count per length and makes a table of runs
(also bounded by the capacity); everything per document - tokenising, sorting, ranking, looking its
place up - is done by Spark. The result is that of best-fit decreasing over all pieces.

Defined results: null texts are empty; an empty text is the end id alone; null ids and repeated rows
are packed like any others; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, ranked

END, CAPACITY = 0, 2048


class Encoder:
    """Token ids of a text. The rank file of the same vocabulary gives the same ids, faster; it takes
    texts of Latin letters, and the vocabulary file itself takes any others and those that spell a special token."""

    #: The pattern before the merges of a byte-level BPE; special tokens have the form <|...|>.
    plain = re.compile("[\x00-ɏ‐-‧]*")

    def __init__(self, vocabulary: str, ranks: str | None):
        from tokenizers import Tokenizer

        self.slow, self.fast = Tokenizer.from_file(vocabulary), None
        if ranks:
            import public_tokenizers
            import tiktoken

            with open(ranks, "rb") as f:
                merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={})

    def __call__(self, text: str) -> np.ndarray:
        if self.fast is not None and "<|" not in text and self.plain.fullmatch(text):
            return np.array(self.fast.encode_ordinary(text), np.uint32)
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)


def pieces(
    docs: DataFrame,
    *,
    vocabulary: str,
    ranks: str | None = None,
    capacity: int = CAPACITY,
    end: int = END,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_ids: bool = False,
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, and the ids themselves if asked for."""
    schema = "id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = Encoder(vocabulary, ranks)
        for pdf in batches:
            out = []
            for doc, text in zip(pdf["id"], pdf["text"]):
                ids = np.append(encode(text), np.uint32(end)).astype("<u4")
                first = len(ids) % capacity or capacity
                for n, start in enumerate([0, *range(first, len(ids), capacity)]):
                    part = ids[start : first if n == 0 else start + capacity]
                    row = (doc, n, start, len(part), zlib.crc32(part.tobytes()))
                    out.append((*row, part.astype(np.int32)) if keep_ids else row)
            frame = pd.DataFrame(out, columns=[c.split()[0] for c in schema.split(", ")])
            frame["id"] = frame["id"].astype("Int64")
            yield frame

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInPandas(cut, schema)


def place_runs(counts: dict[int, int], capacity: int = CAPACITY) -> pd.DataFrame:
    """Supersteps over runs of equal lengths, the longest first. A row (length, rank, n, per, sequence,
    offset): the n pieces of this length from this rank on go, ``per`` to a sequence, to the sequences from
    ``sequence`` on, the first of each at ``offset``."""
    gaps: dict[int, list[tuple[int, int]]] = {}  # room left: runs of (first sequence, number of sequences)
    out, sequences = [], 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        rooms = [g for g in sorted(gaps) if g >= length]
        updates: list[tuple[int, int, int]] = []
        for room in [*rooms, capacity]:
            opened = room == capacity and not (room in gaps and gaps[room])
            per = room // length
            while left and (opened or gaps.get(room)):
                if opened:
                    start, number = sequences, -(-left // per)
                    sequences += number
                else:
                    start, number = gaps[room].pop()
                whole = min(number, left // per)
                if whole:
                    out.append((length, rank, whole * per, per, start, capacity - room))
                    updates.append((room - per * length, start, whole))
                    rank, left = rank + whole * per, left - whole * per
                if left and whole < number:  # the last sequence takes what is left
                    out.append((length, rank, left, left, start + whole, capacity - room))
                    updates.append((room - left * length, start + whole, 1))
                    rank, left, whole = rank + left, 0, whole + 1
                if whole < number:
                    updates.append((room, start + whole, number - whole))
            if not left:
                break
        for room, start, number in updates:
            if room:
                gaps.setdefault(room, []).append((start, number))
        for room in [g for g, runs in gaps.items() if not runs]:
            del gaps[room]
    return pd.DataFrame(out, columns=["length", "rank", "n", "per", "sequence", "offset"], dtype="int64")


def pack(docs: DataFrame, *, capacity: int = CAPACITY, id_col: str = "doc_id", **options) -> DataFrame:
    """The pieces with their sequence_id and their offset in it."""
    cut = materialize(pieces(docs, capacity=capacity, id_col=id_col, **options))
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # one row a length
    runs = place_runs(counts, capacity).sort_values(["length", "rank"])
    key = (runs["length"].to_numpy() << 44) + runs["rank"].to_numpy()
    sent = docs.sparkSession.sparkContext.broadcast((key, runs[["rank", "per", "sequence", "offset"]].to_numpy()))
    order = ["h", "id", "piece", "start"]
    numbered, _ = ranked(cut.withColumn("h", F.xxhash64("id", "piece")), ["length"], order)

    @F.pandas_udf("sequence_id long, offset long")
    def look_up(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        keys, table = sent.value
        size, at = length.to_numpy(np.int64), rank.to_numpy(np.int64) - 1
        first, per, sequence, offset = table[np.searchsorted(keys, (size << 44) + at, side="right") - 1].T
        return pd.DataFrame({"sequence_id": sequence + (at - first) // per, "offset": offset + (at - first) % per * size})

    names = [c for c in cut.columns if c != "id"]
    return numbered.withColumn("place", look_up("length", "rank")).select(F.col("id").alias(id_col), *names, "place.sequence_id", "place.offset")

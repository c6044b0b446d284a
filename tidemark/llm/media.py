"""Media columns with content-defined chunks.

A text becomes a payload (its UTF-8 bytes, padded with bytes 0 to a positive multiple of 64), the
payload the samples of an 8-bit mono WAV file. The stored form is that file: its header, the digest of all of it, and
its samples cut where a rolling gear hash over 32 bytes hits a mask, so equal stretches get equal chunks wherever
they stand. Chunks that occur once in the corpus lie with their document; chunks that occur more often are found by
joins on their digests and stored once, whatever number of rows, of equal ids or of no id, has them. The store (a
table in the shared folder) has

- ``local`` rows: a document all of whose chunks are its own,
- ``mixed`` rows: a text with chunks that occur elsewhere, in a copy of it too: header, list and its own chunks,
- ``copy`` rows: a document that has such a text,
- ``chunk`` rows: a shared chunk, of the text with the least digest among those that have it.

Reading takes the ordered chunk lists, fetches shared chunks by a join, checks every chunk and the file's digest,
and reads the samples back from the file; features are computed from these.

Hot chunks and hot texts: keys with more than a thousandth of the rows, of which there are less than a thousand, meet
their rows by a broadcast; all others by a shuffle (``hot_join``). Documents meet the list of shared texts, 16 bytes a row,
by a broadcast while it has at most ``broadcast_rows`` rows, beyond by a shuffle; the result is the same.

Defined results: null texts are empty texts; an empty text is 64 bytes 0; equal texts have equal
values; null ids are kept; ids must be numbers (others fail the cast to long); repeated rows give repeated results; other
columns are ignored, whatever their names; a very long text is one payload in one task; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import io
import wave
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import hot_join, materialize, slices

BLOCK, RATE = 64, 8000
LEAST, MASK_BITS, MOST = 512, 11, 8192
GEAR = np.random.RandomState(11).randint(0, 1 << 32, 256, dtype=np.uint64).astype(np.uint32)


def payload_of(text: str | None) -> bytes:
    data = (text or "").encode("utf-8", "replace")
    return data.ljust(max(BLOCK, -(-len(data) // BLOCK) * BLOCK), b"\0")


def cuts(payload: bytes) -> list[int]:
    """Ends of the chunks. The hash of a place is the sum of gear[byte] << age over the last 32 bytes,
    made by doubling: a sum over 2k bytes is two sums over k."""
    h = GEAR[np.frombuffer(payload, np.uint8)]
    for k in (1, 2, 4, 8, 16):
        if len(h) > k:
            h = np.concatenate([h[:k], h[k:] + (h[:-k] << np.uint32(k))])
    hits = (np.flatnonzero(h >> np.uint32(32 - MASK_BITS) == 0) + 1).tolist()
    out, start = [], 0
    for hit in [*hits, len(payload)]:
        while hit - start > MOST:
            start += MOST
            out.append(start)
        if hit - start >= LEAST or hit == len(payload) and hit > start:
            start = hit
            out.append(start)
    return out


def chunks(payload: bytes) -> list[bytes]:
    ends = cuts(payload)
    return [payload[a:b] for a, b in zip([0, *ends], ends)]


def digest(chunk: bytes) -> bytes:
    return hashlib.blake2b(chunk, digest_size=16).digest()


def encode(payload: bytes) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(RATE)
        w.writeframes(payload)
    return out.getvalue()


def decode(media: bytes) -> bytes:
    with wave.open(io.BytesIO(media), "rb") as r:
        return r.readframes(r.getnframes())


def describe(payload: bytes) -> str:
    """Level, zero crossings and the energy of eight frequency bands, over frames of 64 samples."""
    x = np.frombuffer(payload, np.uint8).astype(np.float32) - 128
    power = np.zeros(33)
    for i in range(0, len(x), 1 << 16):
        power += (np.abs(np.fft.rfft(x[i : i + (1 << 16)].reshape(-1, BLOCK), axis=1)) ** 2).sum(0)
    bands = np.log10(1 + power[1:].reshape(8, 4).sum(1) / (len(x) // BLOCK))
    crossings = np.count_nonzero(np.signbit(x[1:]) != np.signbit(x[:-1])) / len(x)
    level = float(np.sqrt(np.dot(x, x) / len(x)))
    return f"rms={level:.3f};zcr={crossings:.4f};bands=" + ",".join(f"{b:.3f}" for b in bands)


def _sources(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("id"), F.unhex(F.md5(text)).alias("text_digest"), text.alias("text"))


def chunk_lists(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_digest, chunks) of every document: the digests of its chunks in order."""

    def list_chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for part in slices(pdf["text"]):
                rows = pdf.iloc[part]
                found = [list(map(digest, chunks(payload_of(t)))) for t in rows["text"]]
                yield pd.DataFrame({"id": rows["id"], "text_digest": rows["text_digest"], "chunks": found})

    return materialize(_sources(docs, id_col, text_col).mapInPandas(list_chunks, "id long, text_digest binary, chunks array<binary>"))


def shared_chunks(lists: DataFrame) -> DataFrame:
    """(text_digest, shared, own) of the texts with chunks that occur more than once: positions of those chunks, and of
    those that this text stores."""
    texts = lists.groupBy("text_digest").agg(F.count("*").alias("copies"), F.first("chunks").alias("chunks"))
    places = materialize(texts.select("text_digest", "copies", F.posexplode("chunks").alias("seq", "chunk")))
    at = F.struct("text_digest", "seq")
    often = places.groupBy("chunk").agg(F.sum("copies").alias("times"), F.count("*").alias("n"), F.min(at).alias("owner")).where("times > 1")
    return materialize(
        hot_join(places, often, "chunk", times="n", total=places.count())
        .groupBy("text_digest")
        .agg(F.sort_array(F.collect_list("seq")).alias("shared"), F.sort_array(F.collect_list(F.when(at == F.col("owner"), F.col("seq")))).alias("own"))
    )


STORED = (
    "kind string, id long, text_digest binary, n_bytes long, header binary, media_digest binary, "
    "listed array<struct<digest:binary,length:int,shared:boolean>>, digest binary, data binary"
)
LISTED = "array<struct<digest:binary,length:int,shared:boolean>>"


def _write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Stored rows of (id, text_digest, text, shared, own)."""
    press, names = zstandard.ZstdCompressor(level=3), [c.split()[0] for c in STORED.split(", ")]
    for pdf in batches:
        for part in slices(pdf["text"]):
            out = []
            for doc, name, text, shared, own in pdf.iloc[part][["id", "text_digest", "text", "shared", "own"]].itertuples(index=False, name=None):
                payload, common = payload_of(text), set(() if shared is None else shared)
                media, parts = encode(payload), chunks(payload)
                listed = [{"digest": digest(p), "length": len(p), "shared": i in common} for i, p in enumerate(parts)]
                data = press.compress(b"".join(p for i, p in enumerate(parts) if i not in common))
                head = (media[: len(media) - len(payload)], hashlib.sha256(media).digest())
                out.append(("mixed" if common else "local", doc, name, len(text.encode("utf-8", "replace")), *head, listed, None, data))
                out += [("chunk", None, None, None, None, None, None, listed[i]["digest"], press.compress(parts[i])) for i in sorted(() if own is None else own)]
            yield pd.DataFrame(out, columns=names).astype({"id": "Int64", "n_bytes": "Int64"})


def store(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", broadcast_rows: int = 500_000) -> DataFrame:
    """Write the store and return it as read back."""
    lists = chunk_lists(docs, id_col=id_col, text_col=text_col)
    known = shared_chunks(lists)
    digests, rows, key = known.select("text_digest"), _sources(docs, id_col, text_col), ["text_digest"]
    if known.count() <= broadcast_rows:  # 16 bytes a row, about 100 in memory
        digests = F.broadcast(digests)
    else:  # a text may be a third of all rows: its rows are dealt by their place
        rows, key = rows.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(16)).cast("int")), ["text_digest", "salt"]
        digests = digests.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(15))))
    none = F.lit(None).cast("array<int>")
    local = rows.join(digests, key, "left_anti").select("id", "text_digest", "text", none.alias("shared"), none.alias("own"))
    # each text once: equal ones are reduced to one before they are dealt
    texts = rows.join(digests, key, "left_semi").groupBy("text_digest").agg(F.first("text").alias("text"))
    mixed = texts.join(known, "text_digest").select(F.lit(None).cast("long").alias("id"), "text_digest", "text", "shared", "own")
    empty = {c: F.lit(None).cast(t) for c, t in (x.split(" ", 1) for x in STORED.split(", "))}
    copies = lists.select("id", "text_digest").join(
        F.broadcast(known.select("text_digest")) if known.count() <= broadcast_rows else known.select("text_digest"), "text_digest", "left_semi"
    ).withColumns({**{c: v for c, v in empty.items() if c not in ("id", "text_digest")}, "kind": F.lit("copy")})
    whole = local.mapInPandas(_write, STORED).unionByName(mixed.mapInPandas(_write, STORED)).unionByName(copies)
    return materialize(whole, partition_by="kind", codec="uncompressed")  # it is compressed already


MEASURED = (
    "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
)


def measured(row: Column) -> Column:
    """The measures of a stored document: a struct of ``listed``, ``data`` and ``fetched``."""
    return F.pandas_udf(_measure, MEASURED)(row)


def _measure(frame: pd.DataFrame) -> pd.DataFrame:
    """Rebuild the file of each row from its header, its list (``listed``), its own chunks (``data``) and the fetched ones
    (``fetched``: seq, data), check every chunk and the file, read the samples back, and measure them."""
    unpress = zstandard.ZstdDecompressor()
    rows = []
    for header, name, listed, data, fetched in zip(frame["header"], frame["media_digest"], frame["listed"], frame["data"], frame["fetched"]):
        got = {int(f["seq"]): unpress.decompress(f["data"]) for f in fetched}
        own, at, parts = unpress.decompress(data), 0, [header]
        for i, c in enumerate(listed):
            if c["shared"]:
                part = got[i]
            else:
                part, at = own[at : at + c["length"]], at + c["length"]
            if digest(part) != bytes(c["digest"]):
                raise ValueError("a stored chunk differs from its digest")
            parts.append(part)
        media = b"".join(parts)
        if (found := hashlib.sha256(media)).digest() != bytes(name):
            raise ValueError("a rebuilt file differs from its digest")
        back = decode(media)
        rows.append((len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-BLOCK:]), len(media), found.hexdigest(), describe(back)))
    return pd.DataFrame(rows, columns=[c.split()[0] for c in MEASURED.split(", ")])


def read(stored: DataFrame) -> DataFrame:
    """One row per document: id, n_bytes, and the measures of its file as read from the store."""
    nothing = F.array().cast("array<struct<seq:int,data:binary>>")
    names = [c.split()[0] for c in MEASURED.split(", ")]
    local = (
        stored.where("kind = 'local'")
        .select("id", "n_bytes", measured(F.struct("header", "media_digest", "listed", "data", nothing.alias("fetched"))).alias("m"))
        .select("id", "n_bytes", *(f"m.{c}" for c in names))
    )
    mixed = stored.where("kind = 'mixed'")
    wanted = mixed.select("text_digest", F.posexplode("listed").alias("seq", "c")).where("c.shared").select(
        "text_digest", "seq", F.col("c.digest").alias("digest")
    )
    shared = stored.where("kind = 'chunk'").select("digest", "data").join(wanted.groupBy("digest").agg(F.count("*").alias("n")), "digest")
    fetched = hot_join(wanted, shared, "digest", times="n", total=wanted.count())
    chunks_of = fetched.groupBy("text_digest").agg(F.collect_list(F.struct("seq", "data")).alias("fetched"))
    whole = (
        mixed.select("text_digest", "n_bytes", "header", "media_digest", "listed", "data")
        .join(chunks_of, "text_digest")
        .select("text_digest", "n_bytes", measured(F.struct("header", "media_digest", "listed", "data", "fetched")).alias("m"))
        .select("text_digest", "n_bytes", *(f"m.{c}" for c in names))
    )
    rows = stored.where("kind = 'copy'").select("id", "text_digest")
    counted = materialize(whole.join(rows.groupBy("text_digest").agg(F.count("*").alias("n")), "text_digest"))
    other = hot_join(rows, counted, "text_digest", times="n", total=rows.count()).select("id", "n_bytes", *names)
    return local.unionByName(other)


def media(docs: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    return read(store(docs, id_col=id_col, **options)).withColumnRenamed("id", id_col)

"""Grouping of spelling variants by Bloom-guided neighbourhoods.

The vocabulary holds every word of the corpus that is long and frequent enough. Two words are near if one
inserted, deleted or replaced code point parts them. Near pairs are found without comparing words:
each word's edits are made in a task (deletions, and replacements by a larger letter, so that each
pair is met once, from its longer or its smaller word), and probed against Bloom filters of the
vocabulary. A filter is blocked (all bits of a key lie in one 64-bit block), and there is one for each
word length and part of the hash space, so an edit asks a single filter. Only positives are
shuffled, to an exact join with the vocabulary that removes the false ones.

Filters are broadcast in rounds of at most ``max_filter_bytes``, whatever the vocabulary's size. Words are
hashed by their code points as a polynomial, so the hash of an edit follows from its word's in one step, also
for very long words.

Defined results: a null text has no words; a null id is spelled as no characters before the colon; repeated rows count again;
an empty table gives no rows; other columns are ignored. Among near words of equal count the smallest in code-point order
is the form. Forms grow at least ``ratio`` times at each step, so the way to a root never turns round.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialize

#: Letters of words after A-Z are lower-cased, the alphabet of all edits.
LETTERS = [*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]
LOWER = bytes(range(256)).lower()  # of bytes: changes A-Z alone
BITS_PER_WORD, PROBES, PART = 20, 5, 1 << 20
HELD, EDITS = 200_000, 1 << 20


def spelled(doc_id, text: str, least: int, noise: int) -> Counter:
    """Counts of a document's words of at least ``least`` letters, after the contract's deletions."""
    found: Counter = Counter()
    prefix = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in Counter(re.findall(f"[a-zÀ-ÿ]{{{least},}}", text.encode("utf-8", "replace").translate(LOWER).decode())).items():
        h = zlib.crc32(run.encode(), prefix)
        if noise and h % noise == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        if len(run) >= least:
            found[run] += n
    return found


def counted(held: Counter) -> pd.DataFrame:
    return pd.DataFrame({"word": pd.Series(list(held), dtype=object), "n": list(held.values())})


def vocabulary(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least: int = 6, min_count: int = 5, noise: int = 199
) -> DataFrame:
    """(word, n) of all words with at least ``least`` code points and ``min_count`` occurrences. Tasks count what they
    read, in tables of bounded size, before anything is shuffled."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter = Counter()
        for pdf in batches:
            for doc_id, text in zip(pdf["id"], pdf["text"]):
                for word, n in spelled(doc_id, text, least, noise).items():
                    held[word] += n
                if len(held) > HELD:
                    yield counted(held)
                    held.clear()
        yield counted(held)

    rows = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    counts = rows.mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= min_count)


# -- hashes -------------------------------------------------------------------------------------


BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def powers(n: int) -> np.ndarray:
    out = np.full(n, BASE, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def scattered(h: np.ndarray) -> np.ndarray:
    """All bits of a hash depend on all bits of its polynomial."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def letters_of(words: list[str], length: int) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), length).astype(np.uint64)


def polynomials(codes: np.ndarray) -> np.ndarray:
    return (codes * powers(codes.shape[1])).sum(axis=1, dtype=np.uint64)


def bits_of(h: np.ndarray) -> np.ndarray:
    """The bits of a key in its block."""
    mask = np.zeros(len(h), np.uint64)
    for k in range(PROBES):
        mask |= np.uint64(1) << ((h >> np.uint64(6 * k)) & np.uint64(63))
    return mask


def block_of(h: np.ndarray, blocks: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)


def part_of(h: np.ndarray, parts: int) -> np.ndarray:
    # a hash of its own: blocks and bits have used the others
    return ((scattered(h ^ np.uint64(BASE)) >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


def by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    """(length, indexes) of the words of each length."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for length in np.unique(lengths):
        yield int(length), np.flatnonzero(lengths == length)


def word_hash(words: list[str]) -> np.ndarray:
    out = np.zeros(len(words), np.uint64)
    for length, at in by_length(words):
        step = max(1, EDITS // length)
        for i in range(0, len(at), step):
            some = at[i : i + step]
            out[some] = scattered(polynomials(letters_of([words[j] for j in some], length)))
    return out


# -- filters ------------------------------------------------------------------------------------


def parts_by_length(words: DataFrame) -> dict[int, tuple[int, int]]:
    """length -> (words, parts); one row a length comes to the driver."""
    rows = words.groupBy(F.length("word").alias("length")).count().collect()
    return {r["length"]: (r["count"], -(-r["count"] // PART)) for r in rows}


def filters(words: DataFrame, shards: dict[int, tuple[int, int]]) -> DataFrame:
    """(length, part, filter): the blocked Bloom filter of each shard, each of about ``PART`` words at most."""

    def with_hash(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            h, length = word_hash(list(pdf["word"])), pdf["word"].str.len().to_numpy(np.int64)
            parts = np.array([shards[n][1] for n in length], np.int64)
            yield pd.DataFrame({"length": length, "part": part_of(h, 1 if not len(parts) else parts.astype(np.uint64)).astype(np.int64), "h": h.view(np.int64)})

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        h = pdf["h"].to_numpy(np.int64).view(np.uint64)
        blocks = np.zeros(max(1, len(h) * BITS_PER_WORD // 64), np.uint64)
        np.bitwise_or.at(blocks, block_of(h, len(blocks)).astype(np.int64), bits_of(h))
        return pd.DataFrame({"length": pdf["length"].iloc[:1], "part": pdf["part"].iloc[:1], "filter": [blocks.tobytes()]})

    hashed = words.select("word").mapInPandas(with_hash, "length long, part long, h long")
    return hashed.groupBy("length", "part").applyInPandas(build, "length long, part long, filter binary")


def rounds(shards: dict[int, tuple[int, int]], max_bytes: int) -> list[list[tuple[int, int]]]:
    """The shards in rounds whose filters have at most ``max_bytes`` together, or one shard."""
    out, held = [[]], 0
    for length in sorted(shards):
        n, parts = shards[length]
        size = n * BITS_PER_WORD // 8 // parts + 8
        for part in range(parts):
            if out[-1] and held + size > max_bytes:
                out.append([])
                held = 0
            out[-1].append((length, part))
            held += size
    return out if out[-1] else []


def edits(codes: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(length, word, place, letter or -1, hash) of deletions and of replacements by larger letters, in stretches of places.
    Of equal neighbours only the last is deleted: the other deletions give the same word."""
    m, length = codes.shape
    power = powers(length)
    terms = codes * power
    before = np.zeros((m, length + 1), np.uint64)
    np.cumsum(terms, axis=1, out=before[:, 1:])
    total = before[:, -1:]
    gone = before[:, :-1] + (total - before[:, 1:]) * np.uint64(INVERSE)
    told = np.ones((m, length), bool)
    told[:, :-1] = codes[:, :-1] != codes[:, 1:]
    word, place = np.nonzero(told)
    yield length - 1, word, place, np.full(len(word), -1), scattered(gone[word, place])
    alphabet = np.array(LETTERS, np.uint64)
    step = max(1, EDITS // (m * len(alphabet)))
    for start in range(0, length, step):
        here = codes[:, start : start + step]
        word, place, letter = np.nonzero(alphabet[None, None, :] > here[:, :, None])
        place = place + start
        h = total[word, 0] + (alphabet[letter] - codes[word, place]) * power[place]
        yield length, word, place, alphabet[letter].astype(np.int64), scattered(h)


def near_pairs(words: DataFrame, *, max_filter_bytes: int = 64 << 20) -> DataFrame:
    """(a, n_a, b, n_b): each pair of near words of (word, n) once."""
    shards = parts_by_length(words)
    made = materialize(filters(words, shards)) if shards else None
    context = words.sparkSession.sparkContext
    found = None
    for held in rounds(shards, max_filter_bytes):
        order = lambda length, part: length * (1 << 32) + part  # noqa: E731  a round is a stretch of this order
        some = made.where(order(F.col("length"), F.col("part")).between(order(*held[0]), order(*held[-1])))
        # bounded by max_filter_bytes
        sent = context.broadcast({(r["length"], r["part"]): bytes(r["filter"]) for r in some.collect()})

        def probe(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            asked = {k: np.frombuffer(v, np.uint64) for k, v in sent.value.items()}
            for pdf in batches:
                every, counts = list(pdf["word"]), pdf["n"].to_numpy(np.int64)
                for length, at in by_length(every):
                    step = max(1, EDITS // (length * len(LETTERS)))
                    for i in range(0, len(at), step):
                        some = [every[j] for j in at[i : i + step]]
                        for goal, word, place, letter, h in edits(letters_of(some, length)):
                            if goal not in shards:
                                continue
                            part, hit = part_of(h, shards[goal][1]).astype(np.int64), np.zeros(len(h), bool)
                            for p in range(shards[goal][1]):
                                if (blocks := asked.get((goal, p))) is not None:
                                    mine = np.flatnonzero(part == p)
                                    mask = bits_of(h[mine])
                                    hit[mine] = (blocks[block_of(h[mine], len(blocks)).astype(np.int64)] & mask) == mask
                            rows = np.flatnonzero(hit)
                            if len(rows):
                                texts = [some[word[j]] for j in rows]
                                edited = [
                                    t[: place[j]] + ("" if letter[j] < 0 else chr(letter[j])) + t[place[j] + 1 :] for t, j in zip(texts, rows)
                                ]
                                yield pd.DataFrame({"a": pd.Series(texts, dtype=object), "n_a": counts[at[i : i + step]][word[rows]], "b": pd.Series(edited, dtype=object)})

        positives = words.select("word", "n").mapInPandas(probe, "a string, n_a long, b string")
        found = positives if found is None else found.unionByName(positives)
    exact = words.select(F.col("word").alias("b"), F.col("n").alias("n_b"))
    if found is None:
        return exact.select(F.col("b").alias("a"), F.col("n_b").alias("n_a"), "b", "n_b").limit(0)
    return found.join(exact, "b").select("a", "n_a", "b", "n_b")


# -- forms and roots ----------------------------------------------------------------------------


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of all words with a form, from (word, form): each round doubles the steps that are taken."""
    at = materialize(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = materialize(at.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        at = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return at


def variants(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: int = 6,
    min_count: int = 5,
    noise: int = 199,
    ratio: int = 5,
    max_filter_bytes: int = 64 << 20,
) -> DataFrame:
    """One row per word: word, n, n_near, form, form_n, root."""
    words = materialize(vocabulary(docs, id_col=id_col, text_col=text_col, least=least, min_count=min_count, noise=noise))
    pairs = near_pairs(words, max_filter_bytes=max_filter_bytes)
    side = lambda a, b: F.struct(F.col(a).alias("word"), (-F.col(f"n_{b}")).alias("less"), F.col(b).alias("other"))
    both = pairs.select(F.explode(F.array(side("a", "b"), side("b", "a"))).alias("s")).select("s.*")
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct("less", "other")).alias("best"))
    named = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.col("best.other").alias("other"), (-F.col("best.less")).alias("other_n")
    )
    fits = F.col("other_n") >= ratio * F.col("n")
    named = materialize(named.select("word", "n", "n_near", F.when(fits, F.col("other")).alias("form"), F.when(fits, F.col("other_n")).alias("form_n")))
    ends = roots(named.where(F.col("form").isNotNull()))
    return named.join(ends, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))

"""A trie of conversation prefixes, with totals of its subtrees by time-forward processing.

A node is a distinct sequence of first turns. Its key is a sum of digests of (place, role, text) over its turns, so the keys of all prefixes are
prefix sums along a conversation, and a conversation of any length is summed in blocks. Counts of members and the least
member are one aggregation by key.

Totals of subtrees go from the leaves to the root:

1. Nodes above more than ``shard_rows`` rows form the top of the tree (a node's parent has no fewer rows than the node). What hangs below it are
   subtrees of at most ``shard_rows`` rows; each goes to a shard as a whole, by its root's key.
2. Within a shard the nodes are sorted externally by reverse level order (Spark's sort, which spills). A node takes its
   children's totals from a priority queue, adds its own, and sends them forward to its parent's place in the order. The
   queue has bounded memory: beyond it, sorted runs are spilled to a scratch file of the task and merged as they are read.
3. Roots of shards hand their totals on to the top, summed by parent, and the top is processed in the same way.

A shard's task has a bounded number of nodes; the top has about (rows / shard_rows) * depth nodes, streamed through one task.

Defined results: a null role or text is empty; turns are ordered by turn (null first), then role and text, so ties and repeated
rows have one order; rows without a conversation id belong to no conversation and are left out; a conversation without turns after
rebuilding is a member of the root; an empty table has no nodes; the remainder of a
negative id is negative, as in SQL; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import tempfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import hot_join, materialize
from tidemark.sources.shared import block_starts, in_blocks

SHARD_ROWS, QUEUE = 50_000, 200_000
PARTS = ("g0", "g1", "g2", "g3")


# -- conversations, rebuilt ----------------------------------------------------------------------


def digest_parts(place: Column, role: Column, text: Column) -> list[Column]:
    """Four numbers of 32 bits whose sums can't overflow."""
    h = F.md5(F.concat(place.cast("string"), F.lit("|"), F.length(role).cast("string"), F.lit("|"), role, text))
    return [F.conv(F.substring(h, 1 + 8 * i, 8), 16, 10).cast("long").alias(g) for i, g in enumerate(PARTS)]


def key_of(parts: list[Column]) -> Column:
    return F.unhex(F.md5(F.concat_ws(",", *(p.cast("string") for p in parts))))


def prefixes(talks: DataFrame, *, group: int = 5, heads: int = 9) -> tuple[DataFrame, DataFrame]:
    """(rows, conversations). A row is a conversation's prefix: conv, d, key, parent (keys), bytes of the last text, below (prefixes from
    here on), last. Conversations: conv and its length after rebuilding."""
    turns = talks.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    order = ["turn", "role", "text"]
    sorted_turns = in_blocks(turns, ["conv", *order])
    counts = sorted_turns.groupBy("conv", "block").agg(F.count("*").alias("n"))
    convs = counts.groupBy("conv").agg(F.sum("n").alias("n"))
    convs = convs.withColumn("source", F.col("conv") - F.col("conv") % group).withColumn("h", F.crc32(F.col("conv").cast("string")) % heads)
    given = convs.select(F.col("conv").alias("source"), F.col("n").alias("n_source"))
    convs = convs.join(given, "source", "left").withColumn("kept", F.least("h", F.coalesce("n_source", F.lit(0))))
    convs = materialize(convs.withColumn("len", F.col("kept") + F.greatest(F.col("n") - F.col("h"), F.lit(0))))

    # what a conversation's rows need of it comes by (conversation, block), so a long one is joined in parts
    known = block_starts(counts, ["conv"], ["n"]).join(convs.select("conv", "h", "kept", "len"), "conv")
    within = Window.partitionBy("conv", "block").orderBy(*order)
    placed = sorted_turns.withColumn("row", F.row_number().over(within)).join(known, ["conv", "block"])
    placed = materialize(placed.select("conv", "block", "role", "text", (F.col("start_n") + F.col("row")).alias("k"), "h", "kept", "len"))

    first = placed.where((F.col("conv") % group == 0) & (F.col("k") < heads)).select(F.col("conv").alias("source"), F.col("k").alias("d"), "role", "text")
    lent = convs.select("conv", "source", "kept", "len").join(first, "source").where("d <= kept")
    d = F.col("kept") + F.col("k") - F.col("h")
    own = placed.where("k > h").select("conv", "block", d.alias("d"), "len", F.octet_length("text").alias("bytes"), *digest_parts(d, F.col("role"), F.col("text")))
    lent = lent.select("conv", "d", "len", F.octet_length("text").alias("bytes"), *digest_parts(F.col("d"), F.col("role"), F.col("text")))
    own, lent = materialize(own), materialize(lent)

    sums = [F.sum(g).alias(g) for g in PARTS]
    in_conv = Window.partitionBy("conv").orderBy("d")  # at most heads - 1 rows
    in_block = Window.partitionBy("conv", "block").orderBy("d")
    lent_rows = lent.select("conv", "d", "len", "bytes", *PARTS, *(F.sum(g).over(in_conv).alias(f"s_{g}") for g in PARTS))
    base = lent.groupBy("conv").agg(*(F.sum(g).alias(f"b_{g}") for g in PARTS))
    starts = block_starts(own.groupBy("conv", "block").agg(*sums), ["conv"], list(PARTS)).join(base, "conv", "left")
    starts = starts.select("conv", "block", *((F.col(f"start_{g}") + F.coalesce(f"b_{g}", F.lit(0))).alias(f"t_{g}") for g in PARTS))
    own_rows = own.select("*", *(F.sum(g).over(in_block).alias(f"r_{g}") for g in PARTS)).join(starts, ["conv", "block"])
    own_rows = own_rows.select("conv", "d", "len", "bytes", *PARTS, *((F.col(f"r_{g}") + F.col(f"t_{g}")).alias(f"s_{g}") for g in PARTS))
    rows = lent_rows.unionByName(own_rows).select(
        "conv", "d", "bytes", (F.col("len") - F.col("d") + 1).alias("below"), (F.col("d") == F.col("len")).alias("last"),
        key_of([F.col(f"s_{g}") for g in PARTS]).alias("key"), key_of([F.col(f"s_{g}") - F.col(g) for g in PARTS]).alias("parent"),
    )
    return materialize(rows), convs.select("conv", "len")


# -- time-forward processing ---------------------------------------------------------------------


class SpillingQueue:
    """Messages (order, children, leaves, saved) in the order of their first field; those of one place are summed as they are taken. At
    most ``limit`` are in memory, further ones in sorted runs in a scratch file that lives as long as the queue."""

    def __init__(self, limit: int = QUEUE, chunk: int = 4096):
        self.limit, self.chunk, self.heap, self.file = limit, chunk, [], None
        self.runs: list[tuple] = []  # a heap of (head, run number, the rest of the chunk, offsets of further chunks)
        self.spilled = 0

    def push(self, message: tuple) -> None:
        heapq.heappush(self.heap, message)
        if len(self.heap) > self.limit:
            self._spill()

    def _spill(self) -> None:
        self.file = self.file or tempfile.TemporaryFile()
        self.heap.sort()
        self.file.seek(0, 2)
        offsets = []
        for i in range(0, len(self.heap), self.chunk):
            offsets.append(self.file.tell())
            pickle.dump(self.heap[i : i + self.chunk][::-1], self.file)
        self.spilled, self.heap = self.spilled + 1, []
        self._open(self.spilled, [], offsets[::-1])

    def _open(self, number: int, rest: list, offsets: list) -> None:
        if not rest and offsets:
            self.file.seek(offsets.pop())
            rest = pickle.load(self.file)
        if rest:
            heapq.heappush(self.runs, (rest.pop(), number, rest, offsets))

    def take(self, place: tuple) -> tuple[int, int, int]:
        """Sums of all messages to a place; the places are asked in their order."""
        children = leaves = saved = 0
        while self.heap and self.heap[0][0] == place:
            _, c, n, s = heapq.heappop(self.heap)
            children, leaves, saved = children + c, leaves + n, saved + s
        while self.runs and self.runs[0][0][0] == place:
            (_, c, n, s), number, rest, offsets = heapq.heappop(self.runs)
            children, leaves, saved = children + c, leaves + n, saved + s
            self._open(number, rest, offsets)
        return children, leaves, saved


TOTALS = "key binary, parent binary, top boolean, n_children long, n_leaves long, saved long"


def forward(limit: int):
    """For nodes by reverse level order (depth descending, then key): totals of their subtrees. ``top`` nodes send to no one here;
    what they get from elsewhere stands in children, leaves and saved."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        queue = SpillingQueue(limit)
        for pdf in batches:
            out = []
            for r in pdf.itertuples():
                key = bytes(r.key)
                c, n, s = queue.take((-r.depth, key))
                c, s = c + r.children, s + r.saved + r.own
                n = n + r.leaves or 1
                if not r.top:
                    queue.push(((1 - r.depth, bytes(r.parent)), 1, n, s))
                out.append((key, r.parent, r.top, c, n, s))
            yield pd.DataFrame(out, columns=[x.split()[0] for x in TOTALS.split(", ")])

    return run


def subtree_totals(nodes: DataFrame, rows: DataFrame, *, shard_rows: int = SHARD_ROWS, queue: int = QUEUE) -> DataFrame:
    """(key, n_children, n_leaves, saved) of nodes (key, parent, depth, conv_id, weight, own)."""
    heavy = nodes.where((F.col("weight") > shard_rows) | (F.col("depth") == 0))
    n_heavy, n_all = nodes.agg(F.sum(((F.col("weight") > shard_rows) | (F.col("depth") == 0)).cast("long")), F.count("*")).first()
    marks = heavy.select("key", F.lit(True).alias("heavy"))
    marks = F.broadcast(marks) if (n_heavy or 0) <= 100_000 else marks
    # where a conversation leaves the top, its subtree begins
    light_rows = rows.join(marks, "key", "left").where("heavy IS NULL")
    leaves_top = light_rows.groupBy(F.col("conv").alias("conv_id")).agg(F.min(F.struct("d", "key")).alias("at"))
    light = nodes.where((F.col("weight") <= shard_rows) & (F.col("depth") > 0)).join(leaves_top, "conv_id")
    zero = F.lit(0).cast("long")
    light = light.select("key", "parent", "depth", "own", F.col("at.key").alias("root"), (F.col("at.key") == F.col("key")).alias("top"), *(zero.alias(c) for c in ("children", "leaves", "saved")))
    reverse = [F.desc("depth"), F.asc("key")]
    shards = max(1, -(-(n_all or 0) // shard_rows))
    below = materialize(light.repartition(shards, "root").sortWithinPartitions(*reverse).drop("root").mapInPandas(forward(queue), TOTALS))
    handed = below.where("top").groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved").alias("saved"))
    top = heavy.join(handed, "key", "left").select(
        "key", "parent", "depth", "own", (F.col("depth") == 0).alias("top"), *(F.coalesce(c, zero).alias(c) for c in ("children", "leaves", "saved"))
    )
    above = top.repartition(1).sortWithinPartitions(*reverse).mapInPandas(forward(queue), TOTALS)
    return materialize(below.unionByName(above).select("key", "n_children", "n_leaves", "saved"))


# -- ends ---------------------------------------------------------------------------------------


def end_digests(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256) of (key, conv): the ids of a node in order. Blocks of the sorted ids are joined to texts first; only a node that
    lies in several blocks has them streamed through one digest, as a digest is sequential."""
    blocks = in_blocks(ends, ["key", "conv"])
    texts = materialize(blocks.groupBy("key", "block").agg(F.array_join(F.array_sort(F.collect_list("conv")).cast("array<string>"), ",").alias("ids")))
    per = texts.groupBy("key").agg(F.count("*").alias("parts"))
    several = F.broadcast(per.where("parts > 1").select("key"))  # fewer than there are blocks

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, state = None, None
        for pdf in batches:
            out = []
            for r in pdf.itertuples():
                if key != bytes(r.key):
                    if state is not None:
                        out.append((key, state.hexdigest()))
                    key, state = bytes(r.key), hashlib.sha256()
                else:
                    state.update(b",")
                state.update(r.ids.encode())
            yield pd.DataFrame(out, columns=["key", "ends_sha256"])
        if state is not None:
            yield pd.DataFrame([(key, state.hexdigest())], columns=["key", "ends_sha256"])

    cut = texts.join(several, "key", "left_semi").repartition("key").sortWithinPartitions("key", "block")
    whole = texts.join(several, "key", "left_anti").select("key", F.sha2("ids", 256).alias("ends_sha256"))
    return whole.unionByName(cut.mapInPandas(stream, "key binary, ends_sha256 string"))


def trie(talks: DataFrame, *, group: int = 5, heads: int = 9, shard_rows: int = SHARD_ROWS, queue: int = QUEUE) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    rows, convs = prefixes(talks, group=group, heads=heads)
    root_key, none = key_of([F.lit(0)] * len(PARTS)), F.lit(None)
    inner = rows.groupBy("key").agg(
        F.min("conv").alias("conv_id"), F.min("d").cast("long").alias("depth"), F.min("parent").alias("parent"), F.count("*").alias("n_convs"),
        F.sum("below").alias("weight"), F.min("bytes").cast("long").alias("bytes"),
    )
    root = convs.agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"), F.sum(F.col("len") + 1).alias("weight")).where("n_convs > 0")
    root = root.select(root_key.alias("key"), "conv_id", F.lit(0).cast("long").alias("depth"), none.cast("binary").alias("parent"), "n_convs", "weight", F.lit(0).cast("long").alias("bytes"))
    nodes = materialize(inner.unionByName(root).withColumn("own", (F.col("n_convs") - 1) * F.col("bytes")))
    totals = subtree_totals(nodes, rows, shard_rows=shard_rows, queue=queue)
    ends = rows.where("last").select("key", "conv").unionByName(convs.where("len = 0").select(root_key.alias("key"), "conv"))
    full = materialize(nodes.join(totals, "key").join(end_digests(ends), "key", "left"))
    count = full.count()
    parents = full.where("n_children > 0").select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("times"))
    out = hot_join(full.where("depth > 0"), parents, "parent", times="times", total=count)
    out = out.unionByName(full.where("depth = 0").withColumn("parent_conv_id", none.cast("long")))
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

from tidemark.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, key string, depth int"


def plain(rows):
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of all nodes."""
    talks = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            talks[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in talks.items()}
    members = defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 9
        built = own.get(c - int(math.fmod(c, 5)), [])[:h] + own[c][h:]
        for d in range(len(built) + 1):
            members[tuple(built[:d])].append((c, d == len(built)))
    children, leaves, saved = Counter(p[:-1] for p in members if p), Counter(), Counter()
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = leaves[p] or 1
        saved[p] += (len(members[p]) - 1) * (len(p[-1][1].encode()) if p else 0)
        if p:
            leaves[p[:-1]] += leaves[p]
            saved[p[:-1]] += saved[p]
    return sorted(
        (m[0][0], len(p), members[p[:-1]][0][0] if p else -1, len(m), children[p], leaves[p], saved[p],
         hashlib.sha256(",".join(str(c) for c, end in m if end).encode()).hexdigest())
        for p, m in members.items()
    )


def result(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    columns = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted(tuple(-1 if r[c] is None else r[c] for c in columns) for r in trie.trie(df, **options).collect())


def talks(n, seed, hot=0):
    r = random.Random(seed)
    rows = []
    for c in range(n):
        for turn in range(r.choice([1, 2, 3, 5, 12])):
            rows.append((c, turn, r.choice(["user", "assistant"]), "hello" if c < hot else r.choice(["a", "bé", "c", f"own {c}"]), "k", 1))
    return rows


def edges():
    return [
        (101, None, None, None, "k", 1), (101, 0, "user", "first", "k", 1), (101, 0, "user", "first", "k", 1), (101, 0, "bot", "", "k", 1),
        (None, 0, "user", "nobody", "k", 1), (7, 0, "user", "absent source", "k", 1), (-3, 0, "user", "x", "k", 1), (-5, 1, "user", "y", "k", 1),
    ]


def test_equals_brute_force(spark):
    rows = talks(60, 1, hot=25) + edges()
    assert result(spark, rows) == plain(rows)


def test_shards_and_the_spilling_queue(spark):
    rows = talks(80, 2, hot=40)
    assert result(spark, rows, shard_rows=10, queue=3) == plain(rows)


def test_one_long_conversation_and_copies(spark):
    rows = [(0, t, "user", f"turn {t % 3}", "k", 1) for t in range(300)] + [(c, t, "user", "same", "k", 1) for c in range(5, 305, 5) for t in range(3)]
    assert result(spark, rows, shard_rows=50, queue=10) == plain(rows)


def test_no_turns(spark):
    assert result(spark, []) == [] and result(spark, [(None, 1, "user", "x", "k", 1)]) == []


def test_queue_takes_messages_in_order_and_sums_them():
    r, queue, sent = random.Random(3), trie.SpillingQueue(limit=50, chunk=7), defaultdict(lambda: [0, 0, 0])
    for _ in range(2000):
        place = (-r.randrange(9), bytes([r.randrange(40)]))
        queue.push((place, 1, 2, place[1][0]))
        for i, x in enumerate((1, 2, place[1][0])):
            sent[place][i] += x
    assert queue.spilled > 10 and len(queue.heap) <= 50
    assert all(queue.take(p) == tuple(sent[p]) for p in sorted(sent)) and not queue.heap and not queue.runs

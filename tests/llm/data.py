"""Small documents with every case that the operators name a result for."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, h string, row string, label int, score double"
WORDS = [a + b + c for a in ("ba", "ko", "ri", "tu", "me") for b in ("lan", "per", "sit", "vor") for c in ("da", "ne", "sh", "ck", "m")]


def prose(n, seed, lines=9):
    r = random.Random(seed)
    words = [r.choice(WORDS) for _ in range(n)]
    return "\n".join(" ".join(words[i : i + lines]) for i in range(0, n, lines))


def edited(text, seed, rate):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) if r.random() < rate else w for w in text.split(" "))


def row(i, text, source="a", lang="xx"):
    return (i, text, lang, source, None if text is None else len(text), 7, "h", "r", 1, 0.5)


def edge_rows():
    base = prose(300, 1)
    return [
        row(1, base), row(2, base), row(3, base, None), row(4, edited(base, 2, 0.01), "b"), row(5, prose(300, 3), "b"),
        row(6, None, "b"), row(7, "", "c"), row(8, "  \n ", "c"), row(9, "one two", "c"), row(10, "one two", None),
        row(None, prose(80, 4), "a"), row(None, None, None, None), row(11, prose(40_000, 5), "c"), row(12, prose(60, 6), "a"), row(12, prose(60, 6), "a"),
        row(13, "é" * 700 + " ß\U0001f600 " + prose(20, 7), "ü"),
    ]


def frame(spark, rows=None, parts=3):
    return spark.createDataFrame(edge_rows() if rows is None else rows, SCHEMA).repartition(parts)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")

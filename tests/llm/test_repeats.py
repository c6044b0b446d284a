import hashlib
from collections import Counter

import pytest

from tests.llm.data import empty, frame, prose, row
from tidemark.llm import repeats

LENGTH = 200


def plain(rows):
    texts = [(r[0], (r[1] or "").encode()) for r in rows]
    starts = Counter(t[i : i + LENGTH] for _, t in texts for i in range(len(t) - LENGTH + 1))
    out = []
    for doc, t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - LENGTH + 1):
            if starts[t[i : i + LENGTH]] > 1:
                gone[i : i + LENGTH] = b"\1" * LENGTH
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((doc, len(t), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(t, gone) if not g)).hexdigest()))
    return sorted(out, key=repr)


def result(df, **options):
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    return sorted((tuple(r[c] for c in columns) for r in repeats.remove_repeats(df, **options).collect()), key=repr)


def planted():
    passage, exact = prose(45, 91).replace("\n", " ")[:260], prose(30, 92).replace("\n", " ")[:200]
    assert len(exact) == 200
    rows = [row(i, prose(40 + 7 * i, 200 + i) + f" {i} " + passage[i % 7 : 230 + i] + prose(30, 300 + i)) for i in range(12)]
    rows += [row(20, exact), row(21, "x" + exact + "y"), row(22, exact[:199]), row(23, "ab" * 400), row(24, "é" * 400), row(25, passage), row(26, passage), row(27, "q" * 200), row(28, "z" * 201)]
    rows += [row(30, prose(80, 7) + prose(90, 8)), row(31, prose(70, 9) + "! " + prose(90, 8)), row(32, prose(80, 7)[5:]), row(None, passage + "?"), row(33, None), row(34, ""), row(34, "")]
    return rows


def test_equals_brute_force(spark):
    rows = planted()
    assert result(frame(spark, rows)) == plain(rows)


def test_long_texts_are_cut_into_pieces_and_joined(spark):
    rows = planted() + [row(40, prose(900, 41)), row(41, prose(300, 42) + prose(900, 41)[777:4000] + prose(400, 43))]
    assert result(frame(spark, rows), block_bytes=1000) == plain(rows)


def test_a_third_of_all_rows_is_one_text(spark):
    rows = [row(i, prose(60, 5) if i % 3 == 0 else prose(60, 50 + i)) for i in range(90)]
    assert result(frame(spark, rows, 5), block_bytes=4000) == plain(rows)


def test_edges(spark):
    assert result(empty(spark)) == []
    got = result(frame(spark, [row(1, None), row(None, ""), row(2, "short")]))
    none = hashlib.sha256(b"").hexdigest()
    assert [r[1:4] for r in got] == [(0, 0, 0), (5, 0, 0), (0, 0, 0)] and got[0][4] == got[2][4] == none


def test_the_cover_meets_all_differences():
    assert len({(a - b) % repeats.COVER for a in repeats.SAMPLE for b in repeats.SAMPLE}) == repeats.COVER
    with pytest.raises(ValueError):
        repeats.remove_repeats(None, length=100)


def test_the_texts_are_not_shuffled_to_meet_answers(spark):
    texts = repeats.stored(repeats.blocks(frame(spark), "doc_id", "text", LENGTH, 1 << 20), 4)
    answers = spark.createDataFrame([(1, "a")], "block long, answers string").repartition(3)
    plan = texts.join(answers.hint("shuffle_hash"), "block", "left")._jdf.queryExecution().executedPlan().toString()
    left = plan[plan.index("Hash") :]
    assert "Bucketed: true" in plan and left.count("Exchange hashpartitioning") <= 1

import random

import pytest

from reelgauge.sources import pages as P


def build(spark, *rows):
    return spark.createDataFrame(list(rows), "playlist string, token string, next string").repartition(3)


def got(frame):
    return {(r.playlist, r.token): (r.position, r.status, r.missing, r.copies) for r in frame.collect()}


def test_shuffled_missing_and_repeated_pages(spark):
    whole = [("a", None if i == 0 else f"t{i}", f"t{i + 1}" if i < 9 else None) for i in range(10)]
    cut = [("b", None if i == 0 else f"t{i}", f"t{i + 1}" if i < 9 else None) for i in range(10) if i not in (4, 7)]
    found = got(P.chains(build(spark, *whole, *whole[3:5], *cut, ("c", "", None), ("c", None, None), (None, "x", "y"))))
    assert {k: v for k, v in found.items() if k[0] == "a"} == {
        ("a", "" if i == 0 else f"t{i}"): (i, "complete", None, 2 if i in (3, 4) else 1) for i in range(10)
    }
    assert [found["b", t][:3] for t in ("", "t1", "t2", "t3")] == [(i, "cut", "t4") for i in range(4)]
    assert [found["b", t][:3] for t in ("t5", "t6")] == [(0, "orphan", "t7"), (1, "orphan", "t7")]
    assert [found["b", t][:3] for t in ("t8", "t9")] == [(0, "orphan", None), (1, "orphan", None)]
    assert found["c", ""] == (0, "complete", None, 2) and len(found) == 19


def test_loops_and_contradictions(spark):
    loop = [("a", None, "t1"), ("a", "t1", "t2"), ("a", "t2", "t1"), ("b", None, None), ("b", "x", "x")]
    found = got(P.chains(build(spark, *loop, ("c", None, "t2"), ("c", None, "t1"), ("c", "t1", None), ("c", "t2", None))))
    assert {found["a", t] for t in ("", "t1", "t2")} == {(None, "loop", None, 1)}
    assert found["b", ""][1] == "complete" and found["b", "x"][1] == "loop"
    assert found["c", ""] == (0, "complete", None, 2) and found["c", "t1"][:2] == (1, "complete") and found["c", "t2"][1] == "orphan"


@pytest.mark.parametrize("length", [1, 2, 3, 8, 300])
def test_rounds_grow_with_the_logarithm(spark, length, monkeypatch):
    written = []
    settle = P.settle
    monkeypatch.setattr(P, "settle", lambda df, label: written.append(label) or settle(df, label))
    rows = [("a", None if i == 0 else f"t{i}", f"t{i + 1}" if i + 1 < length else None) for i in range(length)]
    random.Random(1).shuffle(rows)
    found = got(P.chains(build(spark, *rows)))
    assert sorted(v[0] for v in found.values()) == list(range(length))
    assert written.count("chains") <= 1 + (length - 1).bit_length() + 1


def test_no_pages(spark):
    assert P.chains(build(spark, ("a", None, None)).filter("false")).collect() == []

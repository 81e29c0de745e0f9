import numpy as np
import pytest
from pyspark.sql import functions as F

from oracle.compare import connect
from reelgauge.llm import neighbours as N
from reelgauge.llm.queries import QUERIES


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)


def plain_nearest(rows, asks, k=10):
    """rows: (vec_id, vector); [(query_id, [(vec_id, score), ...])] over all other rows of the same length."""
    rows = [(i, np.array(v, np.float64)) for i, v in rows if usable(v)]
    found = []
    for at, (q, v) in enumerate(rows):
        if q is None or not asks(q):
            continue
        near = [(float(np.sqrt(((v - w) ** 2).sum())), i is None, i) for j, (i, w) in enumerate(rows) if j != at and len(w) == len(v)]
        near.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        found.append((q, [(i, round(d, 9)) for d, _, i in near[:k]]))
    return sorted(found, key=str)


def got(frame):
    assert frame.columns == ["query_id", "rank", "vec_id", "score"]
    rows, lists = sorted(map(tuple, frame.collect()), key=lambda x: (x[0], x[1])), {}
    for q, rank, i, score in rows:
        lists.setdefault(q, []).append((rank, i, round(score, 9)))
    return lists


def recall(lists, expected):
    hits = sum(len({x[1:] for x in lists.get(q, [])} & set(near)) for q, near in expected)
    return hits / sum(len(near) for _, near in expected)


def test_query_reaches_the_recall(spark):
    folder = "/root/testdata/sf0.1"
    rows = connect(folder).execute("SELECT vec_id, embedding FROM embeddings").fetchall()
    expected = plain_nearest(rows, lambda i: i % 100 == 0)
    lists = got(QUERIES["op13_nearest_neighbours"](spark, folder))
    assert set(lists) == {q for q, _ in expected}
    assert all([x[0] for x in v] == list(range(1, 11)) and [x[2] for x in v] == sorted(x[2] for x in v) for v in lists.values())
    found = recall(lists, expected)
    print("recall", found)
    assert found >= 0.9


@pytest.mark.parametrize("shape", ["clusters", "uniform"])
def test_recall_and_pruning(spark, shape):
    rng = np.random.default_rng(4)
    if shape == "clusters":
        vectors = np.repeat(rng.standard_normal((60, 32)), 50, axis=0) + 0.1 * rng.standard_normal((3000, 32))
    else:
        vectors = rng.random((3000, 8))
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(vectors)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    tables, probes = N.choose(rng.permutation(vectors), 0.95)
    sets = N.probe_sets(tables[0].lines.shape[1], 2 * probes)
    seen = np.zeros((200, 3000), bool)
    for one in tables:
        bucket = one.bucket(vectors)
        for i, keys in enumerate(one.probes(vectors[:200], sets, probes)):
            seen[i] |= np.isin(bucket, keys)
    print(shape, len(tables), probes, seen.mean())
    assert seen.mean() < (0.1 if shape == "clusters" else 0.5)
    expected = plain_nearest(rows, lambda i: i % 20 == 0)
    for options in ({}, {"block": 7, "shard": 100}):
        assert recall(got(N.nearest(frame, F.col("vec_id") % 20 == 0, **options)), expected) >= 0.9


def test_probes_come_in_order_of_their_score():
    rng = np.random.default_rng(5)
    vectors = rng.standard_normal((20, 6))
    (one,) = N.tables_of(vectors, 4, 1.5, 1)
    keys = one.probes(vectors, N.probe_sets(4, 400), 81)  # all 3 ** 4 neighbours
    place = one.at(vectors)
    low = place - np.floor(place)
    for i in range(20):
        scores = {}
        for moves in np.ndindex(3, 3, 3, 3):
            step = np.array(moves) - 1
            cost = np.where(step < 0, low[i] ** 2, np.where(step > 0, (1 - low[i]) ** 2, 0)).sum()
            scores[int(one.keys(np.floor(place[i]) + step))] = cost
        assert len(scores) == 81 and set(keys[i].tolist()) == set(scores)
        order = [scores[x] for x in keys[i].tolist()]
        assert np.allclose(order, sorted(order)) and keys[i][0] == one.bucket(vectors[i : i + 1])[0]


def test_odd_rows_ties_and_repeats(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (0, [1.0, 0.0]), (100, [0.0, 1.0]), (200, [1.0, 0.0]), (3, [1.0, 1.0]), (2, [1.0, -1.0]), (None, [1.0, 1.0]),
        (4, [-1.0, 0.0]), (5, None), (300, []), (6, [0.0, -0.0]), (400, [0.0, 0.0]), (7, [nan, 1.0]), (8, [inf, 1.0]), (9, [None, 1.0]),
        (500, [1.0, 2.0, 3.0]), (10, [1.0, 2.0, 4.0]), (600, [5.0]), *[(i, [0.5, 0.5]) for i in range(20, 45)], (700, [0.5, 0.5]),
    ]
    names = "vec_id long, embedding array<double>, score int, query string, id long, row long, h1 string"
    frame = spark.createDataFrame([(*x, 1, "q", 2, 3, "h") for x in rows], names).repartition(4)
    found = got(N.nearest(frame, F.col("vec_id") % 100 == 0, block=1))
    expected = plain_nearest(rows, lambda i: i % 100 == 0)
    assert set(found) == {q for q, near in expected if near} == {0, 100, 200, 500, 700}
    for q, near in expected:
        if q not in (0, 600):
            assert [x[1:] for x in found[q]] == near
    assert sorted(x[1:] for x in found[0]) == sorted(sum((near for q, near in expected if q == 0), []))


def test_fewer_candidates_and_empty_table(spark):
    rows = [(0, [1.0, 2.0]), (1, [2.0, 2.0]), (2, [9.0, 9.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert [x[1] for x in got(N.nearest(frame, F.col("vec_id") == 0))[0]] == [1, 2]
    assert N.nearest(frame.filter("vec_id > 5"), F.col("vec_id") == 0).collect() == []
    assert N.nearest(frame, F.col("vec_id") == 77).collect() == []


def test_a_third_of_the_rows_are_near_copies(spark):
    rng = np.random.default_rng(6)
    hot = rng.standard_normal(16)
    vectors = np.concatenate([hot + 1e-3 * rng.standard_normal((700, 16)), np.tile(hot, (300, 1)), rng.standard_normal((2000, 16))])
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    expected = plain_nearest(rows, lambda i: i % 50 == 0)
    assert recall(got(N.nearest(frame, F.col("vec_id") % 50 == 0, block=16, shard=64)), expected) >= 0.9

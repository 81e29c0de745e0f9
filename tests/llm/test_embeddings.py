import numpy as np
import pytest

from reelgauge.llm import embeddings as E
from reelgauge.llm.shared import smallest_root

SCHEMA = "vec_id long, embedding array<float>, label int, node long"


def plain(rows, limit=E.LIMIT):
    def usable(v, label):
        return label is not None and v is not None and None not in v and np.isfinite(v).all() and any(v)

    n, links, ends = len(rows), [0] * len(rows), []
    for i in range(n):
        for j in range(i):
            (_, a, la, _), (_, b, lb, _) = rows[i], rows[j]
            if la == lb and usable(a, la) and usable(b, lb) and len(a) == len(b):
                a, b = np.array(a, np.float64), np.array(b, np.float64)
                if a @ b / np.sqrt(a @ a) / np.sqrt(b @ b) >= limit:
                    links[i] += 1
                    links[j] += 1
                    ends.append((i, j))
    at = np.array(ends, np.int64).reshape(-1, 2)
    root = smallest_root(n, at[:, 0], at[:, 1])
    least = {r: min((x[0] for x, q in zip(rows, root, strict=True) if q == r and x[0] is not None), default=None) for r in set(root)}
    found = [(x[0], k, least[r], x[0] is not None and x[0] == least[r]) for x, k, r in zip(rows, links, root, strict=True)]
    return sorted(found, key=str)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((30, 32))
    rows = []
    for i in range(900):
        v = centres[i % 30] + rng.standard_normal(32) * (0.02 if i % 3 else 0.13)
        rows.append((i, np.float32(v).tolist(), i % 30 % 4, 1))
    rows += [(900 + i, rows[0][1], rows[0][2], 1) for i in range(20)]
    return rows


@pytest.mark.parametrize("unit", [E.UNIT, 7])
def test_equals_brute_force(spark, vectors, unit):
    got = sorted(map(tuple, E.near_duplicates(spark.createDataFrame(vectors, SCHEMA), unit=unit).collect()), key=str)
    want = plain(vectors)
    links = sum(x[1] for x in want)
    assert sum(x[1] for x in got) >= 0.99 * links and links > 4000
    assert all(a[1] <= b[1] for a, b in zip(got, want, strict=True))
    assert sum(a[2] == b[2] for a, b in zip(got, want, strict=True)) >= 0.99 * len(want)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1, 1), (2, [1.0, 0.0], 1, 1), (2, [2.0, 0.0], 1, 1), (3, [1.0, -0.0], 1, 1), (None, [1.0, 0.0], 1, 1),
        (4, [1.0, 0.0], None, 1), (5, None, 1, 1), (6, [], 1, 1), (7, [0.0, 0.0], 1, 1), (8, [1.0, None], 1, 1), (9, [nan, 1.0], 1, 1),
        (10, [inf, 1.0], 1, 1), (11, [1.0, 0.0], 2, 1), (12, [1.0, 0.0, 0.0], 1, 1), (13, [3e38, 3e38], 5, 1), (None, [0.0, 1.0], 7, 1),
    ]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert sorted(map(tuple, E.near_duplicates(frame).collect()), key=str) == plain(rows)
    assert E.near_duplicates(frame.filter("vec_id < 0")).count() == 0


def test_rotation_is_orthogonal_and_codes_are_balanced():
    x = np.random.default_rng(0).standard_normal((2000, 16))
    r = E.iterative_quantisation(x - x.mean(0), 0)
    assert np.allclose(r @ r.T, np.eye(16))
    assert abs(((x - x.mean(0)) @ r > 0).mean(0) - 0.5).max() < 0.06


def test_recall_with_a_large_common_component():
    rng = np.random.default_rng(5)
    common = np.eye(64)[0]
    raw = 0.9 * common + np.sqrt(1 - 0.9**2) * np.linalg.qr(rng.standard_normal((64, 64)))[0][rng.integers(0, 64, 3000)]
    raw += 0.05 * rng.standard_normal(raw.shape)
    vectors = raw / np.linalg.norm(raw, axis=1, keepdims=True)
    codes = E._Codes(vectors[:1500], 0.98)
    bits, tables = E.tables_for([codes], 13, 0.98, E.RECALL)
    codes.need(bits * tables)
    how = E.Plan(tables, bits, {64: (codes.mean, codes.rotations)})
    others = vectors[1500:]  # none of them was learned from
    aside = rng.standard_normal(others.shape)
    aside -= (aside * others).sum(1, keepdims=True) * others
    aside /= np.linalg.norm(aside, axis=1, keepdims=True)
    near = 0.981 * others + np.sqrt(1 - 0.981**2) * aside
    assert (how.keys(others) == how.keys(near)).any(1).mean() >= 0.995
    # What the angle alone asks for finds too few.
    meet = (1 - np.arccos(0.98) / np.pi) ** 13
    old = E.Plan(int(np.ceil(np.log(1 - E.RECALL) / np.log(1 - meet))), 13, how.rotations)
    old_recall = (old.keys(others) == old.keys(near)).any(1).mean()
    print(bits, tables, old.tables, old_recall)
    assert old_recall < 0.99

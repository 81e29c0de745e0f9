import re

import numpy as np
import xxhash

from reelgauge.llm import simhash as S
from reelgauge.llm.shared import components, smallest_root


def plain_fingerprint(text):
    text = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
    words = [x for x in re.split(r"[\x20\x09-\x0D]+", text) if x]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    rows = sorted(rows, key=lambda x: (x[0] is None, x[0] or 0))
    prints = np.array([plain_fingerprint(x[1]) for x in rows], np.uint64)
    a, b = np.nonzero(np.bitwise_count(prints[:, None] ^ prints[None]) <= 3)
    root = smallest_root(len(rows), a, b)
    return sorted(((r[0], f"{p:016x}", rows[k][0]) for r, p, k in zip(rows, prints, root, strict=True)), key=str)


def test_equals_brute_force(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = plain_components(documents.select("doc_id", "text").collect())
    for unit in (S.UNIT, 4):
        assert sorted(map(tuple, S.near_duplicates(documents, unit=unit).collect()), key=str) == want


def test_odd_rows(odd, none):
    want = plain_components(odd.select("doc_id", "text").collect())
    assert sorted(map(tuple, S.near_duplicates(odd).collect()), key=str) == want
    assert S.near_duplicates(none).count() == 0 and S.one_of_each_group(none).count() == 0
    kept = S.one_of_each_group(odd)
    assert kept.columns == odd.columns
    assert sorted(x.doc_id for x in kept.collect() if x.doc_id) == sorted({x[2] for x in want if x[2]})


def test_index_finds_all_pairs_and_no_others():
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 2**63, 40, dtype=np.uint64)
    values = centres[rng.integers(0, 40, 3000)]
    for _ in range(4):
        values = values ^ (np.uint64(1) << rng.integers(0, 64, 3000, dtype=np.uint64))
    a, b = S.GrayIndex(values).near(values, 3)
    want = np.argwhere(np.bitwise_count(values[:, None] ^ values[None]) <= 3)
    assert sorted(zip(a.tolist(), b.tolist(), strict=True)) == sorted(map(tuple, want.tolist()))


def test_many_trees_at_once():
    rng = np.random.default_rng(8)
    tree = np.sort(rng.integers(0, 300, 4000) ** 2 // 300)
    values = (rng.integers(0, 6, 4000, dtype=np.uint64) << np.uint64(62)) ^ rng.integers(0, 2**8, 4000, dtype=np.uint64)
    index = S.GrayIndex(values, tree)
    a, b = index.near(values, 3, tree)
    want = np.argwhere((np.bitwise_count(values[:, None] ^ values[None]) <= 3) & (tree[:, None] == tree[None]))
    assert sorted(zip(a.tolist(), b.tolist(), strict=True)) == sorted(map(tuple, want.tolist()))
    none = index.near(values[:5], 3, np.full(5, 10**6))
    assert len(none[0]) == 0 and len(S.GrayIndex(values[:0]).near(values[:3], 3)[0]) == 0


def test_links_of_units_and_slices():
    rng = np.random.default_rng(9)
    unit = np.sort(rng.integers(0, 40, 1200))
    values = rng.integers(0, 2**12, 1200, dtype=np.uint64) ^ (unit.astype(np.uint64) << np.uint64(40))
    one = unit % 2 == 0
    side = np.where(one, 0, rng.integers(0, 2, 1200))
    side[unit == 3] = 1  # nothing to meet
    met = (unit[:, None] == unit[None]) & (one[:, None] | (side[:, None] != side[None]))
    want = smallest_root(1200, *np.nonzero(met & (np.bitwise_count(values[:, None] ^ values[None]) <= 3)))
    for at_once in (500, S.AT_ONCE):
        S.AT_ONCE, before = at_once, S.AT_ONCE
        try:
            a, b = S.link_places(values, unit, side, one, 3)
        finally:
            S.AT_ONCE = before
        assert np.array_equal(smallest_root(1200, a, b), want)


def test_groups_are_left_out_by_their_shared_bits():
    """Few members of a tree are compared, in a large bucket and in the buckets of the given documents."""
    rng = np.random.default_rng(4)
    values = rng.integers(0, 2**48, 4096, dtype=np.uint64)
    index = S.GrayIndex(values)
    index.near(values, 3)
    assert index.compared < 0.25 * len(values) ** 2


def test_registered_query_goes_through_the_index(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    prints = np.unique(np.array([S.fingerprint(x.text) for x in documents.select("text").collect()], np.uint64))
    pairs = compared = 0
    for shift in range(0, 64, 16):
        quarter = (prints >> np.uint64(shift) & np.uint64(65535)).astype(np.int64)
        order = np.argsort(quarter, kind="stable")
        index = S.GrayIndex(prints[order], quarter[order])
        index.near(prints, 3, quarter)
        compared += index.compared
        pairs += len(prints) ** 2
    assert len(prints) <= compared < 0.01 * pairs


def test_dense_groups_in_slices(spark):
    rng = np.random.default_rng(5)
    values = np.unique(np.uint64(12345) ^ (np.uint64(1) << rng.integers(0, 64, 500, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 500, dtype=np.uint64)))
    frame = spark.createDataFrame([(int(x),) for x in values.view(np.int64)], "fp long")
    a, b = np.nonzero(np.bitwise_count(values[:, None] ^ values[None]) <= 3)
    parts = len(set(smallest_root(len(values), a, b).tolist()))
    found = components(S.links(frame, unit=16)).collect()
    assert len({x.component for x in found}) + len(values) - len(found) == parts


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 260)]
    star = [(1, i) for i in range(1000, 1500)] + [(5, 1), (7, 7)]
    rows = spark.createDataFrame(chain + star, "a long, b long").repartition(8)
    found = {x.node: x.component for x in components(rows).collect()}
    assert {found[i] for i in range(100, 261)} == {100}
    assert {found[i] for i in [1, 5, *range(1000, 1500)]} == {1} and 7 not in found
    assert components(rows.filter("a < 0")).count() == 0

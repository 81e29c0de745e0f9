import random
import re
import zlib
from collections import Counter

import numpy as np

from reelgauge.llm import spelling as S


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_vocabulary(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(x.lower() if "A" <= x <= "Z" else x for x in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def plain_variants(counts):
    forms, rows = {}, []
    for w, n in counts.items():
        close = [v for v in counts if near(w, v)]
        best = min(close, key=lambda v: (-counts[v], v), default=None)
        forms[w] = best if best and counts[best] >= 2 * n else None
        rows.append((w, n, len(close)))
    found = []
    for w, n, n_near in rows:
        root = w
        while forms[root]:
            root = forms[root]
        found.append((w, forms[w], root, n, n_near, counts[forms[w]] if forms[w] else None))
    return sorted(found)


def got(frame):
    assert frame.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(map(tuple, frame.collect()))


def test_index_finds_all_words_one_error_away():
    rng = random.Random(1)
    for trial in range(60):
        letters = "abc" if trial % 2 else "abcdé"
        words = sorted({"".join(rng.choices(letters, k=rng.randint(1, 6))) for _ in range(rng.randint(1, 60))})
        asked = sorted({"".join(rng.choices(letters + "x", k=rng.randint(1, 6))) for _ in range(20)})
        exact = [len(q) - len(q) // 2 for q in asked]
        query, word = S.SuffixRanks(words).one_error(asked, np.array(exact))
        expected = {
            (i, j)
            for i, (q, m) in enumerate(zip(asked, exact, strict=True))
            for j, w in enumerate(words)
            if w.endswith(q[len(q) - m :]) and near(q[: len(q) - m], w[: len(w) - m])
        }
        assert set(zip(query.tolist(), word.tolist(), strict=True)) == expected
        assert len(query) == len(expected)


def test_vocabulary_and_variants_equal_plain_version(spark):
    rng = random.Random(2)
    stems = ["".join(rng.choices("abdé", k=rng.randint(4, 7))) for _ in range(60)]
    texts = [" ".join(rng.choices(stems, weights=[1 / (i + 1) for i in range(60)], k=120)).title() for _ in range(60)]
    rows = [(i if i % 7 else None, x) for i, x in enumerate(texts)] + [(1, None), (2, ""), (None, None), (3, "Été-1 ÷abcde× a")]
    frame = spark.createDataFrame([(*x, "w", 3, "t") for x in rows], "doc_id long, text string, word string, n int, t string")
    counts = plain_vocabulary(rows)
    assert {x.word: x.n for x in S.vocabulary(frame.repartition(4)).collect()} == counts
    expected = plain_variants(counts)
    assert sum(x[1] is not None for x in expected) > 3
    for chars in (40, S.SHARD_CHARS):
        assert got(S.variants(S.vocabulary(frame), chars)) == expected


def test_dense_vocabulary_in_many_shards(spark):
    rng = random.Random(3)
    words = {"".join(rng.choices("ab", k=rng.randint(5, 9))): rng.choice([3, 3, 6, 7, 12, 24, 50]) for _ in range(600)}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    expected = plain_variants(words)
    assert max(x[4] for x in expected) > 5 and any(x[1] and x[1] != x[2] for x in expected)
    assert got(S.variants(frame, 300)) == expected


def test_long_words_repeated_rows_and_empty_table(spark):
    long = "ab" * 50_000
    rows = [(1, f"{long} {long}x {long}"), (1, f"{long} {long}x {long}"), (2, f"{long}x"), (2, "words Words wordy wordy wordy wOrds")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(S.variants(S.vocabulary(frame))) == plain_variants(plain_vocabulary(rows))
    assert got(S.variants(S.vocabulary(frame.filter("doc_id > 5")))) == []
    many = spark.createDataFrame([(5, "letter " * 400_000)], "doc_id long, text string")
    assert sum(x[3] for x in got(S.variants(S.vocabulary(many)))) == 400_000


def test_roots_follow_long_chains(spark):
    links = [(f"w{i}", f"w{i + 1}") for i in range(40)] + [("x", "w7")]
    roots = {x.word: x.root for x in S.followed(spark.createDataFrame(links, "word string, form string")).collect()}
    assert roots == {**{f"w{i}": "w40" for i in range(40)}, "x": "w40"}

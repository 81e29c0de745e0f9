import numpy as np
import pytest
from pyspark.sql import functions as F

from reelgauge.llm import mixing as M


def expected_shares(rows):
    held = np.array([x.rate * x.n_tokens for x in rows])
    return held @ np.array([x.p for x in rows]) / sum(x.n_tokens for x in rows)


def test_expected_tokens_match_the_targets(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = M.mix(documents).collect()
    assert len(rows) == documents.count() and all(x.rate >= 0 for x in rows)
    assert np.allclose([sum(x.p) for x in rows], 1)
    shares = expected_shares(rows)
    assert np.allclose(shares, 1 / len(shares), atol=2e-4)
    words = {x.doc_id: len(x.text.split()) for x in documents.collect()}
    assert all(x.n_tokens == words[x.id] for x in rows)


def test_weights_and_soft_members(spark):
    rows = [(i, ("red blue green " if i % 4 else "one two three ") * 20, (None if i % 5 == 0 else "colour" if i % 4 else "number")) for i in range(400)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = M.mix(documents, {"colour": 1.0, "number": 3.0}).collect()
    assert np.allclose(expected_shares(found), [0.25, 0.75], atol=2e-4)
    for x in found:  # unlabelled rows follow their words
        assert int(np.argmax(x.p)) == (0 if x.id % 4 else 1)
    names = [x.source for x in M.mixed(documents, {"colour": 1.0, "number": 3.0}).collect()]
    assert names.count("number") > names.count("colour")


def test_copies_follow_rates(spark):
    rows = spark.createDataFrame([(None, "x", i, -i, 2.25) for i in range(4000)], "id long, source string, h1 long, h2 long, rate double")
    copies = [x[0] for x in rows.select(M.copies()).collect()]
    assert set(copies) == {2, 3} and abs(copies.count(3) / 4000 - 0.25) < 0.03


def test_odd_rows(odd, none):
    rows = M.mix(odd).collect()
    assert len(rows) == odd.count()
    assert {x.n_tokens for x in rows if x.id in (4, 5, 6)} == {0}
    assert M.mix(none).count() == 0 and M.mixed(none).count() == 0
    assert M.mixed(odd).columns == odd.columns
    assert {x.rate for x in M.mix(odd.drop("source").withColumnRenamed("first", "source").filter("source IS NULL")).collect()} == {1.0}


def plain_gradient(p, tokens, target, close):
    """Unaccelerated projected gradient steps with all documents in memory."""
    start, rate = tokens @ p, np.ones(len(tokens))
    while np.abs((tokens * rate) @ p - target).max() > close:
        rate = np.maximum(0, rate - p @ (((tokens * rate) @ p - target) / start))
    return rate


def test_targets_are_met_with_many_sources_and_unlabelled_rows(spark):
    sources, trust = 20, M.TRUST
    prior = np.append(1 / 3, np.full(sources - 1, 2 / 3 / (sources - 1)))
    p = np.concatenate([(1 - trust) * prior + trust * np.eye(sources), [prior]])
    tokens = np.rint(np.append(0.7 * prior, 0.3) * 1e9)
    target = np.full(sources, tokens.sum() / sources)
    rows = [(i, int(n), q.tolist()) for i, (n, q) in enumerate(zip(tokens, p, strict=True))]
    members = spark.createDataFrame(rows, "id long, n_tokens long, p array<double>")
    close = M.CLOSE * tokens.sum()
    found, error, rounds = M.descend(members, tokens @ p, target, close)
    rate = np.array([x.rate for x in found.orderBy("id").collect()])
    assert error <= close and rounds <= 40 and rate.min() >= 0
    assert np.abs((tokens * rate) @ p - target).max() == pytest.approx(error)
    assert np.abs((tokens * plain_gradient(p, tokens, target, close)) @ p - target).max() <= close


def test_rates_of_the_first_step_are_those_of_plain_gradient(spark):
    rng = np.random.default_rng(2)
    p, tokens = rng.dirichlet([0.2, 0.3, 0.5], 300), rng.integers(1, 500, 300)
    members = spark.createDataFrame(
        [(i, int(n), q.tolist()) for i, (n, q) in enumerate(zip(tokens, p, strict=True))], "id long, n_tokens long, p array<double>"
    )
    start = tokens @ p
    target = start * [0.2, 1.0, 3.0]
    found = M._stepped(members.selectExpr("*", "1D AS rate", "1D AS lead"), (start - target) / start, 0.5).orderBy("id").collect()
    want = np.maximum(0, 1 - p @ ((start - target) / start))
    assert np.allclose([x.rate for x in found], want) and np.allclose([x.lead for x in found], want + 0.5 * (want - 1))


def test_rates_do_not_depend_on_file_splits(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("doc_id", F.expr("if(doc_id % 3 = 0, NULL, doc_id)"))
    found = []
    for parts in (1, 16):
        rows = M.mix(documents.repartition(parts, "text"), train_docs=10).collect()
        found.append(sorted((x.h1, x.h2, x.id or -1, str(x.source), round(x.rate, 6), x.copies) for x in rows))
    assert found[0] == found[1]


def test_targets_are_met_without_ids(spark):
    rows = [(None, f"word{i % 7} other{i} " * (5 + i % 9), "x" if i % 3 else "y") for i in range(3000)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sums = M.mixed(documents, {"x": 1.0, "y": 2.0}, trust=1.0).groupBy("source").agg(F.sum(F.size(F.split(F.trim("text"), " "))))
    held = dict(map(tuple, sums.collect()))
    assert abs(held["y"] / held["x"] - 2) < 0.1


def test_targets_that_cannot_be_met_are_told(spark):
    rows = [(1, "a b c", "x"), (2, "a b c", "x"), (3, "a b c", "y")]
    members, names = M.memberships(spark.createDataFrame(rows, "doc_id long, text string, source string"), trust=0.5)
    with pytest.warns(UserWarning, match="cannot be met"):
        M.rates(members, names, {"x": 1.0, "y": 99.0}).collect()

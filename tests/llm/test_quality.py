import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from reelgauge.llm import quality as Q


def plain(text):
    text = text or ""
    words = [x for x in re.split(r"[\x20\x09-\x0D]+", text) if x]
    windows = list(zip(words, words[1:], words[2:], strict=False))
    counts, covered = Counter(windows), set()
    for i, x in enumerate(windows):
        if counts[x] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    return (
        n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
        n < 50 or 100 * len(covered) > 50 * n,
    )


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_counts_equal_plain_python(spark, sf_dir, odd):
    extra = [(1, "a b c a b c a b c"), (2, "x x x x x"), (3, "a b c d a b c e f a b c"), (4, "é# ü\n\n é# ü\n<𝒳>"), (5, "one")]
    more = spark.createDataFrame(extra, "doc_id long, text string").withColumn("lang", F.lit("en"))
    for documents in (spark.read.parquet(f"{sf_dir}/documents.parquet"), odd, more):
        got = Q.measured(documents).withColumn("base", Q.base_failed()).select("doc_id", *COLUMNS, "base").collect()
        want = [(x.doc_id, *plain(x.text)) for x in documents.select("doc_id", "text").collect()]
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


@pytest.fixture(scope="module")
def rated(spark):
    rows = []
    for i in range(3000):
        bad = i % 10 == 0
        language = "big" if i < 2900 else "small"
        rows.append((i, " ".join(f"word{j}{i}" + ("***" if bad else "") for j in range(60)), language, int(not bad)))
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, quality int")
    return Q.rated(table.drop("quality"), table.select("doc_id", "quality")).cache()


def test_certified_rules_reject_bad_documents_only(rated):
    big = rated.filter("stratum = 'big'").collect()
    assert all(x.kept == (x.doc_id % 10 != 0) for x in big)
    assert {tuple(x.rejected_by) for x in big if not x.kept} <= {("symbols_per_word",), ("long_words",), ("symbols_per_word", "long_words")}


def test_few_labels_certify_nothing(rated):
    assert rated.filter("stratum = 'small' AND kept").count() == 100


def test_cutoffs_keep_the_risk(spark):
    from math import comb

    # 2000 good documents, 12 of them above every cutoff of the symbol rule.
    rows = [(i, "x", 100, 500, 400 if i < 12 or i >= 2000 else 0, 5, 0, 0, int(i < 2000)) for i in range(2200)]
    names = "doc_id long, stratum string, n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long, quality int"
    table = spark.createDataFrame(rows, names)
    counts, labels = table.drop("quality"), table.select("doc_id", "quality")
    tests = sum(len(g) for _, g in Q.RULES.values())
    doubt = sum(comb(2000, k) * 0.01**k * 0.99 ** (2000 - k) for k in range(13))
    found = Q.certified(counts, labels).collect()
    assert bool(found) == (doubt <= 0.05 / tests)
    assert Q.certified(counts, labels, risk=0.2).select("rule").collect() == [("symbols_per_word",)]


def test_empty_tables(none, odd, spark):
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    assert Q.rated(none, labels).count() == 0
    assert Q.rated(odd, labels.filter("1 = 0")).count() == odd.count()
    assert Q.rated(odd, labels).filter("kept").count() == 1  # all but the long text fail the base rule

"""Quality rules with risk-controlled thresholds.

Each rule rejects texts whose measure lies above a cutoff. Labelled documents
decide the cutoff: in each stratum (language) and for every cutoff of a fixed
grid, the good documents it would reject are counted, and a cutoff is certified
if an exact binomial test rules out a false rejection rate above the rule's
share of ``RISK``, at ``DOUBT`` divided by the number of all tests (rules x
cutoffs x strata). With probability 1 - DOUBT no certified cutoff rejects more
good documents than allowed, in any stratum. Of the certified cutoffs the one
that rejects most bad documents, each good one weighed ``PENALTY`` fold, is
used; a stratum with too few labels has none, and its documents stay.

Everything runs in DataFrame functions.

Defined results: null and empty texts have no words and fail the base rule; a
null language is a stratum of its own; labels without quality or without
document count for nothing, several labels of a document count each; repeated
rows are rated each by itself; empty tables give no rows (documents) or no
cutoffs (labels); further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelgauge.functions.distributions import binomial_at_most
from reelgauge.llm.shared import settle, table

RISK = 0.05  # of the good documents of a stratum, over all rules
DOUBT = 0.05
PENALTY = 10.0
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

#: Measure of each rule and its grid of cutoffs; above the cutoff a text is rejected.
RULES: dict[str, tuple[str, list[float]]] = {
    "symbols_per_word": ("n_symbols / n_words", [0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0]),
    "long_words": ("word_chars / n_words", [6.0, 7.0, 8.0, 9.0, 10.0, 12.0, 14.0, 16.0, 20.0, 30.0]),
    "short_words": ("- word_chars / n_words", [-4.0, -3.5, -3.0, -2.5, -2.0, -1.5]),
    "repeated_lines": ("n_dup_lines / n_lines", [0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.4, 0.5, 0.6, 0.75]),
    "repeated_words": ("n_repeat_words / n_words", [0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.45]),
}


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _windows(words: Column) -> Column:
    """A hash of each run of three words."""
    places = F.when(F.size(words) >= 3, F.sequence(F.lit(0), F.size(words) - 3))
    hashes = F.transform(places, lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    return F.coalesce(hashes, F.array().cast("array<bigint>"))


def _repeated(windows: Column) -> Column:
    """Words that lie in a run found twice or more."""

    def again(ordered: Column) -> Column:
        def place(x: Column, j: Column) -> Column:
            # Beyond an end there is nothing, and nothing equals nothing.
            beside = (F.get(ordered, j - 1)["h"] == x["h"]) | (F.get(ordered, j + 1)["h"] == x["h"])
            return F.when(beside, x["i"])

        return F.sort_array(F.array_compact(F.transform(ordered, place)))

    def covered(state: Column, start: Column) -> Column:
        return F.struct(
            (state["n"] + F.least(F.lit(3), start - state["last"])).alias("n"), start.alias("last")
        )

    pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    starts = _let(pairs, again)
    none = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
    counted = F.aggregate(starts, none, covered)["n"]
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), 0).otherwise(counted)


def measured(documents: DataFrame, stratum: str = "lang") -> DataFrame:
    """The counts of every whole text, with doc_id and stratum; written to the shared folder."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    split = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col(stratum).cast("string").alias("stratum"), text.alias("text")
    ).withColumns({
        "words": F.filter(F.split("text", "[ \\t-\\r]+"), lambda x: x != ""),
        "lines": F.filter(F.split("text", "\n"), lambda x: x.rlike("[^ \\t-\\r]")),
    })
    counted = split.select(
        "doc_id",
        "stratum",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.translate("text", BLANKS, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _windows(F.col("words")).alias("windows"),
    )
    counted = counted.withColumn("n_repeat_words", _repeated(F.col("windows")).cast("long")).drop("windows")
    # Written, so that no later filter drags the counting of words into its own expressions.
    return settle(counted, "quality-counts")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _measure(name: str) -> Column:
    whole = "n_lines" if name == "repeated_lines" else "n_words"
    return F.when(F.col(whole) > 0, F.expr(RULES[name][0]))


def certified(counts: DataFrame, labels: DataFrame, risk: float = RISK, doubt: float = DOUBT) -> DataFrame:
    """(stratum, rule, cutoff): the cutoffs in use, from ``measured`` counts and labels (doc_id, quality)."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    known = known.filter("doc_id IS NOT NULL AND quality IS NOT NULL")
    labelled = counts.filter(~base_failed()).join(known, "doc_id")
    # How many cutoffs of its rule a document lies above.
    def passed(name: str, grid: list[float]) -> Column:
        return F.size(F.filter(F.array(*map(F.lit, grid)), lambda cutoff: _measure(name) > cutoff))

    above = [
        F.struct(F.lit(name).alias("rule"), passed(name, grid).alias("above")) for name, (_, grid) in RULES.items()
    ]
    good = F.col("quality") == 1
    counted = settle(
        labelled.select("stratum", "quality", F.inline(F.array(*above)))
        .groupBy("stratum", "rule", "above")
        .agg(F.count_if(good).alias("good"), F.count_if(~good).alias("bad")),
        "rule-counts",
    )
    strata = max(1, counted.select("stratum").distinct().count())
    tests = strata * sum(len(grid) for _, grid in RULES.values())
    grids = F.create_map(*[x for n, (_, g) in RULES.items() for x in (F.lit(n), F.array(*map(F.lit, g)))])
    # Every cutoff with what lies above it; the groups are strata and rules.
    totals = counted.groupBy("stratum", "rule").agg(
        F.sum("good").alias("good"),
        F.sum("bad").alias("bad"),
        F.collect_list(F.struct("above", "good", "bad")).alias("steps"),  # at most the grid and one
    )

    def beyond(kind: str) -> Column:
        return F.aggregate(
            "steps", F.lit(0).cast("long"), lambda n, x: n + F.when(x["above"] > F.col("place"), x[kind]).otherwise(0)
        )

    tested = totals.select("*", F.posexplode(grids[F.col("rule")]).alias("place", "cutoff")).select(
        "stratum", "rule", "cutoff", "place", "good", "bad",
        beyond("good").alias("good_out"), beyond("bad").alias("bad_out"),
    )
    doubt_here = binomial_at_most(F.col("good_out"), F.col("good"), risk / len(RULES))
    worth = F.col("bad_out") / F.greatest("bad", F.lit(1)) - PENALTY * F.col("good_out") / F.greatest("good", F.lit(1))
    best = Window.partitionBy("stratum", "rule").orderBy(F.col("worth").desc(), F.col("place").desc())
    return (
        tested.withColumn("worth", worth)
        .filter((doubt_here <= doubt / tests) & (F.col("worth") > 0))
        .withColumn("rank", F.row_number().over(best))
        .filter("rank = 1")
        .select("stratum", "rule", "cutoff")
    )


def rated(documents: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """Counts, ``base_failed``, the rules that reject (``rejected_by``) and ``kept`` for every document."""
    counts = measured(documents, stratum)
    cutoffs = settle(
        certified(counts, labels)
        .groupBy("stratum")
        .agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs")),  # at most the rules
        "cutoffs",
    )
    joined = counts.join(cutoffs.withColumnRenamed("stratum", "of"), F.col("stratum").eqNullSafe(F.col("of")), "left")
    fails = F.array_compact(
        F.array(*[F.when(_measure(name) > F.col("cutoffs")[name], F.lit(name)) for name in RULES])
    )
    return joined.withColumn("base_failed", base_failed()).withColumn("rejected_by", fails).withColumn(
        "kept", ~F.col("base_failed") & (F.size("rejected_by") == 0)
    )


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )

"""Language of a text by bit-sliced Bloom filters of character n-grams.

Slot i of the table holds bit i of every language's filter side by side, so the
AND of the few slots an n-gram hashes to is the set of all languages that
contain it. A language contains an n-gram if its share among the language's
n-grams is at least ``LEAST_SHARE`` and a fifth of the highest share any
language gives it. Counts of hits per language are corrected for the false
positives its filter's fill makes likely; the largest corrected count decides.

N-grams are 2 to 4 characters of a lower-cased word, with the gap before and
after it. The table is fitted on at most about ``TRAIN_DOCS`` documents of each
language, picked by a hash of doc_id; it has at most 1 / ``LEAST_SHARE`` n-grams
a language, so its size does not grow with the corpus.

Defined results: a text that is null or has no letter is ``und`` with score 0;
so is every text if no language was learned. Ties go to the language that sorts
first. A null doc_id counts as held out (it has no remainder) and repeated rows
get equal answers; empty tables give no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelgauge.llm.shared import table
from reelgauge.llm.tokens import chunks

SIZES = (2, 3, 4)
TRAIN_DOCS = 4000
LEAST_SHARE = 1e-5
PROBES = 4
SLOTS_PER_GRAM = 10
UNKNOWN = "und"
#: Characters whose n-grams a worker holds at once, about 100 bytes each.
AT_ONCE = 100_000
#: Below this share of known n-grams a text is in none of the learned languages, whatever these score.
REJECT_BELOW = 0.1
#: A text is in none of them either if it scores less than ``SLACK`` of what all but a hundredth of its
#: language's held-out documents reach. Short texts and texts in two languages lie between.
LOW, SLACK = 0.01, 0.75


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all n-grams, the number of the text each is in, and letters of each text."""
    lowered = [f"  {x.lower()}  " if x else "    " for x in texts]
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), "<u4")
    letter = _letters()[codes]
    sizes = np.fromiter(map(len, lowered), np.int64, len(lowered))
    owner = np.repeat(np.arange(len(texts)), sizes)
    per_text = np.bincount(owner[letter], minlength=len(texts))
    shown = np.where(letter, codes, 32).astype(np.uint64)
    found, owners = [], []
    for size in SIZES:
        n = len(shown) - size + 1
        valid = letter[:n] | letter[1 : n + 1] if size == 2 else np.ones(n, bool)
        for k in range(1, size - 1):
            valid = valid & letter[k : n + k]
        at = np.flatnonzero(valid)
        key = np.full(len(at), size, np.uint64)
        for k in range(size):  # a code point has 21 bits: three to a word
            if k == 3:
                key = _mixed(key)
            key = (key << np.uint64(21)) ^ shown[at + k]
        found.append(_mixed(key))
        owners.append(owner[at])
    return np.concatenate(found), np.concatenate(owners), per_text


@dataclass(frozen=True)
class Filters:
    """Bit-sliced Bloom filters: ``slots[i]`` has one bit for each language."""

    languages: list[str]
    slots: np.ndarray
    false_rate: np.ndarray

    @classmethod
    def build(cls, languages: list[str], hashes: np.ndarray, bits: np.ndarray) -> Filters:
        """``bits[i]`` says which languages contain n-gram ``hashes[i]``; at most 64 languages."""
        if len(languages) > 64:
            raise ValueError("a slot has 64 bits")
        most = max([1, *(int((bits >> np.uint64(i) & np.uint64(1)).sum()) for i in range(len(languages)))])
        n_slots = 1 << int(np.ceil(np.log2(most * SLOTS_PER_GRAM)))
        kind = np.uint8 if len(languages) <= 8 else np.uint64
        slots = np.zeros(n_slots, kind)
        for place in cls._places(hashes, n_slots):
            np.bitwise_or.at(slots, place, bits.astype(kind))
        fill = np.array([float((slots >> kind(i) & kind(1)).mean()) for i in range(len(languages))])
        return cls(languages, slots, fill**PROBES)

    @staticmethod
    def _places(hashes: np.ndarray, n_slots: int) -> Iterator[np.ndarray]:
        step = (hashes >> np.uint64(32)) | np.uint64(1)
        for k in range(PROBES):
            yield ((hashes + np.uint64(k) * step) & np.uint64(n_slots - 1)).astype(np.int64)

    def containing(self, hashes: np.ndarray) -> np.ndarray:
        """The set of languages that contain each n-gram, as bits."""
        found = None
        for place in self._places(hashes, len(self.slots)):
            found = self.slots[place] if found is None else found & self.slots[place]
        return found

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        hashes, owner, letters = grams(texts)
        masks = self.containing(hashes)
        total = np.bincount(owner, minlength=len(texts)).astype(float)
        hits = np.stack([
            np.bincount(owner, weights=(masks >> masks.dtype.type(i)) & masks.dtype.type(1), minlength=len(texts))
            for i in range(len(self.languages))
        ])
        rate = self.false_rate[:, None]
        corrected = np.clip((hits - total * rate) / np.maximum(1 - rate, 1e-9), 0, None)
        best = np.argmax(corrected, axis=0)
        score = np.clip(corrected.max(0) / np.maximum(total, 1), 0, 1)
        known = [self.languages[i] if n else UNKNOWN for i, n in zip(best, letters, strict=True)]
        return known, np.where(letters > 0, score, 0.0)


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(True))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, language = batch["text"].to_pylist(), batch["language"].to_numpy()
        for start, end in chunks(texts, AT_ONCE):
            hashes, owner, _ = grams(texts[start:end])
            spoken = language[start:end][owner]
            for one in np.unique(spoken):
                found, n = np.unique(hashes[spoken == one], return_counts=True)
                yield pa.record_batch(
                    [pa.array(np.full(len(found), one)), pa.array(found.view(np.int64)), pa.array(n)],
                    names=["language", "gram", "n"],
                )


def fit(documents: DataFrame, train_docs: int = TRAIN_DOCS, least_share: float = LEAST_SHARE) -> Filters:
    """Filters from the documents that are not held out and have a language."""
    labelled = documents.select(
        F.col("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")
    ).filter(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {row["lang"]: row["n"] for row in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return Filters([], np.zeros(1, np.uint8), np.zeros(0))
    number = F.create_map(*[x for i, name in enumerate(languages) for x in (F.lit(name), F.lit(i))])
    share = F.create_map(*[x for name in languages for x in (F.lit(name), F.lit(min(1.0, train_docs / sizes[name])))])
    draw = F.pmod(F.xxhash64(F.col("doc_id")), F.lit(1_000_000)) / 1_000_000
    sample = labelled.filter(draw < share[F.col("lang")]).select(
        number[F.col("lang")].cast("long").alias("language"), "text"
    )
    counted = (
        sample.mapInArrow(_counts, "language long, gram long, n long")
        .groupBy("language", "gram")
        .agg(F.sum("n").alias("n"))
    )
    # An n-gram below the share in one language does not count there: at most 1 / share stay.
    totals = counted.groupBy("language").agg(F.sum("n").alias("total"))
    kept = (
        counted.join(totals, "language")
        .filter(F.col("n") >= least_share * F.col("total"))
        .select("language", "gram", (F.col("n") / F.col("total")).alias("share"))
        .toPandas()
    )
    gram, at = np.unique(kept["gram"].to_numpy(np.int64), return_inverse=True)
    shares = np.zeros((len(gram), len(languages)))
    shares[at, kept["language"].to_numpy(np.int64)] = kept["share"].to_numpy(float)
    contains = (shares > 0) & (shares >= 0.2 * shares.max(1, keepdims=True))
    bits = (contains.astype(np.uint64) << np.arange(len(languages), dtype=np.uint64)).sum(1, dtype=np.uint64)
    return Filters.build(languages, gram.view(np.uint64), bits)


def _predictions(filters: Filters):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if "_text" in batch.schema.names:
                texts, rest = batch["_text"].to_pylist(), batch.drop_columns(["_text"])
            else:  # the text of a whole row
                texts, rest = batch["row"].field("text").cast(pa.string()).to_pylist(), batch
            for start, end in chunks(texts, AT_ONCE):
                language, score = filters.predict(texts[start:end])
                some = rest.slice(start, end - start)
                yield pa.record_batch(
                    [*some.columns, pa.array(language, pa.string()), pa.array(score)],
                    names=[*some.schema.names, "lang_pred", "score"],
                )

    return run


def predict(documents: DataFrame, filters: Filters, *columns: Column) -> DataFrame:
    """``columns`` (the whole ``row`` if there are none) of every document with ``lang_pred`` and ``score`` of its whole text."""
    text = [F.col("text").cast("string").alias("_text")] if columns else []
    narrow = documents.select(*text, *(columns or [F.struct("*").alias("row")]))
    schema = narrow.drop("_text").schema.add("lang_pred", "string").add("score", "double")
    return narrow.mapInArrow(_predictions(filters), schema)


def languages(documents: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document."""
    return predict(documents, fit(documents), F.col("doc_id"), held_out().alias("held_out")).select(
        "doc_id", "held_out", "lang_pred", "score"
    )


def thresholds(documents: DataFrame, filters: Filters, least: float = REJECT_BELOW) -> dict[str, float]:
    """Least score of a text of each language, from all held-out documents that were told right.

    A language without any takes the one of all languages together.
    """
    labelled = documents.filter(held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    right = predict(labelled, filters, F.col("lang").cast("string").alias("lang")).filter("lang = lang_pred")
    low = F.percentile_approx("score", LOW, 10_000).alias("low")
    found = {row["lang"]: row["low"] for row in right.rollup("lang").agg(low).collect()}
    whole = found.get(None) or 0.0
    return {name: max(least, SLACK * found.get(name, whole)) for name in filters.languages}


def in_known_language(documents: DataFrame, least: float = REJECT_BELOW) -> DataFrame:
    """Rows of ``documents`` whose text is in one of the learned languages.

    Texts without letters and texts that score less than the threshold of the
    language they are nearest to, ``least`` at any rate, go.
    """
    filters = fit(documents)
    enough = F.lit(False)
    for name, threshold in thresholds(documents, filters, least).items():
        enough = enough | ((F.col("lang_pred") == name) & (F.col("score") >= threshold))
    return predict(documents, filters).filter(enough).select("row.*")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(table(spark, sf_dir, "documents"))

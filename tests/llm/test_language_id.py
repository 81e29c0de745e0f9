import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from reelgauge.llm import language_id as L


def test_held_out_documents_are_told_apart(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = L.languages(documents).join(documents.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == documents.count()
    for row in rows:
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 5 == 0)
        assert 0 <= row.score <= 1
    held = [x for x in rows if x.held_out]
    assert sum(x.lang == x.lang_pred for x in held) >= 0.97 * len(held)


def test_odd_rows(spark, odd, none):
    rows = {(x.doc_id, x.lang_pred == "und") for x in L.languages(odd).collect()}
    assert {(4, True), (5, True), (6, True), (9, True), (3, False), (7, False)} <= rows
    assert L.languages(none).count() == 0
    kept = L.in_known_language(odd)
    assert kept.columns == odd.columns and kept.count() == 6
    unlabelled = odd.withColumn("lang", F.lit(None).cast("string"))
    assert {x.lang_pred for x in L.languages(unlabelled).collect()} == {"und"}


def test_filters_hold_what_was_put_in_and_little_else():
    rng = np.random.default_rng(1)
    hashes = rng.integers(0, 2**63, 20_000, dtype=np.uint64)
    bits = rng.integers(1, 8, 20_000, dtype=np.uint64)
    filters = L.Filters.build(["a", "b", "c"], hashes, bits)
    found = filters.containing(hashes).astype(np.uint64)
    assert ((found & bits) == bits).all()
    others = filters.containing(rng.integers(0, 2**63, 50_000, dtype=np.uint64))
    for i, rate in enumerate(filters.false_rate):
        assert abs(((others >> i) & 1).mean() - rate) < 0.01 and rate < 0.05


UNLEARNED = [
    "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem i powinni postępować wobec innych w duchu braterstwa.",
    "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, ja heidän on toimittava toisiaan kohtaan veljeyden hengessä.",
    "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler ve birbirlerine karşı kardeşlik zihniyeti ile hareket etmelidirler.",
    "Todos os seres humanos nascem livres e iguais em dignidade e em direitos. Dotados de razão e de consciência, devem agir uns para com os outros em espírito de fraternidade.",
    "Tất cả mọi người sinh ra đều được tự do và bình đẳng về nhân phẩm và quyền. Mọi con người đều được tạo hoá ban cho lý trí và lương tâm.",
]


def test_unlearned_languages_and_noise_go(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    rng = np.random.default_rng(3)
    noise = [" ".join("".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(2, 9))) for _ in range(80)) for _ in range(20)]
    # No label: nothing is learned from them.
    strange = spark.createDataFrame([(-1 - i, x, None) for i, x in enumerate([*UNLEARNED, *noise])], "doc_id long, text string, lang string")
    kept = L.in_known_language(documents.withColumn("doc_id", F.col("doc_id").cast("long")).unionByName(strange))
    ids = [x.doc_id for x in kept.select("doc_id").collect()]
    assert not [x for x in ids if x < 0]
    assert len(ids) == documents.count()


def test_learning_holds_few_characters_at_once(monkeypatch):
    """A worker counts a batch of long texts in parts; the counts are those of the whole."""
    seen, plain = [], L.grams
    monkeypatch.setattr(L, "grams", lambda texts: seen.append(sum(map(len, texts))) or plain(texts))
    texts = [f"word{'abcdefghij'[n % 10]} and some more of it " * 800 for n in range(100)]
    batch = pa.record_batch([pa.array(texts), pa.array([n % 2 for n in range(100)])], names=["text", "language"])
    counts = {}
    for out in L._counts(iter([batch])):
        for row in zip(*out.to_pydict().values(), strict=True):
            counts[row[:2]] = counts.get(row[:2], 0) + row[2]
    assert max(seen) < 300_000 < sum(seen)
    for one in (0, 1):
        found, n = np.unique(plain(texts[one::2])[0], return_counts=True)
        assert {x[1]: c for x, c in counts.items() if x[0] == one} == dict(zip(found.view(np.int64).tolist(), n.tolist(), strict=True))

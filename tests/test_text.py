import re

import pytest
from pyspark.sql import functions as F

from reelgauge import fixed_values as fixed
from reelgauge.functions import text as X

TITLES = [
    "Coração100 foo_bar ab×cd ×abc aé éée party ARTE com 日本",
    "O melhor TREINO de 2024: peito/costas!!! (sem equipamento)",
    "naïve café — déjà-vu, l'été; 3d abc1 1abc _abc abc_",
    "a e o de da do",
    "÷÷÷ ×××x xxx÷ ÷xxx÷yyy",
    "",
]


@pytest.mark.parametrize("title", TITLES)
def test_words_equal_python_regex(spark, title):
    expected = [
        word
        for word in re.findall(r"\b[a-zA-ZÀ-ÿ]{3,}\b", title.lower())
        if word not in fixed.STOPWORDS
    ]
    frame = spark.createDataFrame([(title,)], "title string")
    assert frame.select(X.words(F.col("title"))).first()[0] == expected


def emoji(spark, title, strict=False):
    frame = spark.createDataFrame([(title,)], "title string")
    return frame.select(X.has_emoji(F.col("title"), strict)).first()[0]


@pytest.mark.parametrize(
    "title, wide, strict",
    [
        ("plain ascii and acentuação", False, False),
        ("smile 😀", True, True),
        ("rocket 🚀", True, True),
        ("scissors ✂", True, True),
        ("kanji 日本", True, False),
        ("hangul 한국", True, False),
        ("circled Ⓜ", True, False),
        ("arrow →", False, False),
    ],
)
def test_emoji(spark, title, wide, strict):
    assert emoji(spark, title) is wide
    assert emoji(spark, title, strict=True) is strict


def test_length_bins_are_right_closed(spark):
    lengths = [0, 1, 20, 21, 30, 31, 70, 71, 100, 101]
    frame = spark.createDataFrame([(n,) for n in lengths], "n int")
    found = [r[0] for r in frame.select(X.length_bin(F.col("n"))).collect()]
    assert found == [None, 1, 1, 2, 2, 3, 6, 7, 7, None]


def test_title_length_counts_code_points(spark):
    frame = spark.createDataFrame([("ação 😀",)], "title string")
    assert frame.select(X.title_length(F.col("title"))).first()[0] == 6


def test_keywords_match_inside_words(spark):
    frame = spark.createDataFrame([("Big PARTY tonight",)], "title string")
    keywords = F.array(*[F.struct(F.lit(w).alias("word")) for w in ["art", "night", "day"]])
    held = frame.select(X.held_keywords(F.col("title"), keywords)).first()[0]
    assert [k.word for k in held] == ["art", "night"]

import pytest
from pyspark.sql import functions as F

from reelgauge.functions import columns as C


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    "text, seconds",
    [
        ("PT1H2M3S", 3723.0),
        ("P0D", 0.0),
        ("P1DT2H", 93600.0),
        ("PT59S", 59.0),
        ("PT15M", 900.0),
        ("P1W", 604800.0),
        ("PT1.5S", 1.5),
        ("PT1,5S", 1.5),
        ("-PT5S", -5.0),
        ("PT90S", 90.0),
        ("oops", None),
        ("P", None),
        ("PT", None),
        ("P1DT", None),
        ("PT5", None),
        ("1;2;3;4;5", None),
        ("", None),
        (None, None),
    ],
)
def test_duration_seconds(spark, text, seconds):
    assert one(spark, C.duration_seconds, text) == seconds


@pytest.mark.parametrize(
    "text, count", [("12", 12), (None, 0), ("", 0), ("many", 0), ("9000000000", 9000000000)]
)
def test_count_from_text(spark, text, count):
    assert one(spark, C.count_from_text, text) == count


def test_rates_of_unwatched_video_are_null(spark):
    rows = spark.createDataFrame([(0,), (1,), (None,)], "views long")
    found = [r[0] for r in rows.select(C.per_view(F.lit(3), F.col("views"))).collect()]
    assert found == [None, 300.0, None]


@pytest.mark.parametrize(
    "seconds, text",
    [(3723.0, "1h 2m 3s"), (59.9, "0h 0m 59s"), (0.0, "0h 0m 0s"), (-5.0, "-1h 59m 55s")],
)
def test_hours_minutes_seconds(spark, seconds, text):
    assert one(spark, C.hours_minutes_seconds, seconds, "double") == text


def test_dotted_thousands(spark):
    assert one(spark, C.dotted_thousands, 1234567, "long") == "1.234.567"


def test_weekdays(spark):
    rows = spark.sql("SELECT explode(sequence(DATE'2024-01-01', DATE'2024-01-07')) AS d")
    name = C.weekday_name(F.col("d").cast("timestamp"))
    number = C.weekday_number(name)
    found = rows.select(name, number, C.weekday_label_pt(number)).collect()
    assert [r[1] for r in found] == list(range(7))
    assert [r[0] for r in found][::6] == ["Monday", "Sunday"]
    assert [r[2] for r in found] == [
        "Segunda", "Terça", "Quarta", "Quinta", "Sexta", "Sábado", "Domingo"
    ]


def test_instants_with_zone_and_fraction(spark):
    rows = spark.createDataFrame(
        [("2024-12-30T23:15:00Z",), ("2021-01-01T00:00:00.250Z",), ("2024-01-01T01:00:00+02:00",), ("x",)],
        "t string",
    )
    at = C.instant(F.col("t"))
    found = rows.select(
        at.cast("string"), F.hour(at), F.weekofyear(at), F.year(at), F.extract(F.lit("YEAROFWEEK"), at)
    ).collect()
    assert tuple(found[0]) == ("2024-12-30 23:15:00", 23, 1, 2024, 2025)
    assert tuple(found[1]) == ("2021-01-01 00:00:00.25", 0, 53, 2021, 2020)
    assert found[2][0] == "2023-12-31 23:00:00"
    assert found[3][0] is None


def test_log_of_no_views(spark):
    assert one(spark, C.log10_views, 0, "long") == 0.0
    assert one(spark, C.log10_views, 1000, "long") == 3.0


@pytest.mark.parametrize("r, label", [(0.31, "positiva"), (-0.31, "negativa"), (0.3, "pouca"), (None, "pouca")])
def test_correlation_label(spark, r, label):
    assert one(spark, C.correlation_label, r, "double") == label

"""Scalar column expressions of the silver layer and of the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reelgauge import fixed_values as fixed

_NUMBER = r"\d+(?:[.,]\d+)?"
# One optional part per unit; "P" alone, or a "T" without a time part, is malformed.
_DURATION = (
    rf"^([+-]?)P(?=\d|T\d)(?:({_NUMBER})W)?(?:({_NUMBER})D)?"
    rf"(?:T(?=\d)(?:({_NUMBER})H)?(?:({_NUMBER})M)?(?:({_NUMBER})S)?)?$"
)
_PARTS = "0$2;0$3;0$4;0$5;0$6"  # the zero keeps absent parts readable
_PART_SECONDS = [604800.0, 86400.0, 3600.0, 60.0, 1.0]


def count_from_text(text: Column) -> Column:
    """Integer held as text; a missing or unreadable one counts 0."""
    return F.coalesce(text.try_cast("bigint"), F.lit(0).cast("bigint"))


def instant(text: Column) -> Column:
    return text.try_cast("timestamp")


def duration_seconds(text: Column) -> Column:
    """ISO-8601 duration to seconds; NULL when malformed."""
    split = F.split(F.translate(F.regexp_replace(text, _DURATION, _PARTS), ",", "."), ";")

    def added(parts: Column) -> Column:
        total = F.lit(0.0)
        for number, unit in enumerate(_PART_SECONDS):
            total = total + F.get(parts, F.lit(number)).try_cast("double") * unit
        return total

    # The transform evaluates the split once for all five parts.
    seconds = F.get(F.transform(F.array(split), added), F.lit(0))
    signed = F.when(text.startswith("-"), -seconds).otherwise(seconds)
    return F.when(text.rlike(_DURATION), signed)


def per_view(amount: Column, views: Column) -> Column:
    """Percentage of views; NULL for a video nobody watched."""
    return F.when(views > 0, amount / views * 100)


def month_label(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def weekday_name(ts: Column) -> Column:
    return F.date_format(ts, "EEEE")


def weekday_number(name: Column) -> Column:
    """0 for Monday to 6 for Sunday."""
    days = F.array(*[F.lit(day) for day in fixed.WEEKDAYS_PT])
    return F.array_position(days, name).cast("int") - 1


def weekday_label_pt(number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(day) for day in fixed.WEEKDAYS_PT.values()]), number + 1)


def hours_minutes_seconds(seconds: Column) -> Column:
    in_hour = F.pmod(seconds, F.lit(3600.0))
    return F.concat(
        F.floor(seconds / 3600), F.lit("h "),
        F.floor(in_hour / 60), F.lit("m "),
        F.floor(F.pmod(in_hour, F.lit(60.0))), F.lit("s"),
    )


def dotted_thousands(number: Column) -> Column:
    return F.translate(F.format_number(number, 0), ",", ".")


def day_month_year(ts: Column) -> Column:
    return F.date_format(ts, "dd/MM/yyyy")


def log10_views(views: Column) -> Column:
    return F.log10(F.greatest(views, F.lit(1)))


def correlation_label(r: Column) -> Column:
    labels = fixed.CORRELATION_LABELS
    return (
        F.when(r > fixed.CORRELATION_LIMIT, labels["up"])
        .when(r < -fixed.CORRELATION_LIMIT, labels["down"])
        .otherwise(labels["none"])
    )


def significant(p: Column) -> Column:
    return p < fixed.SIGNIFICANCE

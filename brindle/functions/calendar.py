"""Date spine, rule-based holidays and the date dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brindle.functions.columns import day_of_quarter, is_weekend, iso_day_of_week


def date_spine(bounds: DataFrame) -> DataFrame:
    """``calendar_date``: every day from ``start``, inclusive, to ``end``, exclusive, of each row of ``bounds``."""
    last = F.date_sub("end", 1)
    days = F.when(F.col("start") <= last, F.sequence("start", last))
    return bounds.select(F.explode(days).alias("calendar_date"))


def _nearest_workday(d: Column) -> Column:
    return F.when(F.weekday(d) == 5, F.date_sub(d, 1)).when(F.weekday(d) == 6, F.date_add(d, 1)).otherwise(d)


def _nth(year: Column, month: int, day: str, n: int) -> Column:
    """The n-th given weekday of a month."""
    return F.date_add(F.next_day(F.date_sub(F.make_date(year, F.lit(month), F.lit(1)), 1), day), 7 * (n - 1))


def _fixed(year: Column, month: int, day: int) -> Column:
    return _nearest_workday(F.make_date(year, F.lit(month), F.lit(day)))


def holiday_rules(year: Column) -> list[tuple[str, Column]]:
    """Name and date of each holiday of a year; a fixed day moves to the nearest workday.

    The names and the first date of Juneteenth are fixed values.
    """
    return [
        ("New Years Day", _fixed(year, 1, 1)),
        ("Birthday of Martin Luther King, Jr.", _nth(year, 1, "MO", 3)),
        ("Washington’s Birthday", _nth(year, 2, "MO", 3)),
        ("Memorial Day", F.next_day(F.make_date(year, F.lit(5), F.lit(24)), "MO")),
        ("Juneteenth", F.when(_fixed(year, 6, 19) >= F.lit("2021-06-17").cast("date"), _fixed(year, 6, 19))),
        ("July 4th", _fixed(year, 7, 4)),
        ("Labor Day", _nth(year, 9, "MO", 1)),
        ("Columbus Day", _nth(year, 10, "MO", 2)),
        ("Thanksgiving Day", _nth(year, 11, "TH", 4)),
        ("Thanksgiving Friday", F.date_add(_nth(year, 11, "TH", 4), 1)),
        ("Christmas", _fixed(year, 12, 25)),
    ]


def holidays(bounds: DataFrame) -> DataFrame:
    """``date_key``, ``holiday`` within each row of ``bounds`` (``start`` inclusive, ``end`` exclusive).

    Years run one beyond the range, as a New Year's Day on a Saturday is kept the day before.
    """
    years = bounds.select("start", "end", F.explode(F.sequence(F.year("start"), F.year("end") + 1)).alias("y"))
    rules = F.array(*[F.struct(d.alias("date_key"), F.lit(n).alias("holiday")) for n, d in holiday_rules(F.col("y"))])
    found = years.select("start", "end", F.inline(rules))
    return found.where((F.col("date_key") >= F.col("start")) & (F.col("date_key") < F.col("end"))).select("date_key", "holiday")


def dim_date(spine: DataFrame, holidays: DataFrame) -> DataFrame:
    """One row per day of ``spine``; attributes are text, month and day names are not padded, weeks are not ISO weeks."""
    d = F.col("calendar_date")
    text = lambda c: c.cast("string")
    week = lambda day: F.floor((day - 1) / 7) + 1
    return spine.join(holidays, spine["calendar_date"] == holidays["date_key"], "left").select(
        F.date_format(d, "yyyyMMdd").alias("date_key"),
        d,
        F.date_format(d, "EEEE").alias("day_name"),
        F.date_format(d, "E").alias("day_name_abbreviated"),
        text(iso_day_of_week(d)).alias("day_of_week"),
        F.date_format(d, "dd").alias("day_of_month"),
        text(week(F.day(d))).alias("week_of_month"),
        text(day_of_quarter(d)).alias("day_of_quarter"),
        F.lpad(text(F.dayofyear(d)), 3, "0").alias("day_of_year"),
        F.lpad(text(week(F.dayofyear(d))), 2, "0").alias("week_of_year"),
        F.date_format(d, "MM").alias("month_of_year"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "MMM").alias("month_name_abbreviated"),
        text(F.quarter(d)).alias("quarter_actual"),
        F.date_format(d, "yyyy").alias("year_actual"),
        F.col("holiday").isNotNull().alias("is_holiday"),
        F.coalesce("holiday", F.lit("NOT A HOLIDAY")).alias("holiday_name"),
        is_weekend(d).alias("is_weekend"),
    )

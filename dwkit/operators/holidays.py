"""K8: US federal holiday flags from a generated calendar.

The calendar is built per year present in the data (bounded by the number of
distinct years), so it is broadcast safely.  Dates follow the observed-date
rule: a holiday on Saturday is observed on Friday, on Sunday on Monday.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _nth_weekday(year: Column, month: int, weekday: str, n: int) -> Column:
    first = F.next_day(F.date_sub(F.make_date(year, F.lit(month), F.lit(1)), 1), weekday)
    return F.date_add(first, 7 * (n - 1))


def _last_weekday(year: Column, month: int, last_day: int, weekday: str) -> Column:
    return F.next_day(F.date_sub(F.make_date(year, F.lit(month), F.lit(last_day)), 7), weekday)


def _observed(d: Column) -> Column:
    dow = F.dayofweek(d)  # 1 = Sunday, 7 = Saturday
    return F.when(dow == 7, F.date_sub(d, 1)).when(dow == 1, F.date_add(d, 1)).otherwise(d)


def _fixed(year: Column, month: int, day: int) -> Column:
    return _observed(F.make_date(year, F.lit(month), F.lit(day)))


def holiday_rules(year: Column) -> list[tuple[str, Column, Column]]:
    """(name, date, rule-active) for one year: the federal calendar.

    Fixed values: New Year's Day (Jan 1, observed), Martin Luther King Jr. Day
    (3rd Monday of January, from 1986), Presidents Day (3rd Monday of
    February), Memorial Day (last Monday of May), Juneteenth (Jun 19,
    observed, from 2021-06-18), Independence Day (Jul 4, observed), Labor Day
    (1st Monday of September), Columbus Day (2nd Monday of October), Veterans
    Day (Nov 11, observed), Thanksgiving (4th Thursday of November), Christmas
    (Dec 25, observed).
    """
    always = F.lit(True)
    return [
        ("New Year's Day", _fixed(year, 1, 1), always),
        ("Martin Luther King Jr. Day", _nth_weekday(year, 1, "Mon", 3), year >= 1986),
        ("Presidents Day", _nth_weekday(year, 2, "Mon", 3), always),
        ("Memorial Day", _last_weekday(year, 5, 31, "Mon"), always),
        ("Juneteenth", _fixed(year, 6, 19), year >= 2021),
        ("Independence Day", _fixed(year, 7, 4), always),
        ("Labor Day", _nth_weekday(year, 9, "Mon", 1), always),
        ("Columbus Day", _nth_weekday(year, 10, "Mon", 2), always),
        ("Veterans Day", _fixed(year, 11, 11), always),
        ("Thanksgiving Day", _nth_weekday(year, 11, "Thu", 4), always),
        ("Christmas Day", _fixed(year, 12, 25), always),
    ]


def holiday_calendar(years: DataFrame, year_col: str = "year") -> DataFrame:
    """One row per (holiday date, name) for the given years and their neighbours.

    Neighbouring years are included because an observed date can move into
    the previous year (Jan 1 on a Saturday -> Dec 31).
    """
    ys = years.select(F.explode(F.sequence(F.col(year_col) - 1, F.col(year_col) + 1)).alias("y")).distinct()
    rules = holiday_rules(F.col("y"))
    arr = F.array(*[F.struct(F.lit(n).alias("name"), d.alias("holiday_date"), a.alias("active"))
                    for n, d, a in rules])
    return (ys.select(F.explode(arr).alias("h"))
              .where(F.col("h.active"))
              .select(F.col("h.holiday_date").alias("holiday_date"), F.col("h.name").alias("holiday_name"))
              .distinct())


def is_holiday_flag(dates: DataFrame, date_col: str, out_col: str = "is_holiday") -> DataFrame:
    """Add a boolean holiday flag to a frame of dates (bounded dimension)."""
    years = dates.select(F.year(date_col).alias("year")).where(F.col("year").isNotNull()).distinct()
    cal = holiday_calendar(years).select(F.col("holiday_date").alias("_dw_hd")).distinct()
    joined = dates.join(F.broadcast(cal), F.col(date_col) == F.col("_dw_hd"), "left")
    return joined.withColumn(out_col, F.col("_dw_hd").isNotNull()).drop("_dw_hd")

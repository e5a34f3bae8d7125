"""Exchange calendar as column expressions and as a dimension table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Full closures that no rule gives.
ONE_OFF = ("2025-01-09",)


def _date(year: Column, month: int, day: int) -> Column:
    return F.make_date(year, F.lit(month), F.lit(day))


def nth_weekday(year: Column, month: int, weekday: str, nth: int) -> Column:
    """The nth Mon/Tue/... of a month."""
    return F.date_add(F.next_day(F.date_sub(_date(year, month, 1), 1), weekday), 7 * (nth - 1))


def last_weekday(year: Column, month: int, weekday: str) -> Column:
    return F.next_day(F.date_sub(F.last_day(_date(year, month, 1)), 7), weekday)


def observed(day: Column) -> Column:
    """A Saturday's holiday is kept on Friday, a Sunday's on Monday."""
    return F.when(F.dayofweek(day) == 7, F.date_sub(day, 1)).when(F.dayofweek(day) == 1, F.date_add(day, 1)).otherwise(day)


def easter(year: Column) -> Column:
    """Gregorian Easter Sunday (Gauss's method with Lichtenberg's correction)."""
    div = lambda a, b: F.floor(a / F.lit(b)).cast("int")
    k = div(year, 100)
    moon = F.lit(15) + div(F.lit(3) * k + 3, 4) - div(F.lit(8) * k + 13, 25)
    sun = F.lit(2) - div(F.lit(3) * k + 3, 4)
    a = year % 19
    d = (F.lit(19) * a + moon) % 30
    r = div(d + div(a, 11), 29)
    full = F.lit(21) + d - r  # day of March of the Paschal full moon
    sunday = F.lit(7) - F.pmod(year + div(year, 4) + sun, F.lit(7))
    return F.date_add(_date(year, 3, 1), (full + 7 - F.pmod(full - sunday, F.lit(7)) - 1).cast("int"))


def holidays_of(year: Column) -> Column:
    """The exchange's holidays of a year; a holiday observed in the year before is not among that year's."""
    days = [
        observed(_date(year, 1, 1)),
        nth_weekday(year, 1, "Mon", 3),
        nth_weekday(year, 2, "Mon", 3),
        F.date_sub(easter(year), 2),
        last_weekday(year, 5, "Mon"),
        observed(_date(year, 6, 19)),
        observed(_date(year, 7, 4)),
        nth_weekday(year, 9, "Mon", 1),
        nth_weekday(year, 11, "Thu", 4),
        observed(_date(year, 12, 25)),
        *(F.when(F.year(F.lit(x).cast("date")) == year, F.lit(x).cast("date")) for x in ONE_OFF),
    ]
    return F.array_compact(F.array(*days))


def is_business_day(day: Column) -> Column:
    return (F.weekday(day) < 5) & ~F.array_contains(holidays_of(F.year(day)), day)


def business_days(spark: SparkSession, start: str, end: str) -> DataFrame:
    """(day, is_business, latest_completed, first_on_or_after, last_on_or_before) of every day, ends included."""
    pad = 14  # no closure lasts two weeks
    days = spark.sql(f"SELECT explode(sequence(date_sub(DATE '{start}', {pad}), date_add(DATE '{end}', {pad}))) AS day")
    days = days.withColumn("is_business", is_business_day(F.col("day")))
    own = F.when(F.col("is_business"), F.col("day"))
    # a calendar has some thousand rows whatever the data's size
    order = Window.orderBy("day")
    days = days.withColumns(
        {
            "latest_completed": F.max(own).over(order.rowsBetween(Window.unboundedPreceding, -1)),
            "first_on_or_after": F.min(own).over(order.rowsBetween(0, Window.unboundedFollowing)),
            "last_on_or_before": F.max(own).over(order.rowsBetween(Window.unboundedPreceding, 0)),
        }
    )
    return days.filter(F.col("day").between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def months_later(day: Column, n: int) -> Column:
    """n months on, the day clamped to the month's end."""
    last = F.last_day(F.add_months(F.trunc(day, "MM"), n))
    return F.least(last, F.date_add(F.trunc(last, "MM"), F.dayofmonth(day) - 1))


def years_earlier(day: Column, n: int) -> Column:
    """n years back; February 29th becomes the 28th."""
    return months_later(day, -12 * n)


def snapshot_schedule(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Both ends, and every third first-of-month from the start's own month (even before the start) to the end."""
    text = f"""
        SELECT explode(array(DATE '{start}', DATE '{end}')) AS snapshot_date
        UNION SELECT d FROM (SELECT explode(sequence(trunc(DATE '{start}', 'MM'), DATE '{end}', interval 3 months)) AS d)"""
    return spark.sql(text)


def day_path(day: Column, prefix: str = "", suffix: str = ".csv.gz") -> Column:
    return F.concat(F.lit(prefix), F.date_format(day, "yyyy/MM/yyyy-MM-dd"), F.lit(suffix))

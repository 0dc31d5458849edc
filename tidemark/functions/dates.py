"""Trading days and market time."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

NEW_YORK = "America/New_York"


def easter(year: int) -> date:
    """Western Easter, by the Gregorian computus."""
    golden, century = year % 19, year // 100
    epact = (century - century // 4 - (8 * century + 13) // 25 + 19 * golden + 15) % 30
    moon = epact - (epact // 28) * (1 - (29 // (epact + 1)) * ((21 - golden) // 11))
    sunday = moon - (year + year // 4 + moon + 2 - century + century // 4) % 7
    month = 3 + (sunday + 40) // 44
    return date(year, month, sunday + 28 - 31 * (month // 4))


def _nth(year: int, month: int, weekday: int, n: int) -> date:
    first = date(year, month, 1)
    return first + timedelta((weekday - first.weekday()) % 7 + 7 * (n - 1))


def holidays(year: int) -> dict[date, str]:
    """Closed days of the New York exchange by rule, with the observed-day rule.

    A Saturday holiday is observed on Friday (but New Year's Day is then not
    observed at all), a Sunday one on Monday.
    """
    last_may = date(year, 5, 31)
    floating = {
        _nth(year, 1, 0, 3): "Martin Luther King Day", _nth(year, 2, 0, 3): "Washington's Birthday", easter(year) - timedelta(2): "Good Friday",
        last_may - timedelta(last_may.weekday()): "Memorial Day", _nth(year, 9, 0, 1): "Labor Day", _nth(year, 11, 3, 4): "Thanksgiving",
    }
    fixed = [(date(year, 1, 1), "New Year's Day"), (date(year, 7, 4), "Independence Day"), (date(year, 12, 25), "Christmas")]
    if year >= 2022:
        fixed.append((date(year, 6, 19), "Juneteenth"))
    for day, name in fixed:
        if day.weekday() == 6:
            floating[day + timedelta(1)] = name
        elif day.weekday() < 5:
            floating[day] = name
        elif name != "New Year's Day":
            floating[day - timedelta(1)] = name
    return floating


def holiday_table(spark: SparkSession, first: int, last: int) -> DataFrame:
    rows = [(d, n) for y in range(first, last + 1) for d, n in sorted(holidays(y).items())]
    return spark.createDataFrame(rows, "day date, name string")


def trading_days(spark: SparkSession, first: str, last: str) -> DataFrame:
    """One row per session in [first, last]: weekdays that are no holiday."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("day")).where("weekday(day) < 5")
    return days.join(holiday_table(spark, int(first[:4]), int(last[:4])), "day", "left_anti")


def futures_expirations(spark: SparkSession, first: str, last: str) -> DataFrame:
    """Month and settlement day of each volatility future whose month lies in [first, last].

    Thirty days before the third Friday of the next month. If that Friday or the
    day counted back to is no trading day, the one before it is taken.
    """
    months = spark.range(1).select(F.explode(F.sequence(F.trunc(F.lit(first).cast("date"), "MM"), F.lit(last).cast("date"), F.expr("interval 1 month"))).alias("month"))
    sessions = trading_days(spark, f"{int(first[:4]) - 1}-01-01", f"{int(last[:4]) + 1}-12-31").select(F.col("day").alias("_s"))
    friday = F.date_add(F.next_day(F.date_sub(F.add_months("month", 1), 1), "Fri"), 14)

    def session_at(df: DataFrame, name: str) -> DataFrame:
        """The last session at or before a day; no two sessions are more than four days apart."""
        near = df.join(sessions, F.col("_s").between(F.date_sub(name, 4), F.col(name)))
        return near.groupBy(*df.columns).agg(F.max("_s").alias("_at")).drop(name).withColumnRenamed("_at", name)

    settled = session_at(months.withColumn("friday", friday), "friday").select("month", F.date_sub("friday", 30).alias("expires"))
    return session_at(settled, "expires")


def plus_business_days(day: Column, n: int) -> Column:
    """n weekdays later; weekends don't count, holidays do. From a weekend it starts on Friday."""
    weekday = F.least(F.weekday(day), F.lit(4))
    start = F.date_sub(day, F.weekday(day) - weekday)
    return F.date_add(start, (n + 2 * F.floor((weekday + n) / 5)).cast("int"))


def market_time(ts: Column) -> Column:
    """A UTC time in New York."""
    return F.from_utc_timestamp(ts, NEW_YORK)


def in_session(ts: Column) -> Column:
    local = market_time(ts)
    minute = F.hour(local) * 60 + F.minute(local)
    return (minute >= 570) & (minute < 960)


def entry_session(events: DataFrame, ts: str, sessions: DataFrame, session: str) -> DataFrame:
    """Each event with the first session that opens (09:30 New York) after it.

    A time of exactly 00:00 or 16:00 is only a date and counts as after the
    close. One shuffle by day block: the next session is carried backward.
    """
    local = market_time(F.col(ts))
    clock = F.hour(local) * 100 + F.minute(local)
    early = (clock < 930) & (clock != 0)
    reached = F.when(early, F.to_date(local)).otherwise(F.date_add(F.to_date(local), 1))
    nxt = sessions.select(F.col(session).alias("_s"), F.coalesce(F.lag(session).over(_by(session)), F.date_sub(F.col(session), 30)).alias("_after"))
    spread = nxt.select("_s", F.explode(F.sequence(F.date_add("_after", 1), F.col("_s"))).alias("_reached"))
    return events.withColumn("_reached", reached).join(spread, "_reached", "left").drop("_reached").withColumnRenamed("_s", "entry")


def _by(session: str):
    from pyspark.sql import Window

    return Window.orderBy(session)  # a row a session

"""Calendar rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def day_after_fourth_thursday(year: Column) -> Column:
    """The Friday after the fourth Thursday of November."""
    return F.date_add(F.next_day(F.date_sub(F.make_date(year, F.lit(11), F.lit(1)), 1), "THU"), 22)


def last_friday_of_november(year: Column) -> Column:
    return F.next_day(F.make_date(year, F.lit(11), F.lit(23)), "FRI")


def same_day_in(year: Column, date: Column) -> Column:
    """A date moved to another year; null where that year has no such day."""
    leap_only = (F.month(date) == 2) & (F.dayofmonth(date) == 29)
    is_leap = ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)
    return F.when(~leap_only | is_leap, F.make_date(year, F.month(date), F.when(leap_only & ~is_leap, 28).otherwise(F.dayofmonth(date))))


def in_lead_window(day: Column, event: Column, lead_days: Column) -> Column:
    """Whether an event lies on the day or within the lead days after it."""
    return event.between(day, F.date_add(day, lead_days))


def utc_day(ts: Column) -> Column:
    """The UTC day of an ISO time stamp in any of its spellings (no offset counts as UTC); null if unreadable."""
    return F.to_date(F.to_utc_timestamp(ts.try_cast("timestamp"), F.current_timezone()))


def held_seconds(since: Column, now: Column) -> Column:
    """Seconds from one ISO time stamp to another; null if either is unreadable."""
    at = lambda c: F.unix_micros(c.try_cast("timestamp"))
    return (at(now) - at(since)) / 1_000_000


def resolved_in(year: Column, date: Column, rule: Column) -> Column:
    """The day of an event in a year: its date moved there, or by its rule; null where there is neither or the rule is unknown."""
    by_rule = F.when(rule == "black_friday", day_after_fourth_thursday(year)).when(rule == "last_friday_of_november", last_friday_of_november(year))
    return F.when(date.isNotNull(), same_day_in(year, date)).otherwise(by_rule)


def calendar_signal(days: DataFrame, calendar: DataFrame, lead_days: int = 21) -> DataFrame:
    """For every ``day``: the first confirmed ``event`` (in the calendar's order) that lies on it or within the lead days after it, its date and
    ``days_until``, the ``others`` in their windows, the ``unconfirmed`` ones and the ``unresolvable`` ones, each joined by ';'.

    A calendar is a list of settings: it is sent to every day."""
    both = days.select("day").distinct().crossJoin(F.broadcast(calendar))
    on = both.withColumn("on", resolved_in(F.year("day"), F.col("date"), F.col("rule"))).withColumn("lead", F.coalesce("lead_days", F.lit(lead_days)))
    hit = F.coalesce(F.col("confirmed") & in_lead_window(F.col("day"), F.col("on"), F.col("lead")), F.lit(False))
    named = lambda c: F.sort_array(F.collect_list(F.when(c, F.struct("place", "name"))))
    g = on.groupBy("day").agg(F.min(F.when(hit, F.struct("place", "name", "on"))).alias("e"), named(hit).alias("hits"), named(F.col("on").isNotNull() & ~F.col("confirmed")).alias("u"), named(F.col("on").isNull()).alias("r"))
    joined = lambda c: F.array_join(F.transform(c, lambda x: x["name"]), ";")
    return g.select(
        "day", F.col("e.name").alias("event"), F.col("e.on").alias("event_date"), F.date_diff("e.on", "day").alias("days_until"),
        joined(F.slice("hits", F.lit(2), F.greatest(F.size("hits") - 1, F.lit(0)))).alias("others"), joined(F.col("u")).alias("unconfirmed"), joined(F.col("r")).alias("unresolvable"))

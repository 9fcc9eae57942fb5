"""Sub-plans shared by several analyses.

Each base aggregates first, so any window that follows runs over small,
pre-combined groups (days per country, observed hours per event) instead of
raw rows.  That keeps a hot country or a viral event from landing whole in
one task: the ``groupBy`` does a map-side partial aggregate before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlens.functions import event_date
from eventlens.functions.maps import CONFLICT_CLASSES
from eventlens.operators.rollup import COUNTRY, daily_of, mention_hours


def daily_country(events: DataFrame, *aggs: Column, where: Column | None = None) -> DataFrame:
    """Per (event_date, country_code) aggregates over events with a country."""
    cond = F.col(COUNTRY).isNotNull()
    if where is not None:
        cond = where & cond
    return (
        events.filter(cond)
        .groupBy(event_date("SQLDATE").alias("event_date"), F.col(COUNTRY).alias("country_code"))
        .agg(*aggs)
    )


def daily_measures(events: DataFrame, quad: Sequence[int] = CONFLICT_CLASSES) -> DataFrame:
    """The shared daily base of 01, 02, 07 and 13: one row per
    (event_date, country_code) with every measure those analyses need.

    Built from events when an analysis runs alone; a runner can build it once,
    stage it, and hand it to all four (``daily=``), which replaces four scans
    and shuffles of the event table by one.  Averages are kept as sum and
    count so they stay exact to combine.
    """
    conflict = F.col("QuadClass").isin(*quad)
    goldstein = F.col("GoldsteinScale")
    return daily_country(
        events,
        F.count(F.lit(1)).alias("n_events"),
        F.count(F.when(conflict, 1)).alias("n_conflict"),
        F.sum(F.when(conflict, goldstein)).alias("conflict_goldstein_sum"),
        F.count(F.when(conflict, goldstein)).alias("conflict_goldstein_n"),
        F.sum(F.when(conflict, F.abs(goldstein))).alias("conflict_intensity"),
        F.sum("AvgTone").alias("tone_sum"),
        F.count("AvgTone").alias("tone_n"),
    )


def daily_base(
    events: DataFrame | None,
    daily: DataFrame | None,
    measures: DataFrame | None,
    quad: Sequence[int] = CONFLICT_CLASSES,
) -> DataFrame:
    """The daily base as handed over, from the ``event_measures`` roll-up, or
    from events."""
    if daily is not None:
        return daily
    return daily_measures(events, quad) if measures is None else daily_of(measures, quad)


def mean(total: str, n: str) -> Column:
    """sum / count as ``avg`` gives it: NULL when there is nothing to average."""
    return F.try_divide(F.col(total), F.col(n))


def hourly_mentions(mentions: DataFrame | None, hours: DataFrame | None = None) -> DataFrame:
    """Mentions per event and hour bucket, with the count and the bucket of the
    previous observed hour of the same event (``prev_mentions``, ``prev_hour``;
    NULL for the first).  ``hours`` are already counted ``mention_hours``.

    The window is ordered ascending, so a NULL hour sorts first (Spark's default).
    """
    hourly = hours if hours is not None else mention_hours(mentions)
    w = Window.partitionBy("GLOBALEVENTID").orderBy(F.col("mention_hour").asc_nulls_first())
    return hourly.withColumn("prev_mentions", F.lag("hourly_mentions", 1).over(w)).withColumn(
        "prev_hour", F.lag("mention_hour", 1).over(w)
    )


def hour_start(bucket: Column | str) -> Column:
    """``yyyyMMddHH`` bucket -> TIMESTAMP_NTZ (zone-free); malformed -> NULL."""
    c = F.col(bucket) if isinstance(bucket, str) else bucket

    def part(start: int, length: int) -> Column:
        return F.substring(c, start, length).try_cast("int")

    made = F.try_make_timestamp_ntz(
        years=part(1, 4), months=part(5, 2), days=part(7, 2), hours=part(9, 2),
        mins=F.lit(0), secs=F.lit(0),
    )
    return F.when(c.rlike("^[0-9]{10}$"), made)


def previous_count(calendar: bool) -> Column:
    """The previous hour's count: the previous *observed* hour (default), or,
    with ``calendar``, only the directly preceding clock hour (else NULL)."""
    prev = F.col("prev_mentions")
    if not calendar:
        return prev
    adjacent = hour_start("prev_hour") + F.expr("INTERVAL 1 HOUR") == hour_start("mention_hour")
    return F.when(adjacent, prev)


def top_per_group(df: DataFrame, keys: list[str], size: str, tie: str, n: int) -> DataFrame:
    """The ``n`` rows of largest ``size`` per group with their ``rank``; ties by
    ``tie``.  Planned as WindowGroupLimit: a group ships ``n`` rows per task."""
    order = Window.partitionBy(*keys).orderBy(F.desc(size), F.asc(tie))
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)

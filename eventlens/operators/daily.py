"""Daily and hourly profiles: 02 top countries per day, 19 hourly density."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.functions import hour_utc
from eventlens.operators.common import daily_base, mean, top_per_group
from eventlens.operators.rollup import HOURS


def top_countries_events(
    events: DataFrame | None, n: int = 10, daily: DataFrame | None = None, measures: DataFrame | None = None
) -> DataFrame:
    """02: the ``n`` action countries with most events per day; ties broken by
    country code.  ``row_number`` + a rank filter plans as WindowGroupLimit, a
    per-partition top-n before the shuffle, so a day never ships more than
    ``n`` rows per map task."""
    base = daily_base(events, daily, measures)
    counts = base.select("event_date", "country_code", F.col("n_events").alias("event_count"))
    return top_per_group(counts, ["event_date"], "event_count", "country_code", n)


def hourly_event_density(events: DataFrame | None, measures: DataFrame | None = None) -> DataFrame:
    """19: events, mean tone and mean Goldstein by hour of day of DATEADDED.
    ``measures`` is an already built ``event_measures`` roll-up."""
    if measures is not None:
        return measures.filter(F.col("kind") == HOURS).select(
            "hour_utc", F.col("n_events").alias("event_count"), mean("tone_sum", "tone_n").alias("avg_tone"),
            mean("goldstein_sum", "goldstein_n").alias("avg_goldstein"))
    return events.groupBy(hour_utc("DATEADDED").alias("hour_utc")).agg(
        F.count(F.lit(1)).alias("event_count"),
        F.avg("AvgTone").alias("avg_tone"),
        F.avg("GoldsteinScale").alias("avg_goldstein"),
    )

"""Named queries over the driver's test tables: ``name -> (spark, sf_dir) -> DataFrame``.

Each query projects the test tables into feed shape (``fixtures``) and runs
one library function on them.  The only things added here are the check
conventions shared with ``oracle_sql``: correlations rounded to 6 digits and
the moving average to 9 (two engines sum floating values in different
orders), and DATE columns rendered as ISO text.  The library functions
themselves return full precision and DATE types.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens import operators as ops
from eventlens.functions import continent
from eventlens.plans import fixtures
from eventlens.plans.views import iso_dates
from eventlens.plans.oracle_sql import ANALYSIS_DATE
from eventlens.session import scratch_path, write_and_read

Query = Callable[[SparkSession, str], DataFrame]


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.project(spark, sf_dir, "events")


def _mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.project(spark, sf_dir, "mentions")


def _gkg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.project(spark, sf_dir, "gkg")


def _round(df: DataFrame, column: str, digits: int) -> DataFrame:
    return df.withColumn(column, F.round(column, digits))


def _analysis(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run one registry analysis on the projected test tables."""
    if name == "tone_sources_correlation":
        df = ops.tone_sources_correlation(_events(spark, sf_dir), as_of=ANALYSIS_DATE)
        return _round(df, "correlation", 6)
    if name == "tone_lag_analysis":
        return _round(ops.tone_lag_analysis(_events(spark, sf_dir)), "lag_correlation", 6)
    if name == "sentiment_trend":
        return _round(ops.sentiment_trend(_events(spark, sf_dir)), "moving_avg_7d", 9)
    if name == "escalation_events":
        hours = write_and_read(
            ops.escalation_hours(_mentions(spark, sf_dir)), scratch_path(spark, "escalation"))
        return ops.escalation_events(None, _events(spark, sf_dir), hours=hours)
    fn, needs = {n: (f, r) for n, f, r in ops.ANALYSES}[name]
    loaders = {"events": _events, "mentions": _mentions, "gkg": _gkg}
    return fn(*[loaders[t](spark, sf_dir) for t in needs])


def _bind(name: str) -> Query:
    # Engines hand dates to pandas differently (date objects vs. timestamps),
    # so the check form of a result carries DATE columns as ISO text.
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return iso_dates(_analysis(name, spark, sf_dir))

    run.__name__ = name
    return run


def events_by_continent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F3 (defined but unused in the analyses): events per continent of the action country."""
    events = _events(spark, sf_dir)
    return events.groupBy(continent("ActionGeo_CountryCode").alias("continent")).agg(
        F.count(F.lit(1)).alias("event_count")
    )


def all_queries() -> dict[str, Query]:
    queries: dict[str, Query] = {name: _bind(name) for name in ops.ANALYSIS_NAMES}
    queries["continent"] = events_by_continent
    return queries

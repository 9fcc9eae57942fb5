"""S6 + S7: 15-minute slot planning and retention, as DataFrame expressions.

Slot stamps are ``yyyyMMddHHmmss`` strings of UTC wall-clock time.  All
arithmetic is on TIMESTAMP_NTZ, so results do not depend on the session time
zone.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLOT_FORMAT = "yyyyMMddHHmmss"
SLOT_SECONDS = 15 * 60


def slot_time(stamp: Column | str) -> Column:
    """Slot stamp text (or a yyyyMMddHHmmss number) -> TIMESTAMP_NTZ; malformed -> NULL.

    Wall-clock time without a zone: the result does not depend on the
    session time zone (no daylight-saving gaps or repeats).
    """
    c = (F.col(stamp) if isinstance(stamp, str) else stamp).cast("string")

    def part(start: int, length: int) -> Column:
        return F.substring(c, start, length).try_cast("int")

    made = F.try_make_timestamp_ntz(
        years=part(1, 4), months=part(5, 2), days=part(7, 2),
        hours=part(9, 2), mins=part(11, 2), secs=part(13, 2),
    )
    return F.when(c.rlike("^[0-9]{14}$"), made)


def slot_floor(ts: Column) -> Column:
    """Start of the 15-minute slot containing ``ts`` (TIMESTAMP_NTZ)."""
    return F.try_make_timestamp_ntz(
        years=F.year(ts), months=F.month(ts), days=F.dayofmonth(ts), hours=F.hour(ts),
        mins=F.floor(F.minute(ts) / 15).cast("int") * 15, secs=F.lit(0),
    )


def day_start(ts: Column) -> Column:
    return F.try_make_timestamp_ntz(
        years=F.year(ts), months=F.month(ts), days=F.dayofmonth(ts),
        hours=F.lit(0), mins=F.lit(0), secs=F.lit(0),
    )


def slot_stamp(ts: Column) -> Column:
    """TIMESTAMP_NTZ -> ``yyyyMMddHHmmss``, built from its fields (``date_format``
    would pass the value through the session time zone)."""
    return F.format_string(
        "%04d%02d%02d%02d%02d%02d",
        F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.minute(ts),
        F.second(ts).cast("int"),
    )


def _ts_literal(now: dt.datetime | str) -> Column:
    return F.lit(str(now)).cast("timestamp_ntz")


def due_slots(spark: SparkSession, now: dt.datetime | str, n: int = 4) -> DataFrame:
    """The last ``n`` slots, starting one slot before the one containing ``now``.

    Returns ``ts`` (stamp) rows, newest first in value but unordered as a set.
    """
    latest = slot_floor(_ts_literal(now)) - F.expr(f"INTERVAL {SLOT_SECONDS} SECONDS")
    earliest = latest - F.expr(f"INTERVAL {SLOT_SECONDS * (n - 1)} SECONDS")
    # A generator cannot be nested in an expression, so format in an outer select.
    slots = spark.range(1).select(
        F.explode(F.sequence(earliest, latest, F.expr("INTERVAL 15 MINUTES"))).alias("slot")
    )
    return slots.select(slot_stamp(F.col("slot")).alias("ts"))


def due_before_newest(loaded: DataFrame, n: int = 4, stamp_col: str = "ts") -> DataFrame:
    """The last ``n`` slots before the newest loaded one that are not loaded."""
    observed = (
        loaded.select(slot_floor(slot_time(stamp_col)).alias("slot"))
        .filter(F.col("slot").isNotNull()).distinct()
    )
    newest = observed.agg(F.max("slot").alias("newest")).filter(F.col("newest").isNotNull())
    steps = newest.select("newest", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("step"))
    expected = steps.select(
        (F.col("newest") - F.make_dt_interval(mins=15 * F.col("step"))).alias("slot"))
    return expected.join(observed, "slot", "left_anti").select(slot_stamp(F.col("slot")).alias("ts"))


# Stamps outside are taken for damaged: they would stretch the gap report over
# thousands of years.  The feeds' own history starts in 1979.
PLAUSIBLE = ("1979-01-01 00:00:00", "2100-01-01 00:00:00")


def missing_slots(loaded: DataFrame, stamp_col: str = "ts", plausible: tuple[str, str] = PLAUSIBLE) -> DataFrame:
    """Gap report: every slot between the first and last loaded slot that has no data.

    Stamps outside ``plausible`` are left out (``implausible_stamps`` lists them).

    The expected slots are generated per calendar day (a few thousand rows for
    years of history, bounded by the time span, not by data volume), spread by
    day, and anti-joined against the distinct loaded slots.
    """
    observed = (
        loaded.select(slot_floor(slot_time(stamp_col)).alias("slot"))
        .filter(F.col("slot").between(*map(_ts_literal, plausible)))
        .distinct()
    )
    bounds = observed.agg(F.min("slot").alias("lo"), F.max("slot").alias("hi"))
    days = bounds.select(
        "lo", "hi",
        F.explode(
            F.sequence(day_start(F.col("lo")), day_start(F.col("hi")), F.expr("INTERVAL 1 DAY"))
        ).alias("day"),
    )
    expected = (
        days.repartition("day")
        .select(
            "lo", "hi",
            F.explode(
                F.sequence(
                    F.col("day"),
                    F.col("day") + F.expr("INTERVAL 1 DAY") - F.expr("INTERVAL 15 MINUTES"),
                    F.expr("INTERVAL 15 MINUTES"),
                )
            ).alias("slot"),
        )
        .filter(F.col("slot").between(F.col("lo"), F.col("hi")))
        .select("slot")
    )
    return expected.join(observed, "slot", "left_anti").select(slot_stamp(F.col("slot")).alias("ts"))


def implausible_stamps(loaded: DataFrame, stamp_col: str = "ts",
                       plausible: tuple[str, str] = PLAUSIBLE) -> DataFrame:
    """``ts, rows``: stamps that are no time or lie outside ``plausible``."""
    inside = F.coalesce(slot_time(stamp_col).between(*map(_ts_literal, plausible)), F.lit(False))
    return loaded.filter(~inside).groupBy(F.col(stamp_col).alias("ts")).agg(F.count(F.lit(1)).alias("rows"))


def retain_since(df: DataFrame, now: dt.datetime | str, hours: float = 1, stamp_col: str = "ts") -> DataFrame:
    """Rows whose slot is not older than ``now - hours``.

    A stamp that does not parse is kept.  On a ``ts``-partitioned table the
    condition only touches the partition column, so Spark prunes whole
    directories instead of reading them.
    """
    parsed = slot_time(stamp_col)
    cutoff = _ts_literal(now) - F.expr(f"INTERVAL {int(hours * 3600)} SECONDS")
    return df.filter(parsed.isNull() | (parsed >= cutoff))

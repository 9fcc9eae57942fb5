"""Mention dynamics: 09 escalation, 17 breaking news.

Both start from the same hourly base (mentions per event and hour bucket, with
the previous observed hour's count).  By default neighbours are *observed*
hours, as in the reference code: a gap of several hours still compares with
the last hour that had mentions.  ``calendar=True`` compares with the clock
hour before instead, as the reference's documentation words it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.operators.common import COUNTRY, hourly_mentions, previous_count


OUTPUT = ["GLOBALEVENTID", "mention_hour", "hourly_mentions", "growth_rate", COUNTRY, "EventCode"]


def escalation_hours(
    mentions: DataFrame | None,
    growth: float = 2.0,
    min_mentions: int = 10,
    hourly: DataFrame | None = None,
    calendar: bool = False,
) -> DataFrame:
    """The event hours whose mention count grew by more than ``growth`` over the
    previous observed hour and reached ``min_mentions``.

    growth_rate = (n - prev) / prev, 0.0 for the first hour.  ``hourly`` is an
    already built ``hourly_mentions`` base (shared with 17).  With ``calendar``
    the comparison is with the directly preceding clock hour only (an hour
    after a gap grows from nothing: rate 0.0).
    """
    prev = previous_count(calendar)
    rate = F.when(
        prev > 0, (F.col("hourly_mentions") - prev) / prev
    ).otherwise(F.lit(0.0))
    base = hourly if hourly is not None else hourly_mentions(mentions)
    return (
        base.withColumn("growth_rate", rate)
        .filter((F.col("growth_rate") > growth) & (F.col("hourly_mentions") >= min_mentions))
        .drop("prev_mentions", "prev_hour")
    )


def escalation_events(
    mentions: DataFrame | None,
    events: DataFrame | None = None,
    growth: float = 2.0,
    min_mentions: int = 10,
    hourly: DataFrame | None = None,
    calendar: bool = False,
    hours: DataFrame | None = None,
) -> DataFrame:
    """09: the ``escalation_hours`` left-joined to their event's action country
    and code; ids without an event keep NULLs.

    Join strategy.  The qualifying hours are few, the event table is the
    largest input.  A broadcast hash join cannot build on the preserved side
    of an outer join, so a plain left join shuffles the whole event
    projection.  ``hours`` takes the hours as a written table (the runner
    stages them), whose measured size the planner knows.  Then the events are
    first cut to those ids by a left semi join, which broadcasts the hours
    while they are under the broadcast threshold (events are streamed, not
    shuffled).  Beyond it the join is a sort-merge join, and Spark puts a Bloom
    filter of the hours' ids (8 MB at most) in front of the events' shuffle, so
    only events that may match are moved; ``session.BASE_CONF`` sets from which
    sizes.  The left join that follows meets only events of those ids.  Without
    ``hours`` the plan is the plain left join.  Nothing is written here in
    either case.
    """
    if hours is None:
        hot = escalation_hours(mentions, growth, min_mentions, hourly, calendar)
    else:
        hot = hours
    if events is None:
        return hot.withColumn(COUNTRY, F.lit(None).cast("string")).withColumn(
            "EventCode", F.lit(None).cast("string")
        ).select(*OUTPUT)
    event_keys = events.select("GLOBALEVENTID", COUNTRY, "EventCode")
    if hours is not None:
        # always true; the optimizer builds a Bloom filter only from a side with a condition
        picked = hours.filter(F.col("hourly_mentions") > 0).select("GLOBALEVENTID")
        event_keys = event_keys.join(picked, "GLOBALEVENTID", "left_semi")
    return hot.join(event_keys, "GLOBALEVENTID", "left").select(*OUTPUT)


def breaking_news(
    mentions: DataFrame | None,
    min_mentions: int = 100,
    hourly: DataFrame | None = None,
    calendar: bool = False,
) -> DataFrame:
    """17: hours with more than ``min_mentions`` mentions whose previous observed
    hour is absent (or 0).  Counts are never 0, so these are first hours.
    ``hourly`` is an already built ``hourly_mentions`` base (shared with 09).
    With ``calendar`` the previous clock hour must have had no mentions
    ("from 0 to more than n within the hour"), so a burst after a gap counts."""
    base = hourly if hourly is not None else hourly_mentions(mentions)
    return (
        base.filter(
            (F.coalesce(previous_count(calendar), F.lit(0)) == 0)
            & (F.col("hourly_mentions") > min_mentions)
        )
        .select(
            "GLOBALEVENTID", "mention_hour", "hourly_mentions",
            F.lit(True).alias("is_breaking_news"),
        )
    )

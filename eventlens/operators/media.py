"""Media and tone analyses: 03 tone/sources correlation, 06 coverage,
07 sentiment trend, 13 tone lag, 15 source diversity."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlens.functions import safe_corr
from eventlens.functions.maps import CONFLICT_CLASSES
from eventlens.operators.common import COUNTRY, daily_base, mean
from eventlens.operators.rollup import days as measured_days
from eventlens.operators.rollup import distinct_mentioned_events, mention_sources


def _correlation_of_sums() -> Column:
    """Pearson correlation from merged sums; NULL for a constant side, which the
    extremes tell exactly."""
    n, x, y = F.col("pair_n"), F.col("pair_tone"), F.col("pair_sources")
    spread_x = F.sqrt(F.greatest(F.lit(0.0), F.col("pair_tone_squares") - F.try_divide(x * x, n)))
    spread_y = F.sqrt(F.greatest(F.lit(0.0), F.col("pair_sources_squares") - F.try_divide(y * y, n)))
    varied = (F.col("tone_low") < F.col("tone_high")) & (F.col("sources_low") < F.col("sources_high"))
    return F.when(varied, F.try_divide(F.col("pair_products") - F.try_divide(x * y, n), spread_x * spread_y))


def tone_sources_correlation(
    events: DataFrame | None, as_of: dt.date | str | None = None, measures: DataFrame | None = None
) -> DataFrame:
    """03: one row over the whole table.

    ``sample_size`` counts every row; the correlation only rows where both
    AvgTone and NumSources are present.  ``analysis_date`` is ``as_of``
    (default: today).  ``measures`` is an already built ``event_measures``
    roll-up, whose moments add up.
    """
    stamp = F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")
    if measures is not None:
        sums = ["n_events", "tone_sum", "tone_n", "sources_sum", "sources_n", "pair_n", "pair_tone", "pair_sources",
                "pair_tone_squares", "pair_sources_squares", "pair_products"]
        total = measured_days(measures).agg(
            *(F.sum(c).alias(c) for c in sums),
            *(F.min(c).alias(c) for c in ("tone_low", "sources_low")),
            *(F.max(c).alias(c) for c in ("tone_high", "sources_high")))
        return total.select(
            _correlation_of_sums().alias("correlation"),
            F.coalesce("n_events", F.lit(0)).alias("sample_size"),
            mean("tone_sum", "tone_n").alias("avg_tone"),
            mean("sources_sum", "sources_n").alias("avg_sources"),
        ).withColumn("analysis_date", stamp)
    return events.agg(
        safe_corr("AvgTone", "NumSources").alias("correlation"),
        F.count(F.lit(1)).alias("sample_size"),
        F.avg("AvgTone").alias("avg_tone"),
        F.avg("NumSources").alias("avg_sources"),
    ).withColumn("analysis_date", stamp)


def media_coverage(events: DataFrame | None, measures: DataFrame | None = None) -> DataFrame:
    """06: events, mentions and mentions per event by action country.

    ``mentions_per_event_ratio`` divides by all events, so it differs from the
    average when NumMentions has NULLs.  ``measures`` is an already built
    ``event_measures`` roll-up.
    """
    if measures is not None:
        by_country = (
            measured_days(measures).filter(F.col("country_code").isNotNull()).groupBy("country_code")
            .agg(
                F.sum("n_events").alias("total_events"),
                F.sum("mentions_sum").alias("total_mentions"),
                F.try_divide(F.sum("mentions_sum"), F.sum("mentions_n")).alias("avg_mentions_per_event"),
            )
        )
    else:
        by_country = (
            events.filter(F.col(COUNTRY).isNotNull())
            .groupBy(F.col(COUNTRY).alias("country_code"))
            .agg(
                F.count(F.lit(1)).alias("total_events"),
                F.sum("NumMentions").alias("total_mentions"),
                F.avg("NumMentions").alias("avg_mentions_per_event"),
            )
        )
    return (
        by_country
        .withColumn("mentions_per_event_ratio", F.col("total_mentions") / F.col("total_events"))
    )


def sentiment_trend(
    events: DataFrame | None,
    rows: int = 7,
    daily: DataFrame | None = None,
    calendar: bool = False,
    measures: DataFrame | None = None,
) -> DataFrame:
    """07: daily mean tone per country and its moving mean over the current
    and ``rows - 1`` previous *observed* days of that country; with
    ``calendar``, over the last ``rows`` calendar days instead."""
    base = daily_base(events, daily, measures)
    days = base.select("event_date", "country_code", mean("tone_sum", "tone_n").alias("daily_avg_tone"))
    if calendar:
        w = (
            Window.partitionBy("country_code")
            .orderBy(F.unix_date("event_date").asc_nulls_first())
            .rangeBetween(-(rows - 1), Window.currentRow)
        )
    else:
        w = (
            Window.partitionBy("country_code")
            .orderBy(F.col("event_date").asc_nulls_first())
            .rowsBetween(-(rows - 1), Window.currentRow)
        )
    return days.withColumn("moving_avg_7d", F.avg("daily_avg_tone").over(w))


def tone_lag_analysis(
    events: DataFrame | None,
    quad: Sequence[int] = CONFLICT_CLASSES,
    daily: DataFrame | None = None,
    calendar: bool = False,
    measures: DataFrame | None = None,
) -> DataFrame:
    """13: per country, correlation of the daily mean tone with the conflict
    count of the next observed day; the last day of a country has no partner
    and is dropped.  ``observations`` counts the remaining days.  With
    ``calendar`` a day pairs only with the next calendar day (else dropped)."""
    base = daily_base(events, daily, measures, quad)
    days = base.select(
        "event_date", "country_code",
        mean("tone_sum", "tone_n").alias("avg_tone"),
        F.col("n_conflict").alias("conflict_count"),
    )
    w = Window.partitionBy("country_code").orderBy(F.col("event_date").asc_nulls_first())
    following = F.lead("conflict_count", 1).over(w)
    if calendar:
        next_date = F.lead("event_date", 1).over(w)
        following = F.when(next_date == F.date_add("event_date", 1), following)
    return (
        days.withColumn("next_day_conflicts", following)
        .filter(F.col("next_day_conflicts").isNotNull())
        .groupBy("country_code")
        .agg(
            safe_corr("avg_tone", "next_day_conflicts").alias("lag_correlation"),
            F.count(F.lit(1)).alias("observations"),
        )
    )


def source_diversity_index(
    mentions: DataFrame | None,
    events: DataFrame,
    approximate: bool = False,
    rsd: float = 0.01,
    sources: DataFrame | None = None,
    bits: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """15: per action country of the mentioned event: distinct sources,
    mentions, distinct events and sources per event.

    Mentions are first combined per (event, source), which is exact for all
    three measures: distinct counts do not change and ``total_mentions`` sums
    the per-pair counts.  A viral event then reaches the join as one row per
    source instead of one row per mention, so the shuffle on GLOBALEVENTID is
    not dominated by one key.  Duplicate event rows still multiply, as an
    inner join does.

    The distinct counts are exact by default.  After the join the rows lie by
    event, so the first row of each (event, country) is marked without another
    exchange; counts per (country, source) and then per country follow, whose
    shuffles have the size countries x sources, not events.  With
    ``approximate`` the counts are HyperLogLog++ sketches (relative standard
    deviation ``rsd``), which merge map-side.  ``sources`` are already built
    ``mention_sources``.

    ``bits`` are ``country_bits`` and ``mentioned_bits`` (built, or merged from
    several passes): distinct events are then counted from bitmaps, exact as
    well, without the rank after the join.  A bitmap takes 4 KB for each 32,768
    consecutive ids that a country has any of, so it suits ids dealt in sequence.
    """
    per_source = sources if sources is not None else mention_sources(mentions)
    event_country = events.select("GLOBALEVENTID", F.col(COUNTRY).alias("country_code")).filter(
        F.col("country_code").isNotNull()
    )
    joined = per_source.join(event_country, "GLOBALEVENTID")
    if approximate:
        measures = joined.groupBy("country_code").agg(
            F.approx_count_distinct("MentionSourceName", rsd).alias("unique_sources"),
            F.sum("n_mentions").alias("total_mentions"),
            F.approx_count_distinct("GLOBALEVENTID", rsd).alias("unique_events"),
        )
    elif bits is not None:
        counted = (
            joined.groupBy("country_code", "MentionSourceName").agg(F.sum("n_mentions").alias("n"))
            .groupBy("country_code")
            .agg(F.count("MentionSourceName").alias("unique_sources"), F.sum("n").alias("total_mentions"))
        )
        measures = counted.join(distinct_mentioned_events(*bits), "country_code").select(
            "country_code", "unique_sources", "total_mentions", "unique_events")
    else:
        of_event = Window.partitionBy("GLOBALEVENTID", "country_code").orderBy("MentionSourceName")
        measures = (
            joined.withColumn("first", (F.row_number().over(of_event) == 1).cast("long"))
            .groupBy("country_code", "MentionSourceName")
            .agg(F.sum("n_mentions").alias("n"), F.sum("first").alias("n_first"))
            .groupBy("country_code")
            .agg(
                F.count("MentionSourceName").alias("unique_sources"),
                F.sum("n").alias("total_mentions"),
                F.sum("n_first").alias("unique_events"),
            )
        )
    return measures.withColumn("diversity_index", F.col("unique_sources") / F.col("unique_events"))

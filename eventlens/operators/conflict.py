"""Conflict analyses: 01 heatmap, 08 country pairs, 10 religion, 14 graph,
16 ethnicity, 18 QuadClass timeline."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.functions import country_pair, event_date, interaction_type, region
from eventlens.functions.maps import CONFLICT_CLASSES, OTHER
from eventlens.operators.common import COUNTRY, daily_base, mean
from eventlens.operators.rollup import ETHNICITIES, PAIRS, RELIGIONS, counts_of, days


def conflict_heatmap(
    events: DataFrame | None,
    quad: Sequence[int] = CONFLICT_CLASSES,
    daily: DataFrame | None = None,
    measures: DataFrame | None = None,
) -> DataFrame:
    """01: per day and action country over conflict events: mean Goldstein,
    event count and the sum of absolute Goldstein values.

    ``daily`` is an already built ``daily_measures`` base (its conflict
    classes apply), ``measures`` an ``event_measures`` roll-up; without either
    the base is built from ``events``.
    """
    if daily is None and measures is None:
        # Alone, only conflict rows are needed: the filter reaches the scan.
        events = events.filter(F.col("QuadClass").isin(*quad))
    base = daily_base(events, daily, measures, quad)
    return base.filter(F.col("n_conflict") > 0).select(
        "event_date",
        "country_code",
        mean("conflict_goldstein_sum", "conflict_goldstein_n").alias("avg_goldstein"),
        F.col("n_conflict").alias("conflict_events"),
        F.col("conflict_intensity").alias("intensity_score"),
    )


def _distinct_actor_countries(events: DataFrame) -> DataFrame:
    a, b = F.col("Actor1CountryCode"), F.col("Actor2CountryCode")
    return events.filter(a.isNotNull() & b.isNotNull() & (a != b))


def conflict_country_pairs(
    events: DataFrame | None,
    n: int = 50,
    quad: Sequence[int] = CONFLICT_CLASSES,
    codes: DataFrame | None = None,
) -> DataFrame:
    """08: the ``n`` most frequent unordered country pairs in conflict events.

    Ties on the count are broken by the pair, so the cut is deterministic.
    The final sort + limit plans as TakeOrderedAndProject (a per-partition
    top-n, then a merge), never a full sort.  ``codes`` here and below is an
    already built ``event_codes`` roll-up.
    """
    if codes is not None:
        pairs = counts_of(codes, PAIRS).filter(F.col("quad_class").isin(*quad)).groupBy("country_1", "country_2")
        counted = pairs.agg(F.sum("n").alias("conflict_count"))
    else:
        first, second = country_pair("Actor1CountryCode", "Actor2CountryCode")
        counted = (
            _distinct_actor_countries(events.filter(F.col("QuadClass").isin(*quad)))
            .groupBy(first.alias("country_1"), second.alias("country_2"))
            .agg(F.count(F.lit(1)).alias("conflict_count"))
        )
    return (
        counted
        .orderBy(F.desc("conflict_count"), "country_1", "country_2")
        .limit(n)
    )


def religion_conflict_clusters(
    events: DataFrame | None, quad: Sequence[int] = CONFLICT_CLASSES, codes: DataFrame | None = None
) -> DataFrame:
    """10: conflict events with a religion code (actor 1 first, else actor 2),
    counted by the region of the action country (NULL -> Other)."""
    if codes is not None:
        return (
            counts_of(codes, RELIGIONS).filter(F.col("quad_class").isin(*quad))
            .groupBy(F.coalesce("region", F.lit(OTHER)).alias("region"), "religion")
            .agg(F.sum("n").alias("conflict_count"))
        )
    r1, r2 = F.col("Actor1Religion1Code"), F.col("Actor2Religion1Code")
    return (
        events.filter(F.col("QuadClass").isin(*quad) & (r1.isNotNull() | r2.isNotNull()))
        .groupBy(region(COUNTRY).alias("region"), F.coalesce(r1, r2).alias("religion"))
        .agg(F.count(F.lit(1)).alias("conflict_count"))
    )


def diplomatic_conflict_graph(events: DataFrame | None, codes: DataFrame | None = None) -> DataFrame:
    """14: undirected, typed country-pair edge list with counts (no limit)."""
    if codes is not None:
        return (
            counts_of(codes, PAIRS)
            .groupBy("country_1", "country_2", interaction_type("quad_class").alias("interaction_type"))
            .agg(F.sum("n").alias("interaction_count"))
        )
    first, second = country_pair("Actor1CountryCode", "Actor2CountryCode")
    return (
        _distinct_actor_countries(events)
        .groupBy(
            first.alias("country_1"),
            second.alias("country_2"),
            interaction_type("QuadClass").alias("interaction_type"),
        )
        .agg(F.count(F.lit(1)).alias("interaction_count"))
    )


def ethnic_conflict_frequency(
    events: DataFrame | None,
    n: int = 30,
    quad: Sequence[int] = CONFLICT_CLASSES,
    codes: DataFrame | None = None,
) -> DataFrame:
    """16: the ``n`` most frequent ethnic codes (actor 1 first, else actor 2) in
    conflict events; ties broken by the code."""
    if codes is not None:
        rows = counts_of(codes, ETHNICITIES).filter(F.col("quad_class").isin(*quad)).groupBy("ethnicity")
        counted = rows.agg(F.sum("n").alias("conflict_count"))
    else:
        ethnicity = F.coalesce(F.col("Actor1EthnicCode"), F.col("Actor2EthnicCode"))
        counted = (
            events.filter(F.col("QuadClass").isin(*quad) & ethnicity.isNotNull())
            .groupBy(ethnicity.alias("ethnicity"))
            .agg(F.count(F.lit(1)).alias("conflict_count"))
        )
    return (
        counted
        .orderBy(F.desc("conflict_count"), "ethnicity")
        .limit(n)
    )


def quadclass_timeline(events: DataFrame | None, measures: DataFrame | None = None) -> DataFrame:
    """18: events per day, region (NULL country -> Other) and QuadClass (NULL kept).
    ``measures`` is an already built ``event_measures`` roll-up."""
    if measures is not None:
        return days(measures).groupBy(
            "event_date", region("country_code").alias("region"), F.col("quad_class").alias("QuadClass"),
        ).agg(F.sum("n_events").alias("event_count"))
    return events.groupBy(
        event_date("SQLDATE").alias("event_date"),
        region(COUNTRY).alias("region"),
        F.col("QuadClass"),
    ).agg(F.count(F.lit(1)).alias("event_count"))

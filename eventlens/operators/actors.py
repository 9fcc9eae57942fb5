"""Actor and event-type analyses: 04 CAMEO codes by region, 05 actor matrix."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.functions import actor_type, region
from eventlens.operators.rollup import ACTORS, CODES, COUNTRY, counts_of


def cameo_by_region(events: DataFrame | None, codes: DataFrame | None = None) -> DataFrame:
    """04: events with an action country, by region, base code and root code.
    ``codes`` here and below is an already built ``event_codes`` roll-up."""
    if codes is not None:
        return counts_of(codes, CODES).select(
            "region", F.col("base_code").alias("EventBaseCode"), F.col("root_code").alias("EventRootCode"),
            F.col("n").alias("event_count"))
    return (
        events.filter(F.col(COUNTRY).isNotNull())
        .groupBy(region(COUNTRY).alias("region"), F.col("EventBaseCode"), F.col("EventRootCode"))
        .agg(F.count(F.lit(1)).alias("event_count"))
    )


def actor_interaction_matrix(events: DataFrame | None, codes: DataFrame | None = None) -> DataFrame:
    """05: ordered pairs of actor types (NULL and unknown -> Other), no filter."""
    if codes is not None:
        return counts_of(codes, ACTORS).withColumnRenamed("n", "frequency")
    return events.groupBy(
        actor_type("Actor1Type1Code").alias("actor1_type"),
        actor_type("Actor2Type1Code").alias("actor2_type"),
    ).agg(F.count(F.lit(1)).alias("frequency"))

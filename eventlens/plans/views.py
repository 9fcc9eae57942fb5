"""Read-out views over result tables.

Each view reads a whole result table and shapes it the way the dashboard
shows it: top-n cuts, labels, pivots, rounding.  Where the dashboard took
"the first rows as they arrived", these views sort by the result's natural
key (stated per view), so the output is deterministic.

Small fixed cuts (5 regions, 8 codes, 10 rows...) are the feature here; the
lists they are taken from are computed in Spark from the full result.  The
few bounded side tables (at most n rows after a ``limit``) are broadcast.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def iso_dates(df: DataFrame) -> DataFrame:
    """DATE columns as ``yyyy-MM-dd`` text (lossless); other columns unchanged."""
    return df.select(*[
        F.date_format(f.name, "yyyy-MM-dd").alias(f.name) if isinstance(f.dataType, T.DateType)
        else F.col(f.name)
        for f in df.schema.fields
    ])


def _blank_nulls(df: DataFrame) -> DataFrame:
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns])


def result_page(df: DataFrame, order: list[str | Column], n: int = 500) -> DataFrame:
    """V1: the first ``n`` rows by ``order``, dates as ISO text."""
    return iso_dates(df.orderBy(*order).limit(n))


def result_summary(results: Mapping[str, DataFrame], run_record: DataFrame | None = None) -> DataFrame:
    """V2: row count per result plus a ``total`` row; with the run record, a
    ``last_run`` column holds the time of the latest run."""
    counts = None
    for name, df in results.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("result"), "row_count"
        )
        counts = one if counts is None else counts.unionByName(one)
    summary = counts.rollup("result").agg(F.sum("row_count").alias("row_count")).select(
        F.coalesce(F.col("result"), F.lit("total")).alias("result"), "row_count"
    )
    if run_record is None:
        return summary
    # A scalar subquery: the latest run time over the whole record.
    return summary.withColumn("last_run", run_record.agg(F.max("last_run")).scalar())


def country_totals(top_countries: DataFrame, n: int = 10) -> DataFrame:
    """V3: sum of the ranked daily counts per country; the ``n`` largest."""
    return (
        top_countries.groupBy("country_code")
        .agg(F.sum("event_count").alias("total_events"))
        .orderBy(F.desc("total_events"), "country_code")
        .limit(n)
    )


def heat_top(heatmap: DataFrame, n: int = 15) -> DataFrame:
    """V4: the ``n`` most intense (day, country) cells; NULL intensity as 0."""
    return (
        heatmap.select(
            "country_code", "event_date",
            F.abs(F.coalesce(F.col("avg_goldstein"), F.lit(0.0))).alias("goldstein_magnitude"),
            F.coalesce(F.col("intensity_score"), F.lit(0.0)).alias("intensity_score"),
        )
        .orderBy(F.desc("intensity_score"), "country_code", F.asc_nulls_first("event_date"))
        .limit(n)
        .transform(iso_dates)
    )


def pair_labels(pairs: DataFrame, n: int = 10) -> DataFrame:
    """V5: ``c1-c2`` labels of the ``n`` most frequent conflict pairs."""
    return (
        pairs.select(F.concat_ws("-", "country_1", "country_2").alias("pair"), "conflict_count")
        .orderBy(F.desc("conflict_count"), "pair")
        .limit(n)
    )


def _first_values(df: DataFrame, column: str, n: int) -> DataFrame:
    return df.select(column).distinct().orderBy(F.asc_nulls_first(column)).limit(n)


def class_by_region(timeline: DataFrame, regions: int = 5, classes=(1, 2, 3, 4)) -> DataFrame:
    """V6: events by region (first ``regions`` by name) and QuadClass, summed
    over all days; one column per class, missing -> 0; ``quad_null`` holds the
    events without a class."""
    chosen = F.broadcast(_first_values(timeline, "region", regions))
    wide = (
        timeline.join(chosen, "region", "left_semi")
        .groupBy("region")
        .agg(
            *[F.sum(F.when(F.col("QuadClass") == c, F.col("event_count"))).alias(f"quad_{c}") for c in classes],
            F.sum(F.when(F.col("QuadClass").isNull(), F.col("event_count"))).alias("quad_null"),
        )
    )
    return wide.fillna(0, subset=[*(f"quad_{c}" for c in classes), "quad_null"])


def code_by_region(cameo: DataFrame, regions: int = 5, codes: int = 8) -> DataFrame:
    """V7: region x base code grid (first ``regions`` by name, the ``codes``
    largest codes over them), missing cells 0, in long form."""
    chosen = F.broadcast(_first_values(cameo, "region", regions))
    sub = cameo.join(chosen, "region", "left_semi")
    top = (
        sub.groupBy("EventBaseCode").agg(F.sum("event_count").alias("_total"))
        .orderBy(F.desc("_total"), F.asc_nulls_first("EventBaseCode"))
        .limit(codes)
    )
    ranked = F.broadcast(
        top.withColumn("code_rank", F.row_number().over(
            Window.orderBy(F.desc("_total"), F.asc_nulls_first("EventBaseCode"))))
        .drop("_total")
    )
    ranks = [str(i) for i in range(1, codes + 1)]
    wide = (
        sub.join(
            ranked.withColumnRenamed("EventBaseCode", "_code"),
            F.col("EventBaseCode").eqNullSafe(F.col("_code")), "left",
        )
        .groupBy("region")
        .pivot("code_rank", list(range(1, codes + 1)))
        .agg(F.sum("event_count"))
        .fillna(0, subset=ranks)
    )
    long = wide.unpivot("region", ranks, "code_rank", "event_count").withColumn(
        "code_rank", F.col("code_rank").cast("int")
    )
    return long.join(ranked, "code_rank").select("region", "EventBaseCode", "event_count")


def tone_series(trend: DataFrame, countries: int = 5, days: int = 30) -> DataFrame:
    """V8: first ``days`` days of the first ``countries`` countries (by code);
    the moving average, else the daily mean (a 0 average is kept)."""
    chosen = F.broadcast(_first_values(trend, "country_code", countries))
    w = Window.partitionBy("country_code").orderBy(F.asc_nulls_first("event_date"))
    return (
        trend.join(chosen, "country_code", "left_semi")
        .withColumn("day_index", F.row_number().over(w))
        .filter(F.col("day_index") <= days)
        .select(
            "country_code", "day_index", "event_date",
            F.coalesce(F.col("moving_avg_7d"), F.col("daily_avg_tone")).alias("tone_value"),
        )
        .transform(iso_dates)
    )


def edge_rankings(graph: DataFrame, n: int = 8, types=("diplomatic", "conflict")) -> DataFrame:
    """V9: the ``n`` heaviest pairs of each interaction type."""
    w = Window.partitionBy("interaction_type").orderBy(
        F.desc("interaction_count"), "country_1", "country_2"
    )
    return (
        graph.filter(F.col("interaction_type").isin(*types))
        .withColumn("rank", F.row_number().over(w))
        .filter(F.col("rank") <= n)
        .select(
            "interaction_type", "rank",
            F.concat_ws("-", "country_1", "country_2").alias("pair"), "interaction_count",
        )
    )


def lag_top(lag: DataFrame, n: int = 10, digits: int = 3) -> DataFrame:
    """Non-NULL lag correlations, rounded, the ``n`` largest."""
    return (
        lag.filter(F.col("lag_correlation").isNotNull())
        .select("country_code", F.round("lag_correlation", digits).alias("lag_correlation"))
        .orderBy(F.desc("lag_correlation"), "country_code")
        .limit(n)
    )


# Simple tops ---------------------------------------------------------------

def top_ethnic(ethnic: DataFrame, n: int = 10) -> DataFrame:
    return ethnic.orderBy(F.desc("conflict_count"), "ethnicity").limit(n)


def top_coverage(coverage: DataFrame, n: int = 10, digits: int = 2) -> DataFrame:
    return (
        coverage.orderBy(F.desc_nulls_last("mentions_per_event_ratio"), "country_code")
        .limit(n)
        .select(
            "country_code",
            F.round(F.coalesce("mentions_per_event_ratio", F.lit(0.0)), digits).alias("mentions_per_event"),
        )
    )


def top_diversity(diversity: DataFrame, n: int = 10, digits: int = 2) -> DataFrame:
    return (
        diversity.orderBy(F.desc("diversity_index"), "country_code")
        .limit(n)
        .select("country_code", F.round("diversity_index", digits).alias("diversity_index"))
    )


def top_actor_pairs(matrix: DataFrame, n: int = 12) -> DataFrame:
    return (
        matrix.select(F.concat_ws("→", "actor1_type", "actor2_type").alias("pair"), "frequency")
        .orderBy(F.desc("frequency"), "pair")
        .limit(n)
    )


def top_themes(themes: DataFrame, n: int = 12, width: int = 30) -> DataFrame:
    return (
        themes.orderBy(F.desc("theme_count"), "theme_name", "continent", "year")
        .limit(n)
        .select(
            "continent", "year",
            F.substring("theme_name", 1, width).alias("theme_label"), "theme_count",
        )
    )


def top_org_names(orgs: DataFrame, n: int = 12, width: int = 25) -> DataFrame:
    return (
        orgs.orderBy(F.desc("mention_count"), "org_name", F.asc_nulls_first("event_date"))
        .limit(n)
        .select(
            "event_date", F.substring("org_name", 1, width).alias("org_label"), "mention_count"
        )
        .transform(iso_dates)
    )


# Tables of 50 --------------------------------------------------------------

def table_rows(df: DataFrame, columns: list[str], order: list[str | Column], n: int = 50) -> DataFrame:
    """First ``n`` rows by ``order``, chosen columns, NULL shown as ''."""
    return _blank_nulls(df.orderBy(*order).limit(n).select(*columns))


def religion_table(religion: DataFrame, n: int = 50) -> DataFrame:
    return table_rows(
        religion, ["region", "religion", "conflict_count"],
        ["region", F.desc("conflict_count"), F.asc_nulls_first("religion")], n,
    )


def breaking_table(breaking: DataFrame, n: int = 50) -> DataFrame:
    return table_rows(
        breaking, ["GLOBALEVENTID", "mention_hour", "hourly_mentions"],
        [F.asc_nulls_first("GLOBALEVENTID"), F.asc_nulls_first("mention_hour")], n,
    )


def escalation_table(escalation: DataFrame, n: int = 50) -> DataFrame:
    return table_rows(
        escalation, ["GLOBALEVENTID", "mention_hour", "hourly_mentions", "growth_rate"],
        [F.asc_nulls_first("GLOBALEVENTID"), F.asc_nulls_first("mention_hour"),
         F.asc_nulls_first("ActionGeo_CountryCode"), F.asc_nulls_first("EventCode")], n,
    )


# V13, V14 -----------------------------------------------------------------------

def correlation_card(corr: DataFrame) -> DataFrame:
    """The correlation row with NULL as 0, rounded 4 / 2 digits."""
    zero = F.lit(0.0)
    return corr.select(
        F.round(F.coalesce(F.col("correlation"), zero), 4).alias("correlation"),
        F.coalesce(F.col("sample_size"), F.lit(0)).alias("sample_size"),
        F.round(F.coalesce(F.col("avg_tone"), zero), 2).alias("avg_tone"),
        F.round(F.coalesce(F.col("avg_sources"), zero), 2).alias("avg_sources"),
    )


def hour_labels(density: DataFrame) -> DataFrame:
    """``h:00`` labels with the event count of each hour of day."""
    return density.select(
        "hour_utc",
        F.concat(F.col("hour_utc").cast("string"), F.lit(":00")).alias("hour_label"),
        "event_count",
    )

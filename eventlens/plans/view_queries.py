"""``view_<name>`` queries: a view over the analysis results of the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens.operators import ANALYSIS_NAMES
from eventlens.plans import views as V
from eventlens.plans.queries import _analysis

# view name -> (analyses it reads, shaping function over {name: result})
VIEWS: dict[str, tuple[tuple[str, ...], Callable[[dict[str, DataFrame]], DataFrame]]] = {
    "view_result_page": (
        ("conflict_heatmap",),
        lambda r: V.result_page(
            r["conflict_heatmap"], [F.asc_nulls_first("event_date"), "country_code"], 500
        ),
    ),
    "view_result_summary": (tuple(ANALYSIS_NAMES), lambda r: V.result_summary(r)),
    "view_country_totals": (("top_countries_events",), lambda r: V.country_totals(r["top_countries_events"])),
    "view_heat_top": (("conflict_heatmap",), lambda r: V.heat_top(r["conflict_heatmap"])),
    "view_pair_labels": (("conflict_country_pairs",), lambda r: V.pair_labels(r["conflict_country_pairs"])),
    "view_class_by_region": (("quadclass_timeline",), lambda r: V.class_by_region(r["quadclass_timeline"])),
    "view_code_by_region": (("cameo_by_region",), lambda r: V.code_by_region(r["cameo_by_region"])),
    "view_tone_series": (("sentiment_trend",), lambda r: V.tone_series(r["sentiment_trend"])),
    "view_edge_rankings": (
        ("diplomatic_conflict_graph",), lambda r: V.edge_rankings(r["diplomatic_conflict_graph"])
    ),
    "view_lag_top": (("tone_lag_analysis",), lambda r: V.lag_top(r["tone_lag_analysis"])),
    "view_top_ethnic": (("ethnic_conflict_frequency",), lambda r: V.top_ethnic(r["ethnic_conflict_frequency"])),
    "view_top_coverage": (("media_coverage",), lambda r: V.top_coverage(r["media_coverage"])),
    "view_top_diversity": (("source_diversity_index",), lambda r: V.top_diversity(r["source_diversity_index"])),
    "view_top_actor_pairs": (
        ("actor_interaction_matrix",), lambda r: V.top_actor_pairs(r["actor_interaction_matrix"])
    ),
    "view_top_themes": (("gkg_themes_by_continent",), lambda r: V.top_themes(r["gkg_themes_by_continent"])),
    "view_top_organizations": (("top_organizations",), lambda r: V.top_org_names(r["top_organizations"])),
    "view_religion_table": (
        ("religion_conflict_clusters",), lambda r: V.religion_table(r["religion_conflict_clusters"])
    ),
    "view_breaking_table": (("breaking_news",), lambda r: V.breaking_table(r["breaking_news"])),
    "view_escalation_table": (("escalation_events",), lambda r: V.escalation_table(r["escalation_events"])),
    "view_correlation_card": (
        ("tone_sources_correlation",), lambda r: V.correlation_card(r["tone_sources_correlation"])
    ),
    "view_hour_labels": (("hourly_event_density",), lambda r: V.hour_labels(r["hourly_event_density"])),
}


def _bind(name: str):
    needs, shape = VIEWS[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return shape({a: _analysis(a, spark, sf_dir) for a in needs})

    run.__name__ = name
    return run


def all_queries() -> dict:
    return {name: _bind(name) for name in VIEWS}

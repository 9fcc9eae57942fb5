"""The nineteen analyses, each a pure function of input DataFrames."""

from eventlens.operators.actors import actor_interaction_matrix, cameo_by_region
from eventlens.operators.conflict import (
    conflict_country_pairs,
    conflict_heatmap,
    diplomatic_conflict_graph,
    ethnic_conflict_frequency,
    quadclass_timeline,
    religion_conflict_clusters,
)
from eventlens.operators.daily import hourly_event_density, top_countries_events
from eventlens.operators.media import (
    media_coverage,
    sentiment_trend,
    source_diversity_index,
    tone_lag_analysis,
    tone_sources_correlation,
)
from eventlens.operators.mentions import breaking_news, escalation_events, escalation_hours
from eventlens.operators.text import gkg_themes_by_continent, top_organizations

# Registry (R1): name, function, required input tables, in run order.
ANALYSES = [
    ("conflict_heatmap", conflict_heatmap, ("events",)),
    ("top_countries_events", top_countries_events, ("events",)),
    ("tone_sources_correlation", tone_sources_correlation, ("events",)),
    ("cameo_by_region", cameo_by_region, ("events",)),
    ("actor_interaction_matrix", actor_interaction_matrix, ("events",)),
    ("media_coverage", media_coverage, ("events",)),
    ("sentiment_trend", sentiment_trend, ("events",)),
    ("conflict_country_pairs", conflict_country_pairs, ("events",)),
    ("escalation_events", escalation_events, ("mentions", "events")),
    ("religion_conflict_clusters", religion_conflict_clusters, ("events",)),
    ("gkg_themes_by_continent", gkg_themes_by_continent, ("gkg",)),
    ("top_organizations", top_organizations, ("gkg",)),
    ("tone_lag_analysis", tone_lag_analysis, ("events",)),
    ("diplomatic_conflict_graph", diplomatic_conflict_graph, ("events",)),
    ("source_diversity_index", source_diversity_index, ("mentions", "events")),
    ("ethnic_conflict_frequency", ethnic_conflict_frequency, ("events",)),
    ("breaking_news", breaking_news, ("mentions",)),
    ("quadclass_timeline", quadclass_timeline, ("events",)),
    ("hourly_event_density", hourly_event_density, ("events",)),
]

ANALYSIS_NAMES = [name for name, _, _ in ANALYSES]

__all__ = ["ANALYSES", "ANALYSIS_NAMES", "escalation_hours"] + [fn.__name__ for _, fn, _ in ANALYSES]

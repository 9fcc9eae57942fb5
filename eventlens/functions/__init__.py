"""Column functions (F1-F11) and their lookup tables."""

from eventlens.functions.columns import (
    actor_type,
    continent,
    continent_from_locations,
    country_pair,
    event_date,
    hour_utc,
    interaction_type,
    is_conflict,
    list_names,
    lookup,
    mention_hour,
    region,
    safe_corr,
)

__all__ = [
    "actor_type", "continent", "continent_from_locations", "country_pair",
    "event_date", "hour_utc", "interaction_type", "is_conflict", "list_names",
    "lookup", "mention_hour", "region", "safe_corr",
]

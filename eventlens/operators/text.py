"""Document annotation rankings: 11 themes by continent, 12 organisations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.operators.common import top_per_group
from eventlens.operators.rollup import organization_counts, theme_counts


def gkg_themes_by_continent(gkg: DataFrame | None, n: int = 20, themes: DataFrame | None = None) -> DataFrame:
    """11: theme occurrences (not documents) per continent and year; top ``n``
    per group, ties broken by name.  The empty name from a trailing ``;`` is
    counted like any other.

    The explode and the partial count run in one stage, so only
    (continent, year, theme) partial counts are shuffled, and the top-n filter
    is planned as WindowGroupLimit before the window's shuffle.  ``themes`` are
    already built ``theme_counts``.
    """
    counted = themes if themes is not None else theme_counts(gkg)
    return top_per_group(counted, ["continent", "year"], "theme_count", "theme_name", n)


def top_organizations(
    gkg: DataFrame | None, n: int = 20, min_length: int = 3, organizations: DataFrame | None = None
) -> DataFrame:
    """12: organisation names (at least ``min_length`` characters) per day of
    DATE; top ``n`` per day, ties broken by name.  ``organizations`` are
    already built ``organization_counts``."""
    counted = organizations if organizations is not None else organization_counts(gkg)
    counted = counted.filter(F.length("org_name") >= min_length)
    return top_per_group(counted, ["event_date"], "mention_count", "org_name", n)

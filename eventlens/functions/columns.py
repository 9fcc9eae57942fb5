"""Column functions shared by the analyses.

Every function returns a built-in Spark ``Column`` expression, so it stays
inside whole-stage codegen.  The ``try_`` forms are used wherever ANSI mode
would otherwise raise on malformed input (bad dates, empty hour fields,
constant inputs to a correlation).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventlens.functions.maps import (
    ACTOR_TYPE_LABELS,
    CONFLICT_CLASSES,
    CONTINENT_BY_COUNTRY,
    DIPLOMATIC_CLASSES,
    LOCATION_CONTINENT_RULES,
    OTHER,
    REGION_BY_COUNTRY,
)

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def event_date(col: ColumnOrName = "SQLDATE") -> Column:
    """a yyyyMMdd number (or text) -> DATE; malformed -> NULL."""
    return F.try_to_date(_col(col).cast("string"), "yyyyMMdd")


def lookup(col: ColumnOrName, mapping: Mapping[str, str], default: str = OTHER) -> Column:
    """Map lookup with a default for misses and NULL keys.

    The literal map is one constant-folded expression node (a key scan over
    a few dozen short codes per row) instead of a nest of one ``CASE WHEN``
    per code, and it costs one driver call to build.
    """
    literal = F.expr(map_literal_sql(mapping))
    return F.coalesce(F.try_element_at(literal, _col(col)), F.lit(default))


def _sql_string(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def map_literal_sql(mapping: Mapping[str, str]) -> str:
    """``map('k1', 'v1', ...)`` as one SQL expression: parsed once, instead
    of one driver round trip per literal."""
    return "map(" + ", ".join(f"{_sql_string(k)}, {_sql_string(v)}" for k, v in mapping.items()) + ")"


def region(col: ColumnOrName, mapping: Mapping[str, str] = REGION_BY_COUNTRY) -> Column:
    """country code -> world region, else ``Other``."""
    return lookup(col, mapping)


def continent(col: ColumnOrName, mapping: Mapping[str, str] = CONTINENT_BY_COUNTRY) -> Column:
    """country code -> continent, else ``Other``."""
    return lookup(col, mapping)


def actor_type(col: ColumnOrName, mapping: Mapping[str, str] = ACTOR_TYPE_LABELS) -> Column:
    """label of the three-letter prefix of an actor type code, else ``Other``.

    All keys have three letters, so "starts with a key" equals "the first three
    letters are a key".
    """
    return lookup(F.substring(_col(col), 1, 3), mapping)


def mention_hour(col: ColumnOrName = "MentionTimeDate") -> Column:
    """hour bucket ``yyyyMMddHH`` (first ten characters of the number)."""
    return F.substring(_col(col).cast("string"), 1, 10)


def hour_utc(col: ColumnOrName = "DATEADDED") -> Column:
    """hour of day from a yyyyMMddHHmmss number; malformed -> NULL."""
    return F.substring(_col(col).cast("string"), 9, 2).try_cast("int")


def list_names(col: ColumnOrName) -> Column:
    """``name,offset;name,offset;`` -> array of names.

    A trailing ``;`` yields an empty name, as the split keeps empty tails.
    Explode the result to get one row per name.
    """
    return F.transform(F.split(_col(col), ";"), lambda item: F.substring_index(item, ",", 1))


def country_pair(a: ColumnOrName, b: ColumnOrName) -> tuple[Column, Column]:
    """F8: the two codes in sorted order (callers filter NULL and equal codes)."""
    return F.least(_col(a), _col(b)), F.greatest(_col(a), _col(b))


def continent_from_locations(
    col: ColumnOrName = "Locations",
    rules: Iterable[tuple[str, list[str]]] = LOCATION_CONTINENT_RULES,
    sep: str = ",",
) -> Column:
    """first rule whose ``<sep>XX<sep>`` occurs in the text; else ``Other``."""
    c = _col(col)
    expr = None
    for label, codes in rules:
        hit = None
        for code in codes:
            test = c.contains(f"{sep}{code}{sep}")
            hit = test if hit is None else (hit | test)
        expr = F.when(hit, F.lit(label)) if expr is None else expr.when(hit, F.lit(label))
    return F.lit(OTHER) if expr is None else expr.otherwise(F.lit(OTHER))


def interaction_type(col: ColumnOrName = "QuadClass") -> Column:
    """QuadClass -> diplomatic / conflict / neutral (NULL -> neutral)."""
    c = _col(col)
    return (
        F.when(c.isin(*DIPLOMATIC_CLASSES), F.lit("diplomatic"))
        .when(c.isin(*CONFLICT_CLASSES), F.lit("conflict"))
        .otherwise(F.lit("neutral"))
    )


def is_conflict(col: ColumnOrName = "QuadClass") -> Column:
    return _col(col).isin(*CONFLICT_CLASSES)


def safe_corr(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Pearson correlation over rows where both values are present.

    Built-in ``corr`` raises DIVIDE_BY_ZERO under ANSI mode when one side is
    constant; this form returns NULL for a constant side, a single row or no
    rows.  It is still a plain (partially aggregatable) aggregate.
    """
    x, y = _col(a).cast("double"), _col(b).cast("double")
    both = x.isNotNull() & y.isNotNull()
    sx = F.stddev_pop(F.when(both, x))
    sy = F.stddev_pop(F.when(both, y))
    return F.try_divide(F.covar_pop(x, y), sx * sy)

"""Independent DuckDB SQL for every registered query.

These texts are the correctness oracle: written directly in SQL from the
stated semantics, over the same projections (``fixtures.cte_sql``).  Oracle
conventions (see the survey's test strategy):

* window orders say ``NULLS FIRST`` where Spark's ascending default does;
* ``row_number`` is cast to INTEGER (Spark's type), HUGEINT sums to BIGINT;
* correlations are rounded to 6 digits and NaN is read as NULL; the moving
  average to 9 digits (both engines sum the frame in a different order).
"""

from __future__ import annotations

import re

from eventlens.functions.maps import (
    ACTOR_TYPE_LABELS,
    CONTINENT_BY_COUNTRY,
    LOCATION_CONTINENT_RULES,
    REGION_BY_COUNTRY,
)
from eventlens.plans.fixtures import cte_sql

ANALYSIS_DATE = "2024-02-01"


def _case(expr: str, mapping: dict[str, str]) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"(CASE {expr} {whens} ELSE 'Other' END)"


def region_sql(col: str) -> str:
    return _case(col, REGION_BY_COUNTRY)


def continent_sql(col: str) -> str:
    return _case(col, CONTINENT_BY_COUNTRY)


def actor_sql(col: str) -> str:
    return _case(f"substr({col}, 1, 3)", ACTOR_TYPE_LABELS)


def locations_sql(col: str) -> str:
    whens = []
    for label, codes in LOCATION_CONTINENT_RULES:
        cond = " OR ".join(f"contains({col}, ',{c},')" for c in codes)
        whens.append(f"WHEN {cond} THEN '{label}'")
    return f"(CASE {' '.join(whens)} ELSE 'Other' END)"


def date_sql(col: str) -> str:
    return f"cast(try_strptime(cast({col} as varchar), '%Y%m%d') as date)"


def corr_sql(expr: str) -> str:
    # "+ 0.0" turns DuckDB's -0.0 into 0.0, as Spark's decimal round gives.
    return f"(round(CASE WHEN isnan({expr}) THEN NULL ELSE {expr} END, 6) + 0.0)"


CONFLICT = "QuadClass IN (3, 4)"
HAS_COUNTRY = "ActionGeo_CountryCode IS NOT NULL"
PAIR_FILTER = (
    "Actor1CountryCode IS NOT NULL AND Actor2CountryCode IS NOT NULL"
    " AND Actor1CountryCode <> Actor2CountryCode"
)

HOURLY = """
hourly AS (
 SELECT GLOBALEVENTID, substr(cast(MentionTimeDate as varchar), 1, 10) AS mention_hour,
        count(*) AS hourly_mentions
 FROM g_mentions GROUP BY 1, 2),
lagged AS (
 SELECT *, lag(hourly_mentions) OVER (PARTITION BY GLOBALEVENTID
                                      ORDER BY mention_hour ASC NULLS FIRST) AS prev
 FROM hourly)"""

# Bodies reference g_events / g_mentions / g_gkg.  A body may start with
# extra CTE definitions ("name AS (...), ...") and then a line starting with
# ``|`` that holds the final select.
_BODIES: dict[str, str] = {}

_BODIES["conflict_heatmap"] = f"""
SELECT {date_sql('SQLDATE')} AS event_date, ActionGeo_CountryCode AS country_code,
       avg(GoldsteinScale) AS avg_goldstein, count(*) AS conflict_events,
       sum(abs(GoldsteinScale)) AS intensity_score
FROM g_events WHERE {CONFLICT} AND {HAS_COUNTRY}
GROUP BY 1, 2"""

_BODIES["top_countries_events"] = f"""
daily AS (
 SELECT {date_sql('SQLDATE')} AS event_date, ActionGeo_CountryCode AS country_code,
        count(*) AS event_count
 FROM g_events WHERE {HAS_COUNTRY} GROUP BY 1, 2)
|SELECT event_date, country_code, event_count, rank FROM (
 SELECT *, cast(row_number() OVER (PARTITION BY event_date
                ORDER BY event_count DESC, country_code ASC) AS INTEGER) AS rank
 FROM daily) WHERE rank <= 10"""

_BODIES["tone_sources_correlation"] = f"""
SELECT {corr_sql('r')} AS correlation, sample_size, avg_tone, avg_sources,
       DATE '{ANALYSIS_DATE}' AS analysis_date
FROM (SELECT corr(AvgTone, NumSources) AS r, count(*) AS sample_size,
             avg(AvgTone) AS avg_tone, avg(NumSources) AS avg_sources FROM g_events)"""

_BODIES["cameo_by_region"] = f"""
SELECT {region_sql('ActionGeo_CountryCode')} AS region, EventBaseCode, EventRootCode,
       count(*) AS event_count
FROM g_events WHERE {HAS_COUNTRY} GROUP BY 1, 2, 3"""

_BODIES["actor_interaction_matrix"] = f"""
SELECT {actor_sql('Actor1Type1Code')} AS actor1_type, {actor_sql('Actor2Type1Code')} AS actor2_type,
       count(*) AS frequency
FROM g_events GROUP BY 1, 2"""

_BODIES["media_coverage"] = f"""
SELECT ActionGeo_CountryCode AS country_code, count(*) AS total_events,
       cast(sum(NumMentions) AS BIGINT) AS total_mentions,
       avg(NumMentions) AS avg_mentions_per_event,
       cast(sum(NumMentions) AS BIGINT) / count(*) AS mentions_per_event_ratio
FROM g_events WHERE {HAS_COUNTRY} GROUP BY 1"""

_BODIES["sentiment_trend"] = f"""
daily AS (
 SELECT {date_sql('SQLDATE')} AS event_date, ActionGeo_CountryCode AS country_code,
        avg(AvgTone) AS daily_avg_tone
 FROM g_events WHERE {HAS_COUNTRY} GROUP BY 1, 2)
|SELECT event_date, country_code, daily_avg_tone,
       round(avg(daily_avg_tone) OVER (PARTITION BY country_code ORDER BY event_date ASC NULLS FIRST
             ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 9) + 0.0 AS moving_avg_7d
FROM daily"""

_BODIES["conflict_country_pairs"] = f"""
SELECT least(Actor1CountryCode, Actor2CountryCode) AS country_1,
       greatest(Actor1CountryCode, Actor2CountryCode) AS country_2,
       count(*) AS conflict_count
FROM g_events WHERE {CONFLICT} AND {PAIR_FILTER}
GROUP BY 1, 2 ORDER BY conflict_count DESC, country_1, country_2 LIMIT 50"""

_BODIES["escalation_events"] = f"""{HOURLY},
grown AS (
 SELECT *, CASE WHEN prev > 0 THEN (hourly_mentions - prev) / prev ELSE 0.0::DOUBLE END
           AS growth_rate
 FROM lagged)
|SELECT g.GLOBALEVENTID, g.mention_hour, g.hourly_mentions, g.growth_rate,
       e.ActionGeo_CountryCode, e.EventCode
FROM grown g LEFT JOIN g_events e ON g.GLOBALEVENTID = e.GLOBALEVENTID
WHERE g.growth_rate > 2.0 AND g.hourly_mentions >= 10"""

_BODIES["religion_conflict_clusters"] = f"""
SELECT {region_sql('ActionGeo_CountryCode')} AS region,
       coalesce(Actor1Religion1Code, Actor2Religion1Code) AS religion,
       count(*) AS conflict_count
FROM g_events
WHERE {CONFLICT} AND (Actor1Religion1Code IS NOT NULL OR Actor2Religion1Code IS NOT NULL)
GROUP BY 1, 2"""

_BODIES["gkg_themes_by_continent"] = f"""
themes AS (
 SELECT {locations_sql('Locations')} AS continent, substr(cast(DATE AS varchar), 1, 4) AS year,
        unnest(string_split(V2Themes, ';')) AS theme
 FROM g_gkg WHERE V2Themes IS NOT NULL),
counts AS (
 SELECT continent, year, split_part(theme, ',', 1) AS theme_name, count(*) AS theme_count
 FROM themes GROUP BY 1, 2, 3)
|SELECT * FROM (
 SELECT *, cast(row_number() OVER (PARTITION BY continent, year
                ORDER BY theme_count DESC, theme_name ASC) AS INTEGER) AS rank
 FROM counts) WHERE rank <= 20"""

_BODIES["top_organizations"] = f"""
orgs AS (
 SELECT {date_sql('substr(cast(DATE AS varchar), 1, 8)')} AS event_date,
        unnest(string_split(V2Organizations, ';')) AS org
 FROM g_gkg WHERE V2Organizations IS NOT NULL),
counts AS (
 SELECT event_date, split_part(org, ',', 1) AS org_name, count(*) AS mention_count
 FROM orgs WHERE length(split_part(org, ',', 1)) > 2 GROUP BY 1, 2)
|SELECT * FROM (
 SELECT *, cast(row_number() OVER (PARTITION BY event_date
                ORDER BY mention_count DESC, org_name ASC) AS INTEGER) AS rank
 FROM counts) WHERE rank <= 20"""

_BODIES["tone_lag_analysis"] = f"""
daily AS (
 SELECT {date_sql('SQLDATE')} AS event_date, ActionGeo_CountryCode AS country_code,
        avg(AvgTone) AS avg_tone,
        cast(sum(CASE WHEN {CONFLICT} THEN 1 ELSE 0 END) AS BIGINT) AS conflict_count
 FROM g_events WHERE {HAS_COUNTRY} GROUP BY 1, 2),
paired AS (
 SELECT *, lead(conflict_count) OVER (PARTITION BY country_code
                                      ORDER BY event_date ASC NULLS FIRST) AS next_day_conflicts
 FROM daily)
|SELECT country_code, {corr_sql('r')} AS lag_correlation, observations
FROM (SELECT country_code, corr(avg_tone, next_day_conflicts) AS r, count(*) AS observations
      FROM paired WHERE next_day_conflicts IS NOT NULL GROUP BY 1)"""

_BODIES["diplomatic_conflict_graph"] = f"""
SELECT least(Actor1CountryCode, Actor2CountryCode) AS country_1,
       greatest(Actor1CountryCode, Actor2CountryCode) AS country_2,
       CASE WHEN QuadClass IN (1, 2) THEN 'diplomatic' WHEN {CONFLICT} THEN 'conflict'
            ELSE 'neutral' END AS interaction_type,
       count(*) AS interaction_count
FROM g_events WHERE {PAIR_FILTER} GROUP BY 1, 2, 3"""

_BODIES["source_diversity_index"] = f"""
SELECT e.country_code, count(DISTINCT m.MentionSourceName) AS unique_sources,
       count(*) AS total_mentions, count(DISTINCT m.GLOBALEVENTID) AS unique_events,
       count(DISTINCT m.MentionSourceName) / count(DISTINCT m.GLOBALEVENTID) AS diversity_index
FROM g_mentions m
JOIN (SELECT GLOBALEVENTID, ActionGeo_CountryCode AS country_code
      FROM g_events WHERE {HAS_COUNTRY}) e ON m.GLOBALEVENTID = e.GLOBALEVENTID
GROUP BY 1"""

_BODIES["ethnic_conflict_frequency"] = f"""
SELECT coalesce(Actor1EthnicCode, Actor2EthnicCode) AS ethnicity, count(*) AS conflict_count
FROM g_events WHERE {CONFLICT} AND coalesce(Actor1EthnicCode, Actor2EthnicCode) IS NOT NULL
GROUP BY 1 ORDER BY conflict_count DESC, ethnicity LIMIT 30"""

_BODIES["breaking_news"] = f"""{HOURLY}
|SELECT GLOBALEVENTID, mention_hour, hourly_mentions, true AS is_breaking_news
FROM lagged WHERE coalesce(prev, 0) = 0 AND hourly_mentions > 100"""

_BODIES["quadclass_timeline"] = f"""
SELECT {date_sql('SQLDATE')} AS event_date, {region_sql('ActionGeo_CountryCode')} AS region,
       QuadClass, count(*) AS event_count
FROM g_events GROUP BY 1, 2, 3"""

_BODIES["hourly_event_density"] = """
SELECT try_cast(substr(cast(DATEADDED AS varchar), 9, 2) AS INTEGER) AS hour_utc,
       count(*) AS event_count, avg(AvgTone) AS avg_tone, avg(GoldsteinScale) AS avg_goldstein
FROM g_events GROUP BY 1"""

_BODIES["continent"] = f"""
SELECT {continent_sql('ActionGeo_CountryCode')} AS continent, count(*) AS event_count
FROM g_events GROUP BY 1"""


_SLOT_TS = "try_strptime(cast(DATEADDED AS varchar), '%Y%m%d%H%M%S')"

_BODIES["ingest_events"] = """
SELECT *, substr(cast(DATEADDED AS varchar), 1, 8) || '000000' AS ts FROM g_events"""

_BODIES["ingest_stream_events"] = _BODIES["ingest_events"]
_BODIES["compacted_events"] = _BODIES["ingest_events"]
_BODIES["ingest_rejected_events"] = """
SELECT substr(cast(DATEADDED AS varchar), 1, 8) || '000000' AS ts,
       cast(count(*) FILTER (WHERE GLOBALEVENTID % 50 <> 0) AS BIGINT) AS accepted,
       cast(count(*) FILTER (WHERE GLOBALEVENTID % 50 = 0) AS BIGINT) AS rejected
FROM g_events GROUP BY 1"""

_BODIES["ingest_mentions"] = """
SELECT *, substr(cast(MentionTimeDate AS varchar), 1, 8) || '000000' AS ts FROM g_mentions"""

_BODIES["ingest_gkg"] = """
SELECT * REPLACE (cast(GKGRECORDID AS varchar) AS GKGRECORDID),
       substr(DATE, 1, 8) || '000000' AS ts
FROM g_gkg"""

_BODIES["ingest_archive_events"] = _BODIES["ingest_events"]
_BODIES["ingest_stream_mentions"] = _BODIES["ingest_mentions"]
_BODIES["ingest_stream_gkg"] = _BODIES["ingest_gkg"]

_BODIES["due_slots"] = f"""
obs AS (
 SELECT DISTINCT time_bucket(INTERVAL 15 MINUTE, {_SLOT_TS}) AS t
 FROM g_events WHERE {_SLOT_TS} IS NOT NULL),
expected AS (
 SELECT unnest(generate_series(hi - INTERVAL 15 MINUTE * 96, hi - INTERVAL 15 MINUTE, INTERVAL 15 MINUTE)) AS t
 FROM (SELECT max(t) AS hi FROM obs))
|SELECT strftime(t, '%Y%m%d%H%M%S') AS ts FROM expected WHERE t NOT IN (SELECT t FROM obs)"""

_BODIES["missing_slots"] = f"""
obs AS (
 SELECT DISTINCT time_bucket(INTERVAL 15 MINUTE, {_SLOT_TS}) AS t
 FROM g_events WHERE {_SLOT_TS} IS NOT NULL),
expected AS (
 SELECT unnest(generate_series(lo, hi, INTERVAL 15 MINUTE)) AS t
 FROM (SELECT min(t) AS lo, max(t) AS hi FROM obs))
|SELECT strftime(t, '%Y%m%d%H%M%S') AS ts FROM expected WHERE t NOT IN (SELECT t FROM obs)"""

_BODIES["retain_since"] = f"""
SELECT GLOBALEVENTID, cast(DATEADDED AS varchar) AS ts FROM g_events
WHERE {_SLOT_TS} IS NULL
   OR {_SLOT_TS} >= TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 72 HOUR"""


def _split(body: str) -> tuple[str, str]:
    if "\n|" in body:
        ctes, select = body.split("\n|", 1)
        return ctes.strip().rstrip(","), select
    return "", body


def analysis_cte(name: str) -> tuple[str, str]:
    """(extra CTE definitions, final select) of one analysis body."""
    return _split(_BODIES[name])


_LOCAL_CTES = ("daily", "hourly", "lagged", "grown", "themes", "counts", "orgs", "paired",
               "obs", "expected")
_LOCAL_RE = re.compile(r"\b(" + "|".join(_LOCAL_CTES) + r")\b")


def compose(*parts: tuple[str, str], final: str) -> str:
    """Full statement: projections, then each (extra ctes, 'name AS (select)')
    part, then ``final``."""
    ctes = [cte_sql()[len("WITH "):]]
    for extra, named in parts:
        ctes.extend(p for p in (extra, named) if p)
    return "WITH " + ",\n".join(ctes) + "\n" + final


def result_cte(name: str, alias: str | None = None) -> tuple[str, str]:
    """One analysis as a named CTE ``alias AS (...)``; its local CTE names get
    the alias as prefix so several analyses can share one statement."""
    alias = alias or name
    extra, select = analysis_cte(name)
    extra = _LOCAL_RE.sub(lambda m: f"{alias}__{m.group(1)}", extra)
    select = _LOCAL_RE.sub(lambda m: f"{alias}__{m.group(1)}", select)
    return extra, f"{alias} AS ({select})"


# DATE outputs of each analysis; the check form renders them as ISO text.
DATE_COLUMNS = {
    "conflict_heatmap": ["event_date"],
    "top_countries_events": ["event_date"],
    "tone_sources_correlation": ["analysis_date"],
    "sentiment_trend": ["event_date"],
    "top_organizations": ["event_date"],
    "quadclass_timeline": ["event_date"],
}


def analysis_sql(name: str) -> str:
    extra, select = analysis_cte(name)
    dates = DATE_COLUMNS.get(name)
    if dates:
        replaced = ", ".join(f"strftime({c}, '%Y-%m-%d') AS {c}" for c in dates)
        select = f"SELECT * REPLACE ({replaced}) FROM ({select})"
    return compose((extra, ""), final=select)


def all_sql() -> dict[str, str]:
    return {name: analysis_sql(name) for name in _BODIES}


# --- views: (analyses read, final select over them) --------------------------

def _first(table: str, column: str, n: int) -> str:
    return (f"(SELECT {column} FROM (SELECT DISTINCT {column} FROM {table}"
            f" ORDER BY {column} ASC NULLS FIRST LIMIT {n}))")


def _blank(cols: list[str]) -> str:
    return ", ".join(f"coalesce(cast({c} AS varchar), '') AS {c}" for c in cols)


_SUMMARY_UNION = " UNION ALL ".join(
    f"SELECT '{n}' AS result, count(*) AS row_count FROM {n}" for n in (
        "conflict_heatmap", "top_countries_events", "tone_sources_correlation", "cameo_by_region",
        "actor_interaction_matrix", "media_coverage", "sentiment_trend", "conflict_country_pairs",
        "escalation_events", "religion_conflict_clusters", "gkg_themes_by_continent",
        "top_organizations", "tone_lag_analysis", "diplomatic_conflict_graph",
        "source_diversity_index", "ethnic_conflict_frequency", "breaking_news",
        "quadclass_timeline", "hourly_event_density",
    )
)

_REGIONS5_CAMEO = _first("cameo_by_region", "region", 5)

VIEW_FINALS: dict[str, tuple[tuple[str, ...], str]] = {
    "view_result_page": (("conflict_heatmap",), """
SELECT strftime(event_date, '%Y-%m-%d') AS event_date, country_code, avg_goldstein,
       conflict_events, intensity_score
FROM (SELECT * FROM conflict_heatmap ORDER BY event_date ASC NULLS FIRST, country_code LIMIT 500)"""),
    "view_result_summary": (tuple(), f"""
SELECT result, row_count FROM ({_SUMMARY_UNION})
UNION ALL
SELECT 'total' AS result, cast(sum(row_count) AS BIGINT) AS row_count FROM ({_SUMMARY_UNION})"""),
    "view_country_totals": (("top_countries_events",), """
SELECT country_code, cast(sum(event_count) AS BIGINT) AS total_events FROM top_countries_events
GROUP BY 1 ORDER BY total_events DESC, country_code LIMIT 10"""),
    "view_heat_top": (("conflict_heatmap",), """
SELECT country_code, strftime(event_date, '%Y-%m-%d') AS event_date, goldstein_magnitude,
       intensity_score
FROM (SELECT country_code, event_date, abs(coalesce(avg_goldstein, 0.0)) AS goldstein_magnitude,
             coalesce(intensity_score, 0.0) AS intensity_score
      FROM conflict_heatmap
      ORDER BY coalesce(intensity_score, 0.0) DESC, country_code, event_date ASC NULLS FIRST
      LIMIT 15)"""),
    "view_pair_labels": (("conflict_country_pairs",), """
SELECT concat_ws('-', country_1, country_2) AS pair, conflict_count FROM conflict_country_pairs
ORDER BY conflict_count DESC, pair LIMIT 10"""),
    "view_class_by_region": (("quadclass_timeline",), f"""
SELECT region,
       {", ".join(f"cast(coalesce(sum(CASE WHEN QuadClass = {q} THEN event_count END), 0) AS BIGINT) AS quad_{q}"
                  for q in (1, 2, 3, 4))},
       cast(coalesce(sum(CASE WHEN QuadClass IS NULL THEN event_count END), 0) AS BIGINT) AS quad_null
FROM quadclass_timeline WHERE region IN {_first("quadclass_timeline", "region", 5)}
GROUP BY region"""),
    "view_code_by_region": (("cameo_by_region",), f"""
SELECT g.region, g.EventBaseCode, cast(coalesce(s.event_count, 0) AS BIGINT) AS event_count
FROM (SELECT r.region, c.EventBaseCode
      FROM {_REGIONS5_CAMEO} r
      CROSS JOIN (SELECT EventBaseCode FROM (
                    SELECT EventBaseCode, sum(event_count) AS total FROM cameo_by_region
                    WHERE region IN {_REGIONS5_CAMEO} GROUP BY 1)
                  ORDER BY total DESC, EventBaseCode ASC NULLS FIRST LIMIT 8) c) g
LEFT JOIN (SELECT region, EventBaseCode, sum(event_count) AS event_count
           FROM cameo_by_region GROUP BY 1, 2) s
  ON g.region = s.region AND g.EventBaseCode IS NOT DISTINCT FROM s.EventBaseCode"""),
    "view_tone_series": (("sentiment_trend",), f"""
SELECT country_code, day_index, strftime(event_date, '%Y-%m-%d') AS event_date, tone_value FROM (
 SELECT country_code, event_date, coalesce(moving_avg_7d, daily_avg_tone) AS tone_value,
        cast(row_number() OVER (PARTITION BY country_code ORDER BY event_date ASC NULLS FIRST)
             AS INTEGER) AS day_index
 FROM sentiment_trend WHERE country_code IN {_first("sentiment_trend", "country_code", 5)})
WHERE day_index <= 30"""),
    "view_edge_rankings": (("diplomatic_conflict_graph",), """
SELECT interaction_type, rank, concat_ws('-', country_1, country_2) AS pair, interaction_count
FROM (SELECT *, cast(row_number() OVER (PARTITION BY interaction_type
                     ORDER BY interaction_count DESC, country_1, country_2) AS INTEGER) AS rank
      FROM diplomatic_conflict_graph WHERE interaction_type IN ('diplomatic', 'conflict'))
WHERE rank <= 8"""),
    "view_lag_top": (("tone_lag_analysis",), """
SELECT country_code, r AS lag_correlation FROM (
 SELECT country_code, round(lag_correlation, 3) + 0.0 AS r FROM tone_lag_analysis
 WHERE lag_correlation IS NOT NULL)
ORDER BY r DESC, country_code LIMIT 10"""),
    "view_top_ethnic": (("ethnic_conflict_frequency",), """
SELECT ethnicity, conflict_count FROM ethnic_conflict_frequency
ORDER BY conflict_count DESC, ethnicity LIMIT 10"""),
    "view_top_coverage": (("media_coverage",), """
SELECT country_code, round(coalesce(r, 0.0), 2) + 0.0 AS mentions_per_event FROM (
 SELECT country_code, mentions_per_event_ratio AS r FROM media_coverage
 ORDER BY r DESC NULLS LAST, country_code LIMIT 10)"""),
    "view_top_diversity": (("source_diversity_index",), """
SELECT country_code, round(d, 2) + 0.0 AS diversity_index FROM (
 SELECT country_code, diversity_index AS d FROM source_diversity_index
 ORDER BY d DESC, country_code LIMIT 10)"""),
    "view_top_actor_pairs": (("actor_interaction_matrix",), """
SELECT concat_ws('→', actor1_type, actor2_type) AS pair, frequency FROM actor_interaction_matrix
ORDER BY frequency DESC, pair LIMIT 12"""),
    "view_top_themes": (("gkg_themes_by_continent",), """
SELECT continent, year, substr(theme_name, 1, 30) AS theme_label, theme_count FROM (
 SELECT * FROM gkg_themes_by_continent
 ORDER BY theme_count DESC, theme_name, continent, year LIMIT 12)"""),
    "view_top_organizations": (("top_organizations",), """
SELECT strftime(event_date, '%Y-%m-%d') AS event_date, substr(org_name, 1, 25) AS org_label,
       mention_count
FROM (SELECT * FROM top_organizations
      ORDER BY mention_count DESC, org_name, event_date ASC NULLS FIRST LIMIT 12)"""),
    "view_religion_table": (("religion_conflict_clusters",), f"""
SELECT {_blank(["region", "religion", "conflict_count"])} FROM (
 SELECT * FROM religion_conflict_clusters
 ORDER BY region ASC NULLS FIRST, conflict_count DESC, religion ASC NULLS FIRST LIMIT 50)"""),
    "view_breaking_table": (("breaking_news",), f"""
SELECT {_blank(["GLOBALEVENTID", "mention_hour", "hourly_mentions"])} FROM (
 SELECT * FROM breaking_news
 ORDER BY GLOBALEVENTID ASC NULLS FIRST, mention_hour ASC NULLS FIRST LIMIT 50)"""),
    "view_escalation_table": (("escalation_events",), f"""
SELECT {_blank(["GLOBALEVENTID", "mention_hour", "hourly_mentions", "growth_rate"])} FROM (
 SELECT * FROM escalation_events
 ORDER BY GLOBALEVENTID ASC NULLS FIRST, mention_hour ASC NULLS FIRST,
          ActionGeo_CountryCode ASC NULLS FIRST, EventCode ASC NULLS FIRST LIMIT 50)"""),
    "view_correlation_card": (("tone_sources_correlation",), """
SELECT round(coalesce(correlation, 0.0), 4) + 0.0 AS correlation,
       coalesce(sample_size, 0) AS sample_size,
       round(coalesce(avg_tone, 0.0), 2) + 0.0 AS avg_tone,
       round(coalesce(avg_sources, 0.0), 2) + 0.0 AS avg_sources
FROM tone_sources_correlation"""),
    "view_hour_labels": (("hourly_event_density",), """
SELECT hour_utc, cast(hour_utc AS varchar) || ':00' AS hour_label, event_count
FROM hourly_event_density"""),
}

_ALL_ANALYSES = (
    "conflict_heatmap", "top_countries_events", "tone_sources_correlation", "cameo_by_region",
    "actor_interaction_matrix", "media_coverage", "sentiment_trend", "conflict_country_pairs",
    "escalation_events", "religion_conflict_clusters", "gkg_themes_by_continent",
    "top_organizations", "tone_lag_analysis", "diplomatic_conflict_graph",
    "source_diversity_index", "ethnic_conflict_frequency", "breaking_news",
    "quadclass_timeline", "hourly_event_density",
)


def view_sql(name: str) -> str:
    needs, final = VIEW_FINALS[name]
    if name == "view_result_summary":
        needs = _ALL_ANALYSES
    return compose(*[result_cte(a) for a in needs], final=final)


def all_view_sql() -> dict[str, str]:
    out = {name: view_sql(name) for name in VIEW_FINALS}
    # An incremental run ends with the result over all rows.
    for name in ("conflict_heatmap", "escalation_events", "source_diversity_index"):
        out[f"incremental_{name}"] = analysis_sql(name)
    # The runner's written tables, counted, equal the summary of the analyses.
    out["run_all_summary"] = out["view_result_summary"]
    # The run record holds the same counts, one row per analysis.
    out["run_record"] = (
        "SELECT result AS analysis, CASE WHEN row_count > 0 THEN 'ok' ELSE 'empty' END AS status,"
        f" cast(row_count AS BIGINT) AS row_count FROM ({out['view_result_summary']}) WHERE result <> 'total'"
    )
    return out

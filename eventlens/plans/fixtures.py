"""Projections of the driver's test tables into the event-feed column names.

Each projection is one list of ``expr AS name`` items that is valid unchanged
in Spark SQL and in DuckDB.  The Spark side applies it with ``selectExpr`` on
the parquet scan (so Catalyst prunes unused items and the scan reads only the
source columns it needs); the oracle side wraps it as a CTE.  One text serves
both, so the check compares analyses, not two hand-kept copies of the inputs.

  g_events   <- events     (one coded event per row)
  g_mentions <- lineitem   (one mention per row; 40 hot events plus a tail)
  g_gkg      <- documents  (one annotated document per row)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

G_EVENTS = [
    "event_id AS GLOBALEVENTID",
    "cast(year(ts)*10000+month(ts)*100+day(ts) as bigint) AS SQLDATE",
    "cast(year(ts) as bigint)*10000000000+month(ts)*100000000+day(ts)*1000000+hour(ts)*10000"
    " AS DATEADDED",
    "nullif(substr('USAGBRCHNRUSIRNISRUKRSYR   ', cast(3*(event_id%9)+1 as int), 3),'   ')"
    " AS Actor1CountryCode",
    "nullif(substr('USAGBRCHNRUSIRNISRUKRSYR   ', cast(3*(user_id%9)+1 as int), 3),'   ')"
    " AS Actor2CountryCode",
    "nullif(substr('ARAKURPALZUL   ', cast(3*(event_id%5)+1 as int), 3),'   ') AS Actor1EthnicCode",
    "nullif(substr('ARAKURPALZUL   ', cast(3*(user_id%5)+1 as int), 3),'   ') AS Actor2EthnicCode",
    "nullif(substr('CHRMOSJEWHIN   ', cast(3*((event_id*3)%5)+1 as int), 3),'   ')"
    " AS Actor1Religion1Code",
    "nullif(substr('CHRMOSJEWHIN   ', cast(3*((user_id*2)%5)+1 as int), 3),'   ')"
    " AS Actor2Religion1Code",
    "nullif(substr('GOVMILREBOPPCVLMEDXYZ   ', cast(3*((event_id*5)%8)+1 as int), 3),'   ')"
    " AS Actor1Type1Code",
    "nullif(substr('GOVMILREBOPPCVLMEDXYZ   ', cast(3*((user_id*3)%8)+1 as int), 3),'   ')"
    " AS Actor2Type1Code",
    "cast(1+(event_id*7)%20 as string) AS EventRootCode",
    "concat(cast(1+(event_id*7)%20 as string), cast(user_id%4 as string)) AS EventBaseCode",
    "concat(cast(1+(event_id*7)%20 as string), cast(user_id%4 as string),"
    " cast(event_id%3 as string)) AS EventCode",
    "nullif((event_id*3+user_id)%5, 0) AS QuadClass",
    "((event_id*13)%41-20)/2.0e0 AS GoldsteinScale",
    "case when event_id%11=0 then null else 1+(event_id*3)%29 end AS NumMentions",
    "1+event_id%7 AS NumSources",
    "case when event_id%13=0 then null else ((event_id*37)%81-40)/4.0e0 end AS AvgTone",
    "nullif(substr('USCABRARGBDEFRRUCNINJPKREGNGZAKEAUNZUKXX  ',"
    " cast(2*((event_id*event_id+user_id)%21)+1 as int), 2),'  ') AS ActionGeo_CountryCode",
]

G_MENTIONS = [
    "case when l_linenumber=7 then 40+l_orderkey else l_orderkey%40 end AS GLOBALEVENTID",
    "(20240101+l_orderkey%40%28)*1000000"
    " + (l_orderkey%40%20"
    " + case when l_orderkey%2=0"
    " then (case when l_partkey%16=0 then 0 when l_partkey%16<6 then 1 else 2 end)"
    " else (case when l_partkey%16<12 then 0 else 3 end) end)*10000"
    " + l_linenumber*700 AS MentionTimeDate",
    "concat('src', cast(l_suppkey%50 as string)) AS MentionSourceName",
]

G_GKG = [
    "doc_id AS GKGRECORDID",
    "concat(cast(20230101+10000*(doc_id%2)+doc_id%28 as string),'120000') AS DATE",
    "case when doc_id%17=0 then null else concat('T',cast(doc_id%9 as string),',',"
    "cast(n_chars as string),';T',cast((doc_id*5)%40 as string),',7;') end AS V2Themes",
    "case when doc_id%7=0 then null else concat('1#x,', substr('USCABRGBDEFRCNINJPNGZAEGAUMX',"
    " cast(2*(doc_id%14)+1 as int),2), ',#0') end AS Locations",
    "case when doc_id%19=0 then null else concat('Org',cast(doc_id%31 as string),',12;ab,3;Org',"
    "cast((doc_id*3)%23 as string),',9;') end AS V2Organizations",
]

# feed table -> (source table, select items)
PROJECTIONS = {
    "events": ("events", G_EVENTS),
    "mentions": ("lineitem", G_MENTIONS),
    "gkg": ("documents", G_GKG),
}


def project(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """The projected feed table ``table`` read from ``sf_dir``."""
    source, items = PROJECTIONS[table]
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{source}.parquet").selectExpr(*items)


def inputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: project(spark, sf_dir, name) for name in PROJECTIONS}


def cte_sql() -> str:
    """``WITH`` clause defining g_events, g_mentions, g_gkg for DuckDB."""
    parts = []
    for table, (source, items) in PROJECTIONS.items():
        body = ",\n  ".join(items)
        parts.append(f"g_{table} AS (\n SELECT {body}\n FROM {source})")
    return "WITH " + ",\n".join(parts)

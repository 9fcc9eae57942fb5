"""Wire schemas of the three event feeds and their typed Spark form.

The raw files are tab-separated with no header, so the column order is the
contract.  Each coded integer becomes BIGINT and each measured value DOUBLE;
everything else stays STRING.  Fixing the types here (instead of inferring them
per file) keeps every ingested slot readable together.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: column names and order of the public event-feed format ---
EVENTS_COLUMNS = [
    "GLOBALEVENTID", "SQLDATE", "MonthYear", "Year", "FractionDate",
    "Actor1Code", "Actor1Name", "Actor1CountryCode", "Actor1KnownGroupCode",
    "Actor1EthnicCode", "Actor1Religion1Code", "Actor1Religion2Code",
    "Actor1Type1Code", "Actor1Type2Code", "Actor1Type3Code",
    "Actor2Code", "Actor2Name", "Actor2CountryCode", "Actor2KnownGroupCode",
    "Actor2EthnicCode", "Actor2Religion1Code", "Actor2Religion2Code",
    "Actor2Type1Code", "Actor2Type2Code", "Actor2Type3Code",
    "IsRootEvent", "EventCode", "EventBaseCode", "EventRootCode", "QuadClass",
    "GoldsteinScale", "NumMentions", "NumSources", "NumArticles", "AvgTone",
    "Actor1Geo_Type", "Actor1Geo_FullName", "Actor1Geo_CountryCode",
    "Actor1Geo_ADM1Code", "Actor1Geo_ADM2Code", "Actor1Geo_Lat",
    "Actor1Geo_Long", "Actor1Geo_FeatureID",
    "Actor2Geo_Type", "Actor2Geo_FullName", "Actor2Geo_CountryCode",
    "Actor2Geo_ADM1Code", "Actor2Geo_ADM2Code", "Actor2Geo_Lat",
    "Actor2Geo_Long", "Actor2Geo_FeatureID",
    "ActionGeo_Type", "ActionGeo_FullName", "ActionGeo_CountryCode",
    "ActionGeo_ADM1Code", "ActionGeo_ADM2Code", "ActionGeo_Lat",
    "ActionGeo_Long", "ActionGeo_FeatureID",
    "DATEADDED", "SOURCEURL",
]

MENTIONS_COLUMNS = [
    "GLOBALEVENTID", "EventTimeDate", "MentionTimeDate", "MentionType",
    "MentionSourceName", "MentionIdentifier", "SentenceID",
    "Actor1CharOffset", "Actor2CharOffset", "ActionCharOffset",
    "InRawText", "Confidence", "MentionDocLen", "MentionDocTone",
    "MentionDocTranslationInfo", "Extras",
]

GKG_COLUMNS = [
    "GKGRECORDID", "DATE", "SourceCollectionIdentifier", "SourceCommonName",
    "DocumentIdentifier", "Counts", "V2Counts", "Themes", "V2Themes",
    "Locations", "V2Locations", "Persons", "V2Persons", "Organizations",
    "V2Organizations", "V2Tone", "Dates", "GCAM", "SharingImage",
    "RelatedImages", "SocialImageEmbeds", "SocialVideoEmbeds", "Quotations",
    "AllNames", "Amounts", "TranslationInfo", "Extras",
]

# Numeric columns, split by the width we give them.
EVENTS_DOUBLE = {
    "FractionDate", "GoldsteinScale", "AvgTone",
    "Actor1Geo_Lat", "Actor1Geo_Long", "Actor2Geo_Lat", "Actor2Geo_Long",
    "ActionGeo_Lat", "ActionGeo_Long",
}
EVENTS_BIGINT = {
    "GLOBALEVENTID", "SQLDATE", "MonthYear", "Year", "IsRootEvent",
    "QuadClass", "NumMentions", "NumSources", "NumArticles",
    "Actor1Geo_Type", "Actor2Geo_Type", "ActionGeo_Type", "DATEADDED",
}
MENTIONS_DOUBLE = {"MentionDocTone"}
MENTIONS_BIGINT = {
    "GLOBALEVENTID", "EventTimeDate", "MentionTimeDate", "MentionType",
    "SentenceID", "Actor1CharOffset", "Actor2CharOffset", "ActionCharOffset",
    "InRawText", "Confidence", "MentionDocLen",
}
# --- end of fixed values ---

TABLE_COLUMNS = {
    "events": EVENTS_COLUMNS,
    "mentions": MENTIONS_COLUMNS,
    "gkg": GKG_COLUMNS,
}
TABLE_BIGINT = {"events": EVENTS_BIGINT, "mentions": MENTIONS_BIGINT, "gkg": set()}
TABLE_DOUBLE = {"events": EVENTS_DOUBLE, "mentions": MENTIONS_DOUBLE, "gkg": set()}

# Columns added by ingest: the slot stamp and the partition column.
LOAD_COLUMNS = ("load_timestamp", "ts")


def column_type(table: str, name: str) -> T.DataType:
    if name in TABLE_BIGINT[table]:
        return T.LongType()
    if name in TABLE_DOUBLE[table]:
        return T.DoubleType()
    return T.StringType()


def table_schema(table: str, with_load_columns: bool = True) -> T.StructType:
    """Typed schema of an ingested table (optionally with ``load_timestamp`` and ``ts``)."""
    fields = [T.StructField(c, column_type(table, c), True) for c in TABLE_COLUMNS[table]]
    if with_load_columns:
        fields += [T.StructField(c, T.StringType(), True) for c in LOAD_COLUMNS]
    return T.StructType(fields)


EVENTS_SCHEMA = table_schema("events")
MENTIONS_SCHEMA = table_schema("mentions")
GKG_SCHEMA = table_schema("gkg")

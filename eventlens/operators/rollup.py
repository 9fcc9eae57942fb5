"""Roll-ups: what one pass over a feed leaves behind for many analyses.

Each roll-up holds sums, counts and extremes, so rows of several passes (one
per landed file, say) merge by adding up; ``by`` names further columns to keep
apart.  ``merge_*`` adds the rows of all passes together.

* ``event_measures``: one pass over events for 01, 02, 03, 06, 07, 13, 18 (by
  day, action country and class) and 19 (by hour of day), as grouping sets.
* ``event_codes``: one pass for the counts by code, actor and country pair of
  04, 05, 08, 10, 14 and 16, as grouping sets.
* ``mention_hours`` and ``mention_sources``: mentions per event and hour (09,
  17), per event and source (15).
* ``country_bits`` and ``mentioned_bits``: distinct event ids as bitmaps (15).
* ``theme_counts`` and ``organization_counts`` (11, 12).

Every pass aggregates map-side before its one shuffle, and a grouping set's
rows carry the number of their set in ``kind``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlens.functions import (
    actor_type, continent_from_locations, country_pair, event_date, hour_utc, list_names, mention_hour, region,
)
from eventlens.functions.maps import CONFLICT_CLASSES

COUNTRY = "ActionGeo_CountryCode"

MEASURE_KEYS = ["event_date", "country_code", "quad_class", "hour_utc"]
DAYS, HOURS = "day", "hour"
#: Measures that add up; ``pair_*`` are over rows with both tone and sources.
SUMS = [
    "n_events", "goldstein_sum", "goldstein_n", "goldstein_abs", "tone_sum", "tone_n", "mentions_sum", "mentions_n",
    "sources_sum", "sources_n", "pair_n", "pair_tone", "pair_sources", "pair_tone_squares", "pair_sources_squares",
    "pair_products",
]
LOWS, HIGHS = ["tone_low", "sources_low"], ["tone_high", "sources_high"]

CODE_KEYS = ["region", "base_code", "root_code", "actor1_type", "actor2_type", "country_1", "country_2", "religion",
             "ethnicity", "quad_class"]
CODES, ACTORS, PAIRS, RELIGIONS, ETHNICITIES = "codes", "actors", "pairs", "religions", "ethnicities"
CODE_SETS = {
    CODES: ["region", "base_code", "root_code"],
    ACTORS: ["actor1_type", "actor2_type"],
    PAIRS: ["country_1", "country_2", "quad_class"],
    RELIGIONS: ["region", "religion", "quad_class"],
    ETHNICITIES: ["ethnicity", "quad_class"],
}


def _kind(keys: Sequence[str], sets: dict[str, list[str]]) -> Column:
    """Name of the grouping set: ``grouping_id`` has a bit per key left out."""
    out = None
    for name, members in sets.items():
        bits = sum(1 << (len(keys) - 1 - i) for i, key in enumerate(keys) if key not in members)
        test = F.col("_set") == bits
        out = F.when(test, F.lit(name)) if out is None else out.when(test, F.lit(name))
    return out


def _by_sets(rows: DataFrame, keys: list[str], sets: dict[str, list[str]], by: Sequence[str], *aggs: Column) -> DataFrame:
    grouped = rows.groupingSets([[*by, *members] for members in sets.values()], *by, *keys)
    found = grouped.agg(F.grouping_id(*by, *keys).alias("_set"), *aggs)
    return found.withColumn("kind", _kind([*by, *keys], {k: [*by, *v] for k, v in sets.items()})).drop("_set")


def event_measures(events: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per day, country and class (``kind`` day) and per hour of day (``kind``
    hour): every measure of 01, 02, 03, 06, 07, 13, 18 and 19."""
    tone, sources, goldstein = F.col("AvgTone"), F.col("NumSources").cast("double"), F.col("GoldsteinScale")
    rows = events.select(
        *by, event_date("SQLDATE").alias("event_date"), F.col(COUNTRY).alias("country_code"),
        F.col("QuadClass").alias("quad_class"), hour_utc("DATEADDED").alias("hour_utc"),
        goldstein.alias("g"), tone.alias("t"), sources.alias("s"), F.col("NumMentions").alias("m"),
        F.when(sources.isNotNull(), tone).alias("x"), F.when(tone.isNotNull(), sources).alias("y"),
    )
    return _by_sets(
        rows, MEASURE_KEYS, {DAYS: MEASURE_KEYS[:3], HOURS: MEASURE_KEYS[3:]}, by,
        F.count(F.lit(1)).alias("n_events"),
        F.sum("g").alias("goldstein_sum"), F.count("g").alias("goldstein_n"), F.sum(F.abs("g")).alias("goldstein_abs"),
        F.sum("t").alias("tone_sum"), F.count("t").alias("tone_n"),
        F.sum("m").alias("mentions_sum"), F.count("m").alias("mentions_n"),
        F.sum("s").alias("sources_sum"), F.count("s").alias("sources_n"),
        F.count("x").alias("pair_n"), F.sum("x").alias("pair_tone"), F.sum("y").alias("pair_sources"),
        F.sum(F.col("x") * F.col("x")).alias("pair_tone_squares"),
        F.sum(F.col("y") * F.col("y")).alias("pair_sources_squares"),
        F.sum(F.col("x") * F.col("y")).alias("pair_products"),
        F.min("x").alias("tone_low"), F.min("y").alias("sources_low"),
        F.max("x").alias("tone_high"), F.max("y").alias("sources_high"),
    )


def merge_measures(measures: DataFrame) -> DataFrame:
    return measures.groupBy("kind", *MEASURE_KEYS).agg(
        *(F.sum(c).alias(c) for c in SUMS), *(F.min(c).alias(c) for c in LOWS), *(F.max(c).alias(c) for c in HIGHS))


def days(measures: DataFrame) -> DataFrame:
    return measures.filter(F.col("kind") == DAYS)


def daily_of(measures: DataFrame, quad: Sequence[int] = CONFLICT_CLASSES) -> DataFrame:
    """The base of ``daily_measures`` (day x country) from ``event_measures``."""
    conflict = F.col("quad_class").isin(*quad)

    def of_conflict(name: str) -> Column:
        return F.sum(F.when(conflict, F.col(name)))

    return (
        days(measures).filter(F.col("country_code").isNotNull()).groupBy("event_date", "country_code").agg(
            F.sum("n_events").alias("n_events"),
            F.coalesce(of_conflict("n_events"), F.lit(0)).alias("n_conflict"),
            of_conflict("goldstein_sum").alias("conflict_goldstein_sum"),
            F.coalesce(of_conflict("goldstein_n"), F.lit(0)).alias("conflict_goldstein_n"),
            of_conflict("goldstein_abs").alias("conflict_intensity"),
            F.sum("tone_sum").alias("tone_sum"), F.sum("tone_n").alias("tone_n"),
        )
    )


def event_codes(events: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``n`` events per grouping set of ``CODE_SETS``.  Rows that a set's
    analyses leave out (no action country, no pair of different countries, no
    religion or ethnicity) are under its NULL keys: see ``counts_of``."""
    a, b = F.col("Actor1CountryCode"), F.col("Actor2CountryCode")
    first, second = country_pair(a, b)
    rows = events.select(
        *by,
        # NULL, unlike region(), without an action country; 10 wants Other there
        F.when(F.col(COUNTRY).isNotNull(), region(COUNTRY)).alias("region"),
        F.col("EventBaseCode").alias("base_code"), F.col("EventRootCode").alias("root_code"),
        actor_type("Actor1Type1Code").alias("actor1_type"), actor_type("Actor2Type1Code").alias("actor2_type"),
        F.when(a != b, first).alias("country_1"), F.when(a != b, second).alias("country_2"),
        F.coalesce("Actor1Religion1Code", "Actor2Religion1Code").alias("religion"),
        F.coalesce("Actor1EthnicCode", "Actor2EthnicCode").alias("ethnicity"),
        F.col("QuadClass").alias("quad_class"),
    )
    return _by_sets(rows, CODE_KEYS, CODE_SETS, by, F.count(F.lit(1)).alias("n"))


#: The key without which a row of a set takes part in none of its analyses.
REQUIRED = {CODES: "region", PAIRS: "country_1", RELIGIONS: "religion", ETHNICITIES: "ethnicity"}


def merge_codes(codes: DataFrame) -> DataFrame:
    return codes.groupBy("kind", *CODE_KEYS).agg(F.sum("n").alias("n"))


def counts_of(codes: DataFrame, kind: str) -> DataFrame:
    """The rows of one grouping set that its analyses count."""
    rows = codes.filter(F.col("kind") == kind)
    if kind in REQUIRED:
        rows = rows.filter(F.col(REQUIRED[kind]).isNotNull())
    return rows.select(*CODE_SETS[kind], "n")


def event_keys(events: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The columns of events that 09 and 15 look up, row by row."""
    return events.select(*by, "GLOBALEVENTID", COUNTRY, "EventCode")


def mention_hours(mentions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return mentions.groupBy(*by, "GLOBALEVENTID", mention_hour("MentionTimeDate").alias("mention_hour")).agg(
        F.count(F.lit(1)).alias("hourly_mentions"))


def merge_hours(hours: DataFrame) -> DataFrame:
    return hours.groupBy("GLOBALEVENTID", "mention_hour").agg(F.sum("hourly_mentions").alias("hourly_mentions"))


def mention_sources(mentions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return mentions.groupBy(*by, "GLOBALEVENTID", "MentionSourceName").agg(F.count(F.lit(1)).alias("n_mentions"))


def merge_sources(sources: DataFrame) -> DataFrame:
    return sources.groupBy("GLOBALEVENTID", "MentionSourceName").agg(F.sum("n_mentions").alias("n_mentions"))


def _bits(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``bucket, bits``: the distinct event ids of each group of ``keys`` as
    bitmaps of 32,768 consecutive ids; bitmaps of several passes merge by OR."""
    ids = rows.filter(F.col("GLOBALEVENTID").isNotNull()).withColumns({
        "bucket": F.bitmap_bucket_number("GLOBALEVENTID"), "place": F.bitmap_bit_position("GLOBALEVENTID")})
    return ids.groupBy(*keys, "bucket").agg(F.bitmap_construct_agg("place").alias("bits"))


def country_bits(events: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Distinct event ids per action country."""
    rows = events.filter(F.col(COUNTRY).isNotNull())
    return _bits(rows.select(*by, "GLOBALEVENTID", F.col(COUNTRY).alias("country_code")), [*by, "country_code"])


def mentioned_bits(mentions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Distinct ids of mentioned events."""
    return _bits(mentions.select(*by, "GLOBALEVENTID"), list(by))


def merge_bits(bits: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return bits.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_mentioned_events(countries: DataFrame, mentioned: DataFrame) -> DataFrame:
    """``country_code, unique_events``: distinct events of each country that
    have a mention.  Both sides are shuffled by bucket, as bitmaps."""
    pairs = countries.join(mentioned.withColumnRenamed("bits", "other"), "bucket")
    both = pairs.select("country_code", "bucket", F.explode(F.array("bits", "other")).alias("bits"))
    met = both.groupBy("country_code", "bucket").agg(F.bitmap_count(F.bitmap_and_agg("bits")).alias("n"))
    return met.groupBy("country_code").agg(F.sum("n").alias("unique_events")).filter("unique_events > 0")


def theme_counts(gkg: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Theme occurrences per continent and year; the explode and the partial
    count run in one stage."""
    names = gkg.filter(F.col("V2Themes").isNotNull()).select(
        *by, continent_from_locations("Locations").alias("continent"),
        F.substring(F.col("DATE").cast("string"), 1, 4).alias("year"),
        F.explode(list_names("V2Themes")).alias("theme_name"),
    )
    return names.groupBy(*by, "continent", "year", "theme_name").agg(F.count(F.lit(1)).alias("theme_count"))


def merge_themes(themes: DataFrame) -> DataFrame:
    return themes.groupBy("continent", "year", "theme_name").agg(F.sum("theme_count").alias("theme_count"))


def organization_counts(gkg: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Organisation names per day of DATE, of any length."""
    names = gkg.filter(F.col("V2Organizations").isNotNull()).select(
        *by, event_date(F.substring(F.col("DATE").cast("string"), 1, 8)).alias("event_date"),
        F.explode(list_names("V2Organizations")).alias("org_name"),
    )
    return names.groupBy(*by, "event_date", "org_name").agg(F.count(F.lit(1)).alias("mention_count"))


def merge_organizations(counts: DataFrame) -> DataFrame:
    return counts.groupBy("event_date", "org_name").agg(F.sum("mention_count").alias("mention_count"))

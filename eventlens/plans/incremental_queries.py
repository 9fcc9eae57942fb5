"""Queries that exercise the incremental run and compaction on the test tables.

The projected feeds are delivered twice, one file per slot: first some slots
whole, some cut short and some not at all; then the short and the absent ones
whole.  What a query returns must equal the result over the whole projection.

* ``incremental_<analysis>``: ``run_incremental`` after each delivery.
* ``compacted_events``: the events table, compacted between the deliveries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens.operators import ANALYSES
from eventlens.plans import fixtures
from eventlens.plans.incremental import PARTIALS, run_incremental
from eventlens.plans.ingest_queries import _projected_columns, to_lines
from eventlens.plans.views import iso_dates
from eventlens.session import scratch_path, write_and_read
from eventlens.sources.delimited import parse_lines
from eventlens.sources.ingest import FEED_SUFFIXES
from eventlens.sources.sinks import read_result
from eventlens.sources.tables import compact, load_table, write_slots

INCREMENTAL = ("conflict_heatmap", "escalation_events", "source_diversity_index")


#: Bytes, compressed, of a row group of the landed lines.  Tasks are dealt whole row groups,
#: and the default of 128 MB holds millions of lines, all parsed in one task.
LANDED_ROW_GROUP = 2 << 20


def landed(spark: SparkSession, sf_dir: str, feed: str) -> DataFrame:
    """The lines of a feed, written once for both of its deliveries."""
    lines = to_lines(fixtures.project(spark, sf_dir, feed), feed)
    return write_and_read(
        lines, scratch_path(spark, f"landing-{feed}"), **{"parquet.block.size": str(LANDED_ROW_GROUP)})


def deliver(lines: DataFrame, tables: str, feed: str, first: bool) -> None:
    """The first or the second delivery of a feed's landed lines."""
    third = F.substring("slot", 7, 2).cast("int") % 3  # by day of the month
    if first:  # whole; cut short; absent
        lines = lines.where((third == 0) | ((third == 1) & (F.pmod(F.xxhash64("value"), F.lit(2)) == 0)))
    else:
        lines = lines.where(third > 0)
    named = lines.withColumn("ts", F.col("slot")).withColumn(
        "source_file", F.concat(F.lit("/landing/"), "slot", F.lit(FEED_SUFFIXES[feed])))
    write_slots(parse_lines(named, feed, keep=("ts", "source_file")), tables, feed)


def incremental_result(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    base = scratch_path(spark, f"incremental-{name}")
    tables, partials, out = (f"{base}/{d}" for d in ("tables", "partials", "out"))
    chosen = [a for a in ANALYSES if a[0] == name]
    feeds = [f for f in PARTIALS if f == "events" or f in chosen[0][2]]
    lines = {feed: landed(spark, sf_dir, feed) for feed in feeds}
    for first in (True, False):
        for feed in feeds:
            deliver(lines[feed], tables, feed, first)
        statuses = run_incremental(spark, tables, partials, out, analyses=chosen)
        if statuses[0]["status"] == "failed":
            raise RuntimeError(f"analysis failed: {statuses}")
    return iso_dates(read_result(spark, out, name))


def compacted_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = f"{scratch_path(spark, 'compacted')}/tables"
    lines = landed(spark, sf_dir, "events")
    deliver(lines, tables, "events", first=True)
    newest = load_table(spark, tables, "events").agg(F.max("ts")).first()[0]
    if newest:
        compact(spark, tables, "events", before=newest)
    deliver(lines, tables, "events", first=False)
    return load_table(spark, tables, "events").select(*_projected_columns("events"), "ts")


def all_queries() -> dict:
    out = {f"incremental_{n}": (lambda n: lambda spark, sf: incremental_result(spark, sf, n))(n) for n in INCREMENTAL}
    return out | {"compacted_events": compacted_events}

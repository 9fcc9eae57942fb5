"""Queries that exercise ingest, slots and retention on the test tables.

* ``ingest_<table>``: the projected feed is written by Spark as raw
  tab-separated text (one landing file per slot, 61/16/27 fields, missing
  columns empty), then read back through the delimited scan, typed coercion,
  the slot-partitioned write and ``load_table``.  The result must equal the
  projection itself, with ``ts`` = the slot stamp.
* ``ingest_stream_<table>``: the same landing files through the streaming
  (available-now) load.
* ``ingest_archive_events``: the landing lines as zip archives, unpacked and loaded.
* ``ingest_rejected_events``: lines that cannot be loaded, counted per slot.
* ``missing_slots``: gap report of 15-minute slots of the events' DATEADDED;
  ``due_slots``: the last slots before the newest loaded one that are not loaded.
* ``run_record``: the record the runner writes.
* ``retain_since``: retention filter over event slot stamps.
* ``run_all_summary``: the runner writes all nineteen result tables; the
  summary view then counts the written tables (R2, S9, V2 end to end).

Landing and table folders go under the shared checkpoint folder.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens.plans import fixtures
from eventlens.schemas import TABLE_COLUMNS
from eventlens.session import scratch_path
from eventlens.sources.archive import unzip_lines
from eventlens.sources.delimited import parse_lines, read_lines, with_slot
from eventlens.sources.ingest import load_lines
from eventlens.sources.quarantine import read_rejected
from eventlens.sources.slots import due_before_newest, missing_slots, retain_since
from eventlens.sources.tables import load_table, write_slots
from eventlens.streaming.ingest import start_ingest

RETAIN_NOW = "2024-01-30 00:00:00"
RETAIN_HOURS = 72
DUE_SLOTS = 96


def slot_of(table: str) -> Column:
    """Slot stamp of a projected row."""
    if table == "events":
        return F.col("DATEADDED").cast("string")
    if table == "mentions":
        return F.col("MentionTimeDate").cast("string")
    return F.col("DATE")


def landing_slot(table: str) -> Column:
    """Daily landing stamp (one landing file per day keeps the round trip's
    file count small at test scale)."""
    return F.concat(F.substring(slot_of(table), 1, 8), F.lit("000000"))


def to_lines(rows: DataFrame, table: str) -> DataFrame:
    """Feed rows -> one tab-separated text line per row (absent columns empty)."""
    present = set(rows.columns)
    fields = [
        F.coalesce(F.col(name).cast("string"), F.lit("")) if name in present else F.lit("")
        for name in TABLE_COLUMNS[table]
    ]
    return rows.select(landing_slot(table).alias("slot"), F.concat_ws("\t", *fields).alias("value"))


def land_projection(spark: SparkSession, sf_dir: str, table: str, landing: str) -> None:
    lines = to_lines(fixtures.project(spark, sf_dir, table), table)
    # A few landing files per slot; a hot day is not one task's work.
    lines.write.mode("overwrite").partitionBy("slot").text(landing)


def _projected_columns(table: str) -> list[str]:
    _, items = fixtures.PROJECTIONS[table]
    return [item.rsplit(" AS ", 1)[1].strip() for item in items]


def ingest_roundtrip(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    base = scratch_path(spark, f"ingest-{table}")
    landing, tables = f"{base}/landing", f"{base}/tables"
    land_projection(spark, sf_dir, table, landing)
    rows = parse_lines(read_lines(spark, landing, glob="part-*"), table, keep=("ts", "source_file"))
    write_slots(rows, tables, table)
    return load_table(spark, tables, table).select(*_projected_columns(table), "ts")


def ingest_stream(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    base = scratch_path(spark, f"ingest-stream-{table}")
    landing, tables = f"{base}/landing", f"{base}/tables"
    land_projection(spark, sf_dir, table, landing)
    query = start_ingest(
        spark, landing, tables, table, checkpoint=f"{base}/checkpoint", glob="part-*"
    )
    query.awaitTermination()
    return load_table(spark, tables, table).select(*_projected_columns(table), "ts")


def _zip_files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Lines of a batch as one zip archive per slot, as the feed delivers them."""
    part = TaskContext.get().partitionId()
    for k, batch in enumerate(batches):
        files = []
        for slot, lines in batch.groupby("slot")["value"]:
            packed = io.BytesIO()
            with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as zf:
                zf.writestr(f"{slot}.export.CSV", "\n".join(lines) + "\n")
            files.append((f"/landing/{slot}.{part}-{k}.export.CSV.zip", packed.getvalue()))
        yield pd.DataFrame(files, columns=["path", "content"])


def ingest_archive_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = f"{scratch_path(spark, 'ingest-archive-events')}/tables"
    lines = to_lines(fixtures.project(spark, sf_dir, "events"), "events")
    archives = lines.mapInPandas(_zip_files, "path string, content binary")
    rows = parse_lines(with_slot(unzip_lines(archives)), "events", keep=("ts", "source_file"))
    write_slots(rows, tables, "events")
    return load_table(spark, tables, "events").select(*_projected_columns("events"), "ts")


def ingest_rejected_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted and rejected lines per slot, from the table and its quarantine;
    every fiftieth line lands with too many fields."""
    base = scratch_path(spark, "ingest-rejected")
    lines = to_lines(fixtures.project(spark, sf_dir, "events"), "events")
    number = F.substring_index("value", "\t", 1).cast("long")
    more = F.when(number % 50 == 0, F.concat(F.col("value"), F.lit("\tone\tmore"))).otherwise(F.col("value"))
    lines.withColumn("value", more).write.partitionBy("slot").text(f"{base}/landing")
    landed = read_lines(spark, f"{base}/landing", glob="part-*")
    files = with_slot(spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option(
        "recursiveFileLookup", "true").load(f"{base}/landing").select(F.col("path").alias("source_file")))
    load_lines(landed, files, f"{base}/tables", "events")
    accepted = load_table(spark, f"{base}/tables", "events").groupBy("ts").agg(F.count(F.lit(1)).alias("accepted"))
    rejected = read_rejected(spark, f"{base}/tables", "events").groupBy("ts").agg(F.count(F.lit(1)).alias("rejected"))
    return accepted.join(rejected, "ts", "full").na.fill(0, ["accepted", "rejected"])


def _event_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.project(spark, sf_dir, "events").select(slot_of("events").alias("ts"))


def missing_slots_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return missing_slots(_event_stamps(spark, sf_dir))


def due_slots_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return due_before_newest(_event_stamps(spark, sf_dir), DUE_SLOTS)


def retain_since_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = fixtures.project(spark, sf_dir, "events").select(
        "GLOBALEVENTID", slot_of("events").alias("ts")
    )
    return retain_since(events, RETAIN_NOW, hours=RETAIN_HOURS)


def run_all_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    from eventlens.operators import ANALYSIS_NAMES
    from eventlens.plans.oracle_sql import ANALYSIS_DATE
    from eventlens.plans.runner import run_all
    from eventlens.plans.views import result_summary
    from eventlens.sources.sinks import read_result

    out = scratch_path(spark, "run-all")
    statuses = run_all(
        spark, fixtures.inputs(spark, sf_dir), out,
        params={"tone_sources_correlation": {"as_of": ANALYSIS_DATE}},
    )
    failed = [s for s in statuses if s["status"] == "failed"]
    if failed:
        raise RuntimeError(f"analyses failed: {failed}")
    return result_summary({name: read_result(spark, out, name) for name in ANALYSIS_NAMES})


def run_record_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The record of a run: analysis, status and rows as written."""
    from eventlens.plans.oracle_sql import ANALYSIS_DATE
    from eventlens.plans.runner import run_all
    from eventlens.sources.sinks import RUN_RECORD, read_result

    out = scratch_path(spark, "run-record")
    run_all(
        spark, fixtures.inputs(spark, sf_dir), out,
        params={"tone_sources_correlation": {"as_of": ANALYSIS_DATE}},
    )
    return read_result(spark, out, RUN_RECORD).selectExpr("analysis", "status", "cast(rows as bigint) AS row_count")


def all_queries() -> dict:
    out = {f"ingest_{t}": (lambda t: lambda spark, sf: ingest_roundtrip(spark, sf, t))(t)
           for t in ("events", "mentions", "gkg")}
    for t in ("events", "mentions", "gkg"):
        out[f"ingest_stream_{t}"] = (lambda t: lambda spark, sf: ingest_stream(spark, sf, t))(t)
    out["ingest_archive_events"] = ingest_archive_events
    out["ingest_rejected_events"] = ingest_rejected_events
    out["missing_slots"] = missing_slots_query
    out["due_slots"] = due_slots_query
    out["run_record"] = run_record_query
    out["retain_since"] = retain_since_query
    out["run_all_summary"] = run_all_summary
    return out

"""Incremental ingest with Structured Streaming.

One file-source stream per feed table watches the landing folder; the
stream's checkpoint (in the shared checkpoint folder) replaces a list of
loaded files, so a re-run adds nothing and a newly landed file is picked up.
Tables are independent: a table that lands late for a slot is still loaded.

Each micro-batch is written with dynamic partition overwrite (``foreachBatch``)
per slot and landed file, so a replayed batch is idempotent after a failure and
a later file of a slot adds to it.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventlens.session import stream_checkpoint_root
from eventlens.sources.archive import unzip_lines
from eventlens.sources.delimited import listed_files, parse_lines, with_slot
from eventlens.sources.ingest import FEED_SUFFIXES, TEXT_EXTENSIONS, load_lines


# Files older than this against the newest one seen are ignored by the file
# source, whose own default (7 days) would lose a backfill that keeps file times.
MAX_FILE_AGE = "36500d"

# The fixed schema of the binaryFile source (a stream must be given one).
BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def stream_lines(
    spark: SparkSession,
    landing: str,
    table: str,
    max_files: int | None = None,
    glob: str | None = None,
    archives: bool = False,
    max_file_age: str = MAX_FILE_AGE,
) -> DataFrame:
    """Streaming DataFrame of raw lines of one feed, with ``ts`` and ``source_file``.

    With ``archives`` the landed files are zip archives (``*<suffix>.zip``):
    each new archive is unpacked inside its task, as in the batch path.
    """
    return with_slot(_unstamped_lines(spark, landing, table, max_files, glob, archives, max_file_age))


def _landed_names(table: str, glob: str | None, archives: bool) -> str:
    return glob or f"*{FEED_SUFFIXES[table]}{'.zip' if archives else TEXT_EXTENSIONS}"


def _unstamped_lines(
    spark: SparkSession, landing: str, table: str, max_files: int | None, glob: str | None, archives: bool,
    max_file_age: str,
) -> DataFrame:
    """``stream_lines`` without ``ts``."""
    reader = spark.readStream.format("binaryFile" if archives else "text").option(
        "pathGlobFilter", _landed_names(table, glob, archives)
    ).option("maxFileAge", max_file_age)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    if archives:
        return unzip_lines(reader.schema(BINARY_FILE_SCHEMA).load(landing))
    return reader.load(landing).select("value", F.col("_metadata.file_path").alias("source_file"))


def stream_rows(spark: SparkSession, landing: str, table: str, **options) -> DataFrame:
    """Streaming DataFrame of typed rows of one feed, with ``ts``."""
    lines = stream_lines(spark, landing, table, **options)
    return parse_lines(lines, table, keep=("ts", "source_file")).filter("ts IS NOT NULL")


def start_ingest(
    spark: SparkSession,
    landing: str,
    table_root: str,
    table: str,
    checkpoint: str | None = None,
    available_now: bool = True,
    max_files: int | None = None,
    glob: str | None = None,
    archives: bool = False,
    max_file_age: str = MAX_FILE_AGE,
    counts: list[dict] | None = None,
) -> StreamingQuery:
    """Start the incremental load of one table.  With ``available_now`` the
    query processes what has landed and stops (batch-like scheduling).  Each
    micro-batch adds its number and its accepted and rejected lines, counted while
    loading, to ``counts``; rejected lines are kept by ``quarantine``."""
    if checkpoint is None:
        # One checkpoint per (landing, target, table): a stream's record of seen
        # files must never be shared with another source folder.
        tag = hashlib.sha1(f"{landing}|{table_root}|{archives}".encode()).hexdigest()[:12]
        checkpoint = f"{stream_checkpoint_root(spark)}/eventlens/ingest/{table}-{tag}"
    location = checkpoint

    def write(batch: DataFrame, epoch: int) -> None:
        listed = listed_files(batch.sparkSession, landing, _landed_names(table, glob, archives), archives)
        lines = with_slot(batch, files=listed)
        found = load_lines(lines, lines.select("source_file", "ts").distinct(), table_root, table)
        if counts is not None:
            counts.append({"batch": epoch, **found})

    writer = (
        _unstamped_lines(spark, landing, table, max_files, glob, archives, max_file_age)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", location)
        .queryName(f"ingest_{table}")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def ingest_available(
    spark: SparkSession, landing: str, table_root: str, tables=("events", "mentions", "gkg"),
    checkpoint_root: str | None = None, archives: bool = False,
) -> dict[str, dict[str, int]]:
    """Run the available-now load of each table to completion; accepted and
    rejected lines per table."""
    totals = {}
    for table in tables:
        ckpt = f"{checkpoint_root.rstrip('/')}/{table}" if checkpoint_root else None
        counts: list[dict] = []
        start_ingest(
            spark, landing, table_root, table, checkpoint=ckpt, archives=archives, counts=counts
        ).awaitTermination()
        totals[table] = {k: sum(c[k] for c in counts) for k in ("accepted", "rejected")}
    return totals

"""Batch ingest: landed feed files -> slot-partitioned Parquet tables.

File names carry the slot stamp (``<yyyyMMddHHmmss>.export.CSV[.zip]`` etc.).
Text files are read by Spark directly; zip archives go through ``archive``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from eventlens.sources.archive import read_zip_lines, unreadable_archives
from eventlens.sources.delimited import parse_lines, read_lines, with_slot
from eventlens.sources.quarantine import quarantine
from eventlens.sources.tables import write_slots

# --- fixed values: file name suffixes of the three feeds ---
FEED_SUFFIXES = {
    "events": ".export.CSV",
    "mentions": ".mentions.CSV",
    "gkg": ".gkg.csv",
}
# --- end of fixed values ---

# Hadoop glob alternation: the bare name or a compressed one.
TEXT_EXTENSIONS = "{,.gz,.bz2}"


def landed_lines(spark: SparkSession, landing: str, table: str, archives: bool = False) -> DataFrame:
    """Raw lines of all landed files of one feed, with ``ts`` from the file name."""
    suffix = FEED_SUFFIXES[table]
    if archives:
        return read_zip_lines(spark, landing, glob=f"*{suffix}.zip")
    # Plain or compressed text: Spark decompresses .gz / .bz2 by extension.
    return read_lines(spark, landing, glob=f"*{suffix}{TEXT_EXTENSIONS}")


def landed_rows(spark: SparkSession, landing: str, table: str, archives: bool = False) -> DataFrame:
    """Typed rows of all landed files of one feed, with ``ts`` from the file name
    and ``source_file``."""
    return parse_lines(landed_lines(spark, landing, table, archives), table, keep=("ts", "source_file"))


def landed_files(spark: SparkSession, landing: str, table: str, archives: bool = False) -> DataFrame:
    """``source_file, ts`` of the landed files of one feed, from a listing."""
    suffix = FEED_SUFFIXES[table]
    glob = f"*{suffix}.zip" if archives else f"*{suffix}{TEXT_EXTENSIONS}"
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(landing)
    return with_slot(files.select(F.col("path").alias("source_file")))


def landing_problems(spark: SparkSession, landing: str, table: str, archives: bool = False) -> DataFrame:
    """``source_file, problem``: landed files that cannot be loaded because
    their name has no slot stamp or their archive is unreadable."""
    suffix = FEED_SUFFIXES[table]
    glob = f"*{suffix}.zip" if archives else f"*{suffix}{TEXT_EXTENSIONS}"
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(landing)
    unstamped = (
        with_slot(files.select(F.col("path").alias("source_file"))).where("ts IS NULL")
        .select("source_file", F.lit("no slot stamp").alias("problem"))
    )
    return unstamped.unionByName(unreadable_archives(files)) if archives else unstamped


def ingest_batch(
    spark: SparkSession, landing: str, table_root: str, table: str, archives: bool = False,
    strict: bool = False, slots: DataFrame | None = None,
) -> dict[str, int]:
    """Load every landed file of ``table``; each file replaces its own part of
    its slot.  Files that cannot be loaded are listed by ``landing_problems``;
    with ``strict`` any such file fails the load before anything is written.
    ``slots`` (column ``ts``) limits the load to those slots.

    Returns the numbers of accepted and rejected lines, counted while loading;
    the rejected lines are kept by ``quarantine``."""
    if strict:
        found = landing_problems(spark, landing, table, archives).limit(20).collect()
        if found:
            raise ValueError("files that cannot be loaded: " + "; ".join(f"{r[0]}: {r[1]}" for r in found))
    lines = landed_lines(spark, landing, table, archives)
    files = landed_files(spark, landing, table, archives)
    if slots is not None:
        due = slots.select("ts").distinct()
        lines, files = (df.join(due, "ts", "left_semi") for df in (lines, files))
    return load_lines(lines, files, table_root, table)


def load_lines(lines: DataFrame, files: DataFrame, table_root: str, table: str) -> dict[str, int]:
    """Write lines (``value, ts, source_file``) of ``files`` as parts of a feed
    table, and their rejected ones to its quarantine; both numbers."""
    observation = Observation()
    rows = parse_lines(lines, table, keep=("ts", "source_file"), observation=observation)
    write_slots(rows.filter("ts IS NOT NULL"), table_root, table)
    found = observation.get
    quarantine(lines, table_root, table, files, found)
    return {k: found[k] for k in ("accepted", "rejected")}

"""Lines that cannot be loaded, kept beside their feed table.

``<table>.rejected`` holds the rejected lines (too many fields, or a file without
a slot stamp) of each landed file, as the file was last loaded: a file delivered
again without bad lines leaves none.  The load itself counts them (see
``parse_lines``) and names their files, so only files that have some are read a
second time, and nothing is when there are none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens.schemas import TABLE_COLUMNS
from eventlens.sources.delimited import fits_table, split_fields
from eventlens.sources.parts import PART, part_files, staged_parts
from eventlens.sources.tables import file_name, path_exists, remove_parts

REJECTED_SCHEMA = "value string, n_fields int, ts string, load_file string"
#: ``ts`` of lines whose file has no slot stamp.
NO_SLOT = "none"


def rejected_path(table_root: str, table: str) -> str:
    return f"{table_root.rstrip('/')}/{table}.rejected"


def quarantine(lines: DataFrame, table_root: str, table: str, loaded: DataFrame, found: dict) -> None:
    """Bring the rejected lines up to a load that has just been written.

    ``lines``: what was loaded (``value, ts, source_file``).  ``loaded``: its
    files (``source_file, ts``).  ``found``: what the load observed."""
    spark, path = lines.sparkSession, rejected_path(table_root, table)
    slot = F.coalesce("ts", F.lit(NO_SLOT)).alias("ts")
    if path_exists(spark, path):
        kept = part_files(spark, path).select(*PART).distinct()
        again = loaded.select(slot, file_name("source_file").alias("load_file")).distinct()
        remove_parts(spark, path, staged_parts(kept.join(again, PART, "left_semi")))
    if not found["rejected"]:
        return
    bad = split_fields(lines.where(F.col("source_file").isin(found["rejected_files"]))).where(~fits_table(table))
    rows = bad.select("value", F.size("_fields").alias("n_fields"), slot, file_name("source_file").alias("load_file"))
    rows.write.mode("append").partitionBy(*PART).parquet(path)


def read_rejected(spark: SparkSession, table_root: str, table: str) -> DataFrame:
    """``value, n_fields, ts, load_file`` of the lines that could not be loaded."""
    assert table in TABLE_COLUMNS, table
    path = rejected_path(table_root, table)
    if not path_exists(spark, path):
        return spark.createDataFrame([], REJECTED_SCHEMA)
    return spark.read.schema(REJECTED_SCHEMA).parquet(path)

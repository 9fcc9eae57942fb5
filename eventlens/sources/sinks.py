"""S9 + S10: result tables and the run record.

A result in a file format is replaced atomically (``versions``): readers see the
old result until the new one is complete, and keep it if the write fails.  Other
formats (table formats, document-store connectors) replace by their own rules.
"""

from __future__ import annotations

import datetime as dt

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from eventlens.sources.versions import commit, current_path, write_version

FILE_FORMATS = {"parquet", "orc", "json", "csv", "text", "avro"}

# --- fixed values: name of the run-record table, as the reference names it ---
RUN_RECORD = "pipeline_metadata"
# --- end of fixed values ---

RUN_RECORD_SCHEMA = T.StructType([
    T.StructField("last_run", T.StringType()),
    T.StructField("analysis", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("seconds", T.DoubleType()),
    T.StructField("message", T.StringType()),
])


def result_path(out_root: str, name: str) -> str:
    return f"{out_root.rstrip('/')}/{name}"


def write_result(
    df: DataFrame, out_root: str, name: str, fmt: str = "parquet", proceed: Callable[[], bool] = lambda: True,
) -> str:
    """Replace the named result table; returns its location.

    The format is a parameter: any installed data source works (parquet,
    orc, json, a table format, or a document-store connector if present).
    ``proceed`` is asked once the new result is written; if it says no, the
    old result stays.
    """
    root = result_path(out_root, name)
    if fmt.lower() not in FILE_FORMATS:
        df.write.mode("overwrite").format(fmt).save(root)
        return root
    version = write_version(df, root, fmt)
    if not proceed():
        raise RuntimeError(f"result {name} given up before it was committed")
    commit(df.sparkSession, root, version)
    return f"{root}/{version}"


def result_location(spark: SparkSession, out_root: str, name: str) -> str:
    """The folder that holds the named result: the committed version, or the
    root itself for a result written without versions."""
    root = result_path(out_root, name)
    return current_path(spark, root) or root


def read_result(spark: SparkSession, out_root: str, name: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(result_location(spark, out_root, name))


def run_record(spark: SparkSession, statuses: list[dict], when: dt.datetime | None = None) -> DataFrame:
    """One row per analysis of a run (time, name, status, rows, seconds, message).

    The list holds one small dict per registered analysis (a fixed, tiny
    number), so building it on the driver is fine.
    """
    stamp = (when or dt.datetime.now(dt.timezone.utc)).isoformat()
    rows = [
        (stamp, s["analysis"], s["status"], s.get("rows"), s.get("seconds"), s.get("message"))
        for s in statuses
    ]
    return spark.createDataFrame(rows, RUN_RECORD_SCHEMA)

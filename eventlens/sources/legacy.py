"""Read slot folders written with per-file inferred types (``<table>/ts=<stamp>/``).

Such slots disagree on types (a numeric column is integer in one slot and
floating in the next; an all-missing text column may be stored as a number),
so one Parquet scan over all of them fails.  A Spark job reads the schema of
every file (each file is one drop of a quarter of an hour, a few MB, and is one
record of that job); the files of one schema are one scan, cast to the fixed
types of ``schemas``, and the scans are unioned.  The driver holds file names
and one schema per group, bounded by the number of slots, not by the data.  A
file that is no readable Parquet raises an error.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlens.schemas import TABLE_COLUMNS, column_type, table_schema
from eventlens.sources.delimited import coerce
from eventlens.sources.tables import path_exists


def slot_files(spark: SparkSession, table_root: str) -> DataFrame:
    """``path, layout``: every file under the slot folders and a digest of its
    physical column names and types."""

    def layouts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for content in batch.column(1):
                fields = pq.read_schema(pa.BufferReader(content.as_buffer()))
                found.append("\n".join(f"{f.name}\t{f.type}" for f in fields))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.string())], names=["path", "layout"])

    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        .load(table_root).where(F.col("path").rlike("/ts=[^/]*/"))
    )
    found = files.select("path", "content").mapInArrow(layouts, "path string, layout string")
    return found.select("path", F.md5("layout").alias("layout"))


def _typed(c: Column, found: T.DataType, wanted: T.DataType) -> Column:
    if isinstance(found, T.NullType):
        return F.lit(None).cast(wanted)
    if isinstance(wanted, T.StringType):
        return c.cast("string")
    # numbers of any stored width (or text) -> the fixed numeric type
    return coerce(c.cast("string"), wanted)


def read_legacy_table(spark: SparkSession, table_root: str, table: str) -> DataFrame:
    """All slots of one table, typed like an ingested table (``ts`` a string)."""
    target = table_schema(table)
    if not path_exists(spark, table_root):
        return spark.createDataFrame([], target)
    groups: dict[str, list[str]] = defaultdict(list)
    for row in slot_files(spark, table_root).orderBy("path").collect():  # one short row per file
        groups[row["layout"]].append(row["path"])
    if not groups:
        return spark.createDataFrame([], target)
    parts = []
    for files in groups.values():
        schema = spark.read.parquet(files[0]).schema
        found = {f.name: f.dataType for f in schema.fields}
        scan = spark.read.schema(schema).parquet(*files)
        cols = []
        for name in TABLE_COLUMNS[table] + ["load_timestamp"]:
            wanted = column_type(table, name) if name != "load_timestamp" else T.StringType()
            if name in found:
                cols.append(_typed(F.col(name), found[name], wanted).alias(name))
            else:
                cols.append(F.lit(None).cast(wanted).alias(name))
        slot = F.regexp_extract(F.col("_metadata.file_path"), r"ts=(\d{14})", 1)
        cols.append(F.when(slot != "", slot).alias("ts"))
        parts.append(scan.select(*cols))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out

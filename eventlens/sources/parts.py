"""Parts of a feed table, and stores that keep the rows of many parts together.

A part is what one landed file of a slot has become: ``(ts, load_file)``.  As
landed it is one directory, ``ts=.../load_file=...``, replaced as a whole when
the file is delivered again.  Its ``signature`` (over the names, sizes and times
of its data files) tells a replaced part from the one before.

A ``PartStore`` keeps rows of many parts in a few large batches: immutable
folders whose rows carry ``ts`` and ``load_file``, and an index of the live
parts (``ts, load_file, signature, batch``), replaced atomically.  Rows count
only while the index names their batch for their part, so a part is replaced by
writing its new rows into a new batch and committing an index.  A store may hold
several data sets over the same parts (the partials of one feed).

One writer per table at a time is assumed, as for the feed tables themselves.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens.session import remove_path, scratch_path, write_and_read
from eventlens.sources.versions import children, current_path, publish

PART = ["ts", "load_file"]
INDEX_SCHEMA = "ts string, load_file string, signature bigint, batch string"
#: The slots of up to so many parts become an IN list that prunes directories.
LISTED_SLOTS = 1000


def part_files(spark: SparkSession, path: str) -> DataFrame:
    """``path, modificationTime, length`` and part of the data files under
    ``path``, from a listing: no file is opened."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet").load(path)
    )

    def value(key: str) -> Column:
        # partition values are percent-escaped in paths; a plus sign is itself
        raw = F.regexp_extract("path", f"/{key}=([^/]+)/", 1)
        return F.url_decode(F.regexp_replace(raw, r"\+", "%2B")).alias(key)

    return files.select("path", "modificationTime", "length", *map(value, PART))


def landed_parts(spark: SparkSession, path: str) -> DataFrame:
    """``ts, load_file, signature`` of the part directories under ``path``."""
    files = part_files(spark, path)
    name = F.regexp_extract("path", "([^/]+)$", 1)
    of_file = F.xxhash64(name, "length", F.unix_micros("modificationTime"))
    return files.select(*PART, of_file.alias("h")).groupBy(*PART).agg(F.bit_xor("h").alias("signature"))


def only_parts(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """The rows of ``parts`` (a written, small table); the slots also as a
    literal condition, which prunes directories and row groups."""
    slots = [r["ts"] for r in parts.select("ts").distinct().limit(LISTED_SLOTS + 1).collect()]
    if not slots:
        return rows.limit(0)
    if len(slots) <= LISTED_SLOTS:
        rows = rows.where(F.col("ts").isin(slots))
    else:
        ends = parts.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).first()
        rows = rows.where(F.col("ts").between(ends["lo"], ends["hi"]))
    return rows.join(parts.select(*PART), PART, "left_semi")


class PartStore:
    """Batches of rows of many parts under ``root``, and the index of live ones."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def index(self) -> DataFrame | None:
        path = current_path(self.spark, f"{self.root}/index")
        return self.spark.read.schema(INDEX_SCHEMA).parquet(path) if path else None

    def write_batch(self, rows: DataFrame, batch: str, data_set: str = "rows", partition_by: tuple[str, ...] = ()) -> None:
        """Write rows (with ``ts`` and ``load_file``) that no index names yet."""
        path = f"{self.root}/data/{data_set}/batch={batch}"
        rows.write.mode("overwrite").partitionBy(*partition_by).parquet(path)

    def live(self, schema, data_set: str = "rows", index: DataFrame | None = None,
             partition_by: tuple[str, ...] = (), where: Column | None = None) -> DataFrame:
        """The rows of the parts named by ``index`` (default: the committed one).
        ``partition_by`` are the columns the batches were partitioned by, which a
        condition ``where`` may use to prune."""
        index = self.index() if index is None else index
        batches = [b for b in children(self.spark, f"{self.root}/data/{data_set}") if b.startswith("batch=")]
        if index is None or not batches:
            return self.spark.createDataFrame([], schema)
        fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema if f.name != "batch"]
        fields += [f"`{name}` string" for name in ("batch", *partition_by)]
        data = self.spark.read.schema(", ".join(fields)).parquet(f"{self.root}/data/{data_set}")
        if where is not None:
            data = data.where(where)
        live = data.join(index.select("batch", *PART), ["batch", *PART], "left_semi")
        return live.select(*(f.name for f in schema))

    def commit(self, index: DataFrame) -> None:
        """Make ``index`` the live one; batches that neither it nor the index
        before it names are deleted."""
        before = self.index()
        publish(index.select("ts", "load_file", "signature", "batch").coalesce(1), f"{self.root}/index")
        named = self.index().select("batch")
        if before is not None:
            named = named.union(before.select("batch"))
        live = {f"batch={r['batch']}" for r in named.distinct().collect()}  # one row per batch
        for data_set in children(self.spark, f"{self.root}/data"):
            for batch in children(self.spark, f"{self.root}/data/{data_set}"):
                if batch.startswith("batch=") and batch not in live:
                    remove_path(self.spark, f"{self.root}/data/{data_set}/{batch}")


def new_batch() -> str:
    return uuid.uuid4().hex[:16]


def staged_parts(parts: DataFrame) -> DataFrame:
    """A list of parts as a written table: small, and the planner knows it."""
    return write_and_read(parts, scratch_path(parts.sparkSession, "parts"))

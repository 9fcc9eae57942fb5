"""S1 + S3: header-less tab-separated lines -> typed feed table.

The CSV reader is not used: it truncates over-long rows and marks short and
long rows alike as corrupt.  Instead each line is split on tabs (keeping empty
trailing fields), rows with more fields than the schema are rejected, short
rows are padded with NULL (``get`` past the end is NULL), missing-value tokens
become NULL and numeric columns are coerced with ``try_cast`` (unparsable ->
NULL).  Quotes carry no meaning: a field is taken literally.

Everything is a built-in expression; the scan itself is ``spark.read.text``
(splittable, so one large file spreads over many tasks).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlens.functions.maps import NA_TOKENS
from eventlens.schemas import TABLE_COLUMNS, column_type

# What counts as a number; Spark's own cast also takes Java forms such as 12d.
NUMBER_PATTERN = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))\s*$"


def _valid_text(c: Column) -> Column:
    # Invalid UTF-8 bytes become U+FFFD (row kept), like a lenient decode.
    return F.make_valid_utf8(c) if hasattr(F, "make_valid_utf8") else c


def _texts(fields: str, table: str) -> Column:
    """Raw fields of the text columns, in their order, with missing-value tokens as NULL.

    Only these are compared with the tokens: none of the tokens is a number, so
    ``coerce`` makes them NULL by itself.  As a function over an array it also keeps
    the projection of the typed columns out of whole-stage code: one method for 16 to
    61 columns exceeds the 8000 bytes of bytecode above which the JVM interprets it
    for every row.  Outside of it Spark splits the projection into small methods and
    evaluates the array once."""
    texts = F.array(*(F.get(F.col(fields), i) for i in _text_places(table)))
    none = F.lit(None).cast("string")
    # most fields are empty, which is one of the tokens: those are not looked up in the set
    return F.transform(texts, lambda c: F.when(c == "", none).when(c.isin(*NA_TOKENS), none).otherwise(c))


def _text_places(table: str) -> list[int]:
    return [i for i, name in enumerate(TABLE_COLUMNS[table]) if isinstance(column_type(table, name), T.StringType)]


def _typed(fields: str, table: str) -> list[Column]:
    """The columns of ``table`` from its raw fields."""
    texts, places = _texts(fields, table), _text_places(table)

    def column(i: int, name: str) -> Column:
        if i in places:
            return F.get(texts, places.index(i))
        return coerce(F.get(F.col(fields), i), column_type(table, name))

    return [column(i, name).alias(name) for i, name in enumerate(TABLE_COLUMNS[table])]


def coerce(c: Column, data_type: T.DataType) -> Column:
    """S3: text -> numeric, NULL when unparsable.

    An integer column also accepts a whole number written with a point
    ("12.0"); a fractional value there is NULL rather than silently cut.
    """
    # most fields are empty: no search in them, and no cast that fails, which costs an exception each
    number = (c != "") & c.rlike(NUMBER_PATTERN)
    if isinstance(data_type, T.LongType):
        as_double = F.when(number, c.try_cast("double"))
        whole = F.when(as_double == F.round(as_double, 0), as_double.try_cast("bigint"))
        return F.coalesce(F.when((c != "") & ~c.contains("."), c.try_cast("bigint")), whole)
    if isinstance(data_type, T.DoubleType):
        return F.when(number, c.try_cast("double"))
    return c


def split_fields(lines: DataFrame, value: str = "value") -> DataFrame:
    """Add ``_fields`` (array of raw fields) to non-empty lines."""
    text = _valid_text(F.col(value))
    return lines.filter(F.col(value) != "").withColumn("_fields", F.split(text, "\t", -1))


def parse_lines(
    lines: DataFrame, table: str, value: str = "value", keep: tuple[str, ...] = (),
    observation: Observation | None = None,
) -> DataFrame:
    """Typed ``table`` rows from a DataFrame of raw lines.

    ``keep`` names extra columns of ``lines`` to carry through (e.g. the
    source file path).  Rows with too many fields are dropped; see
    ``rejected_lines``.  ``observation`` counts them in the same pass: once the
    rows have been written it holds ``accepted`` and ``rejected`` lines (those of
    files without a slot stamp included) and ``rejected_files``, the files that
    have rejected lines.
    """
    names = TABLE_COLUMNS[table]
    split = split_fields(lines, value)
    if observation is not None:
        fits = fits_table(table)
        split = split.observe(
            observation, F.count_if(fits).alias("accepted"), F.count_if(~fits).alias("rejected"),
            F.collect_set(F.when(~fits, F.col("source_file"))).alias("rejected_files"))
    # at most len(names) fields, told from the line: a filter on the fields would split each line once more
    split = split.filter(F.substring_index(value, "\t", len(names)) == F.col(value))
    return split.select(*_typed("_fields", table), *keep)


def fits_table(table: str) -> Column:
    """Whether a split line (with ``ts``) can be loaded."""
    return (F.size("_fields") <= len(TABLE_COLUMNS[table])) & F.col("ts").isNotNull()


def rejected_lines(lines: DataFrame, table: str, value: str = "value") -> DataFrame:
    """Lines dropped by ``parse_lines`` for having more fields than the schema."""
    return split_fields(lines, value).filter(F.size("_fields") > len(TABLE_COLUMNS[table])).drop(
        "_fields"
    )


def read_lines(spark: SparkSession, paths: str | list[str], glob: str | None = None) -> DataFrame:
    """Raw lines plus the file each came from (``source_file``) and the
    14-digit slot stamp found in that file's path (``ts``)."""
    reader = spark.read.format("text")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    lines = reader.load(paths)
    return with_slot(
        lines.select("value", F.col("_metadata.file_path").alias("source_file")), files=listed_files(spark, paths, glob))


def listed_files(spark: SparkSession, paths: str | list[str], glob: str | None = None, archives: bool = False) -> DataFrame:
    """``source_file`` of the files that now lie under ``paths``, named as their lines
    name them; from a listing, no file is opened."""
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(paths).select(F.col("path" if archives else "_metadata.file_path").alias("source_file"))


def with_slot(lines: DataFrame, path_col: str = "source_file", files: DataFrame | None = None) -> DataFrame:
    """``ts`` = the last 14-digit run in the file path (file name or folder), NULL if none.

    ``files`` (column ``source_file``) are files most lines come from: their paths are
    searched once a file, not once a line, which costs more than splitting the line.
    Lines of other files are searched one by one."""
    # the run that none follows, in one search forward: reversing each row's path costs as much as the search
    slot = F.regexp_substr(path_col, F.lit(r"(?s)\d{14}(?!\d)(?!.*\d{14})"))
    if files is None:
        return lines.withColumn("ts", slot)
    known = files.select(F.col("source_file").alias(path_col)).distinct().withColumn("ts", slot)
    # one short row per file, as the driver's own listing holds them
    found = lines.join(F.broadcast(known), path_col, "left").withColumn("ts", F.coalesce("ts", slot))
    return found.select(*lines.columns, "ts")


def read_delimited(spark: SparkSession, paths: str | list[str], table: str, glob: str | None = None) -> DataFrame:
    """Typed rows of ``table`` from text files, with ``ts`` from the file name."""
    return parse_lines(read_lines(spark, paths, glob), table, keep=("ts",))


def slot_report(lines: DataFrame, table: str, value: str = "value") -> DataFrame:
    """Per slot: lines accepted and lines rejected for having too many fields
    (the ingest metric), in one aggregation over the landed lines.  Lines of
    files without a slot stamp (``ts`` NULL) are all rejected: they cannot be
    loaded."""
    fits = fits_table(table)
    return split_fields(lines, value).groupBy("ts").agg(
        F.count_if(fits).alias("accepted"),
        F.count_if(~fits).alias("rejected"),
    )

"""Lines of the first member of zip archives.

Spark has no zip codec, so this is the one place with Python per record: a
``mapInPandas`` over ``binaryFile`` rows unpacks each archive inside its task
(one archive per row, so archives spread over tasks) and streams its lines
through an incremental decoder in bounded batches; a task holds the compressed
archives of one Arrow batch and one batch of lines, never the whole decoded text.
The member is read to its end once before the first line is passed on, so its
checksum is known: a damaged archive gives no rows and is listed by
``unreadable_archives``.
Plain or gzip text needs none of this: ``read_lines`` reads it directly.
"""

from __future__ import annotations

import io
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from eventlens.sources.delimited import with_slot

_BATCH = 50_000


def _member_lines(content: bytes) -> Iterator[str]:
    """Lines of the first member, decoded incrementally (invalid UTF-8 ->
    U+FFFD; \\n, \\r\\n and \\r all end a line)."""
    with zipfile.ZipFile(io.BytesIO(content)) as zf:
        members = zf.namelist()
        if not members:
            return
        with zf.open(members[0]) as raw:
            text = io.TextIOWrapper(raw, encoding="utf-8", errors="replace", newline=None)
            for line in text:
                yield line[:-1] if line.endswith("\n") else line


def _damage(content: bytes) -> str | None:
    """Why the first member cannot be read whole, or None."""
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as zf:
            members = zf.namelist()
            if not members:
                return "archive without members"
            with zf.open(members[0]) as raw:
                while raw.read(1 << 20):
                    pass
    except (zipfile.BadZipFile, zlib.error, EOFError, OSError, NotImplementedError, RuntimeError) as exc:
        return f"unreadable archive: {exc}"[:200]
    return None


def _unzip(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for path, content in zip(pdf["path"], pdf["content"]):
            if _damage(content) is not None:
                continue
            chunk: list[str] = []
            for line in _member_lines(content):
                chunk.append(line)
                if len(chunk) >= _BATCH:
                    yield pd.DataFrame({"value": chunk, "source_file": path})
                    chunk = []
            if chunk:
                yield pd.DataFrame({"value": chunk, "source_file": path})


def _damaged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        reasons = [_damage(content) for content in pdf["content"]]
        found = pd.DataFrame({"source_file": pdf["path"], "problem": reasons})
        yield found[found["problem"].notna()]


def unreadable_archives(archives: DataFrame) -> DataFrame:
    """``source_file, problem`` of ``binaryFile`` rows that give no lines."""
    return archives.select("path", "content").mapInPandas(
        _damaged, schema="source_file string, problem string"
    )


def unzip_lines(archives: DataFrame) -> DataFrame:
    """``binaryFile`` rows (batch or stream) -> ``value``, ``source_file`` lines."""
    return archives.select("path", "content").mapInPandas(
        _unzip, schema="value string, source_file string"
    )


def read_zip_lines(spark: SparkSession, paths: str | list[str], glob: str = "*.zip") -> DataFrame:
    """Lines of the first member of each archive, with ``source_file`` and ``ts``."""
    archives = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(paths)
    return with_slot(unzip_lines(archives))

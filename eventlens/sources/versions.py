"""Tables replaced as a whole: versioned folders and a committed pointer.

A new version is written beside the old one and then committed by creating one
small file, ``_commits/<number>.<version>``; a reader takes the highest number.
Until that file exists readers see the old version, from then on the new one:
there is no moment without a complete table, and a write that fails leaves the
old one in place.  Creating a file is atomic on every Hadoop file system, object
stores included, so no rename is needed.  The version before the current one is
kept for readers that resolved it earlier; older ones are deleted.

One writer per table at a time is assumed; of two, the later commit wins.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

COMMITS = "_commits"
KEPT = 2


def _file_system(spark: SparkSession, path: str):
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark._jsc.hadoopConfiguration()), hpath


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder; none where it does not exist."""
    fs, hpath = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(hpath)) if fs.exists(hpath) else []


def _commits(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    named = (name.split(".", 1) for name in children(spark, f"{root}/{COMMITS}") if not name.startswith((".", "_")))
    return sorted((int(number), version) for number, version in named)


def current_path(spark: SparkSession, root: str) -> str | None:
    """The folder of the committed version, or None."""
    found = _commits(spark, root.rstrip("/"))
    return f"{root.rstrip('/')}/{found[-1][1]}" if found else None


def write_version(df: DataFrame, root: str, fmt: str = "parquet") -> str:
    """Write ``df`` as a version nobody reads yet; returns its folder's name."""
    version = f"version={uuid.uuid4().hex[:16]}"
    df.write.format(fmt).save(f"{root.rstrip('/')}/{version}")
    return version


def commit(spark: SparkSession, root: str, version: str, kept: int = KEPT) -> None:
    """Make ``version`` the current one; delete versions before the last
    ``kept``, what failed writes left, and files of a table without versions."""
    root = root.rstrip("/")
    found = _commits(spark, root)
    number = found[-1][0] + 1 if found else 1
    fs, pointer = _file_system(spark, f"{root}/{COMMITS}/{number:012d}.{version}")
    fs.create(pointer, False).close()
    past = max(0, len(found) + 1 - kept)
    live = {version, *(name for _, name in found[past:])}
    dead = [f"{COMMITS}/{old:012d}.{name}" for old, name in found[:past]]  # pointers first
    dead += [n for n in children(spark, root) if n.startswith(("version=", "part-")) and n not in live]
    for name in dead:
        fs, hpath = _file_system(spark, f"{root}/{name}")
        fs.delete(hpath, True)


def publish(df: DataFrame, root: str, fmt: str = "parquet", kept: int = KEPT) -> None:
    commit(df.sparkSession, root, write_version(df, root, fmt), kept)

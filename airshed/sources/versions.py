"""Commits by marker files, and tables replaced as a whole by versions.

A marker is a small file created under ``_commits`` after all that it
stands for is written. Creating a file that must not exist yet is atomic on
every file system Hadoop knows, so a reader sees a commit or does not, and of
two writers of one number only one succeeds. Folders that begin with ``_``
are skipped by Spark's readers.

A versioned table keeps each full refresh in a folder of its own; the last
marker names the folder that counts. A write that fails at any point leaves
no marker: readers go on with the version before, without a gap, also those
that began before the change (old versions stay until ``remove_old``).
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

MARKERS = "_commits"


def file_system(spark: SparkSession, path: str):
    """(file system, path) of the JVM for a path."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def put(spark: SparkSession, path: str, text: str, replace: bool = False) -> bool:
    """Create a small file; False if it exists already."""
    fs, where = file_system(spark, path)
    if not replace and fs.exists(where):
        return False
    try:
        out = fs.create(where, replace)
    except Py4JJavaError as error:
        if not replace and fs.exists(where):     # another writer was first
            return False
        raise error
    try:
        out.write(bytearray((text + "\n").encode()))
    finally:
        out.close()
    return True


def commit(spark: SparkSession, folder: str, name: str, facts: dict, replace: bool = False) -> bool:
    """Write the marker ``name`` of ``folder``; False if it exists already."""
    return put(spark, f"{folder.rstrip('/')}/{MARKERS}/{name}", json.dumps(facts), replace)


def commits(spark: SparkSession, folder: str) -> list[str]:
    """Names of the markers of ``folder``, in order (a listing, no file is read)."""
    fs, where = file_system(spark, f"{folder.rstrip('/')}/{MARKERS}")
    if not fs.exists(where):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(where) if s.isFile() and s.getLen() > 0
                  and not s.getPath().getName().startswith("."))


def facts_of(spark: SparkSession, folder: str, name: str) -> dict:
    """What a marker says."""
    fs, where = file_system(spark, f"{folder.rstrip('/')}/{MARKERS}/{name}")
    stream = fs.open(where)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def publish_version(df: DataFrame, target: str, partition_cols: list[str] | tuple[str, ...] = (),
                    fmt: str = "parquet") -> int:
    """Write ``df`` as a new version and make it the one that counts.
    Returns its number. The rows are rebalanced by the partition columns."""
    spark, target = df.sparkSession, target.rstrip("/")
    name = f"v-{uuid.uuid4().hex}"
    rows = df.hint("rebalance", *partition_cols) if partition_cols else df
    rows.write.format(fmt).partitionBy(*partition_cols).save(f"{target}/{name}")
    while True:
        done = commits(spark, target)
        number = int(done[-1]) + 1 if done else 0
        if commit(spark, target, f"{number:012d}", {"folder": name, "fmt": fmt}):
            return number


def current_version(spark: SparkSession, target: str) -> tuple[int, str, str]:
    """(number, path, format) of the version that counts."""
    target = target.rstrip("/")
    done = commits(spark, target)
    if not done:
        raise FileNotFoundError(f"no committed version under {target}")
    facts = facts_of(spark, target, done[-1])
    return int(done[-1]), f"{target}/{facts['folder']}", facts["fmt"]


def read_version(spark: SparkSession, target: str, schema: str | None = None) -> DataFrame:
    """The version that counts when this is called."""
    _, path, fmt = current_version(spark, target)
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema else reader).load(path)


def remove_old(spark: SparkSession, target: str, keep: int = 2) -> int:
    """Remove all but the last ``keep`` versions, and folders of writes that
    never committed. Not to be called while a writer is at work. Returns
    the number of folders removed."""
    target = target.rstrip("/")
    done = commits(spark, target)
    kept = {facts_of(spark, target, n)["folder"] for n in done[-keep:]}
    fs, where = file_system(spark, target)
    for name in done[:-keep]:                    # markers first: none may name a folder that is gone
        fs.delete(file_system(spark, f"{target}/{MARKERS}/{name}")[1], False)
    gone = [s.getPath() for s in fs.listStatus(where)
            if s.isDirectory() and s.getPath().getName().startswith("v-") and s.getPath().getName() not in kept]
    for path in gone:
        fs.delete(path, True)
    return len(gone)


def swap_in(spark: SparkSession, staged: str, target: str) -> None:
    """Put a finished folder in the place of ``target``: the old one moves
    aside, the new one in, and the old one goes. If the move fails the old
    one comes back."""
    fs, new = file_system(spark, staged)
    place, aside = (file_system(spark, p)[1] for p in (target, f"{target}{ASIDE}"))
    if fs.exists(place):
        fs.delete(aside, True)
        if not fs.rename(place, aside):
            raise OSError(f"{target} cannot be moved aside")
    if not fs.rename(new, place):
        if fs.exists(aside):
            fs.rename(aside, place)
        raise OSError(f"{staged} cannot be moved to {target}")
    fs.delete(aside, True)


ASIDE = ".replaced"


def restore(spark: SparkSession, target: str) -> bool:
    """Bring back a table that a swap, stopped between its two moves, left aside."""
    fs, place = file_system(spark, target)
    aside = file_system(spark, f"{target}{ASIDE}")[1]
    return not fs.exists(place) and fs.exists(aside) and bool(fs.rename(aside, place))

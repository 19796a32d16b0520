"""Shared-folder helpers: lineage cuts and scratch tables that outlive executors.

Scratch tables of one application lie together under ``<spark.checkpoint.dir>/cargolens/<application id>``,
so that whatever a job leaves behind can be removed with one call (or one delete) when its results are stored.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a temporary one only for a single local process without it."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="cargolens-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_root(spark: SparkSession) -> str:
    """Where this application's scratch tables lie."""
    return f"{shared_folder(spark)}/cargolens/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


#: Writer options of whole tables of records: a quarter less to write than by default.
SMALL = {"compression": "zstd"}


def stored(df: DataFrame, name: str, partition_by: tuple[str, ...] = (), **options) -> DataFrame:
    """The frame written to a scratch table and read again: later reads prune columns and need no lineage.

    ``options`` are those of the Parquet writer.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows that a task must have for each folder, on average, to write a file of its own there.
MANY_ROWS = 10_000


def many_in_folders(rows: DataFrame, tasks: int) -> bool:
    """Whether so many tasks hold enough of ``rows`` (counts ``_n`` by folder) to write their shares of each folder as files."""
    total, folders = rows.agg(F.coalesce(F.sum("_n"), F.lit(0)), F.count(F.lit(1))).first()
    return total > 0 and total >= MANY_ROWS * folders * tasks


@contextmanager
def unsorted_writes(spark: SparkSession, folders: int = 200) -> Iterator[None]:
    """Inside, a task keeps files of up to so many folders open, instead of sorting its rows by folder before it writes."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, str(folders))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of a frame whose exact rows several branches rely on."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


#: The JVM's path class for each gateway: looking it up by its name takes several calls.
_PATHS: dict[int, object] = {}


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    if id(jvm) not in _PATHS:
        _PATHS.clear()
        _PATHS[id(jvm)] = jvm.org.apache.hadoop.fs.Path
    return _PATHS[id(jvm)](path)


def _file_system(spark: SparkSession, path: str):
    place = _path(spark, path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, on any file system Spark can read."""
    files, place = _file_system(spark, path)
    return files.exists(place)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that this package wrote; nothing happens if it is gone."""
    files, place = _file_system(spark, path)
    files.delete(place, True)


def clear_scratch(spark: SparkSession) -> None:
    """Delete all scratch tables of this application, once its results are stored elsewhere."""
    remove_path(spark, scratch_root(spark))


def files_under(spark: SparkSession, path: str) -> dict[str, int]:
    """Data files below a folder by their relative path, with their bytes; none if the folder is missing."""
    files, place = _file_system(spark, path)
    if not files.exists(place):
        return {}
    found, root = {}, files.resolvePath(place).toUri().getPath().rstrip("/") + "/"
    entries = files.listFiles(place, True)
    while entries.hasNext():
        entry = entries.next()
        name = entry.getPath().toUri().getPath().removeprefix(root)
        if not any(part.startswith(("_", ".")) for part in name.split("/")):
            found[name] = entry.getLen()
    return found


def move_file(spark: SparkSession, source: str, target: str) -> None:
    """Move one file, replacing what lies at the target; both paths belong to one file system."""
    files, place = _file_system(spark, source)
    there = _path(spark, target)
    if files.exists(there):
        files.delete(there, False)
    elif not files.exists(there.getParent()):
        files.mkdirs(there.getParent())
    if not files.rename(place, there):
        raise OSError(f"can't move {source} to {target}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there with its whole content or not at all."""
    files, place = _file_system(spark, f"{path}.part")
    stream = files.create(place, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    move_file(spark, f"{path}.part", path)


def read_text(spark: SparkSession, path: str) -> str | None:
    """Content of a small file; None if it is missing."""
    files, place = _file_system(spark, path)
    if not files.exists(place):
        return None
    stream = files.open(place)
    text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return text

"""Replacing what a folder holds only when the new content is complete.

``publish`` writes a new version beside the one before, and then switches by one rename of a
small file, ``current``, that names it: for models, which this package alone reads.
``replace`` writes a table beside the one before and then renames both, so that any reader finds a plain
folder. With either, a job that is killed while it writes leaves the earlier content readable.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

# The file that names the version, and the folder of the versions.
CURRENT, VERSIONS = "current", "versions"


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def publish(spark: SparkSession, path: str, write: Callable[[str], None]) -> str:
    """Let ``write`` fill a new folder, then make it the one that ``path`` stands for; older versions go."""
    hadoop, files = spark._jvm.org.apache.hadoop.fs, _file_system(spark, path)
    version = uuid.uuid4().hex
    write(f"{path}/{VERSIONS}/{version}")
    note = hadoop.Path(f"{path}/.{CURRENT}-{version}")
    out = files.create(note, True)
    out.write(bytearray(version.encode()))
    out.close()
    context = hadoop.FileContext.getFileContext(files.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(files.makeQualified(note), files.makeQualified(hadoop.Path(f"{path}/{CURRENT}")), options)
    for old in files.listStatus(hadoop.Path(f"{path}/{VERSIONS}")):
        if old.getPath().getName() != version:
            files.delete(old.getPath(), True)
    return path


def published(spark: SparkSession, path: str) -> str:
    """The folder that ``path`` stands for; a path without one raises Spark's own error."""
    version = spark.read.text(f"{path}/{CURRENT}").first().value
    return f"{path}/{VERSIONS}/{version}"


def replace(spark: SparkSession, path: str, write: Callable[[str], None]) -> str:
    """Let ``write`` fill a new folder beside ``path``, then put it in the place of what is there.

    The folders beside it have names that readers skip. Between the two renames, which take no time on file
    systems that can rename, ``path`` is missing; a failure there leaves the earlier content beside it and puts it back.
    """
    hadoop, files = spark._jvm.org.apache.hadoop.fs, _file_system(spark, path)
    target, mark = hadoop.Path(path), uuid.uuid4().hex
    new, old = (hadoop.Path(target.getParent(), f".{target.getName()}-{mark}-{kind}") for kind in ("new", "old"))
    try:
        write(new.toString())
        earlier = files.exists(target)
        if earlier and not files.rename(target, old):
            raise OSError(f"{path} could not be moved aside.")
        if not files.rename(new, target):
            if earlier:
                files.rename(old, target)
            raise OSError(f"The new content of {path} could not be moved there.")
        files.delete(old, True)
    finally:
        files.delete(new, True)
    return path

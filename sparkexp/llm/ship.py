"""Sending this package to the executors' Python."""

from __future__ import annotations

import functools
import io
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyarrow import fs
from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

import sparkexp
from sparkexp.sources.scratch import scratch_path

_sent: list[SparkContext] = []


def ship_package(spark: SparkSession) -> None:
    """Let tasks import this package wherever it is not installed; once for each Spark context."""
    context = spark.sparkContext
    if any(known is context for known in _sent):
        return
    root = Path(sparkexp.__file__).parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, f"sparkexp/{file.relative_to(root)}")
    folder = scratch_path(spark, "package")
    store, place = fs.FileSystem.from_uri(folder)
    store.create_dir(place, recursive=True)
    with store.open_output_stream(f"{place}/sparkexp.zip", compression=None) as out:
        out.write(packed.getvalue())
    context.addPyFile(f"{folder}/sparkexp.zip")
    _sent[:] = [context]


def shipped(function: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The function, called with a session first, after the package was sent."""

    @functools.wraps(function)
    def call(spark: SparkSession, *arguments) -> DataFrame:
        ship_package(spark)
        return function(spark, *arguments)

    return call

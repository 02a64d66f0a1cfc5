"""Months appended by committed batches: a rerun replaces its own rows, a reader sees all of a batch or nothing.

A batch's rows go to a folder of their own. A manifest of the batch, with its files and their sizes, is
written last and moved into place in one step; that move is the commit. Rows of a batch that was stopped
before are in no manifest and are never read. Of several commits the latest has a month, whether
the same batch was run again or another one brought the month anew.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

MANIFEST = "batch string, place long, folder string, month string, file string, bytes long"
#: Files of a manifest at most; its tasks look up the sizes.
MANIFEST_FILES = 16


def _system(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _children(spark: SparkSession, path: str) -> list:
    system, folder = _system(spark, path)
    return list(system.listStatus(folder)) if system.exists(folder) else []


def stage_batch(df: DataFrame, path: str, month: str, batch_size: int = 5_000_000) -> str:
    """Write the rows of a batch, in files of at most ``batch_size`` rows of a month; the folder's name.

    Tasks move their own files into the folder, which no reader sees before the manifest. A task that is
    run again has the same rows, so it writes files of the same names.
    """
    folder = f"rows-{uuid.uuid4().hex}"
    writer = df.write.partitionBy(month).option("maxRecordsPerFile", batch_size)
    writer.option("mapreduce.fileoutputcommitter.algorithm.version", "2").parquet(f"{path}/{folder}")
    return folder


def staged_files(spark: SparkSession, path: str, folder: str, month: str) -> DataFrame:
    """(month, file, bytes) of a staged batch, looked up in tasks; no file is opened."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    steps = F.split("path", "/")
    named = found.load(f"{path}/{folder}").select(
        F.element_at(steps, -2).alias("part"), F.element_at(steps, -1).alias("file"), F.col("length").alias("bytes")
    )
    value = F.expr(f"substring(part, {len(month) + 2})")
    return named.filter(F.col("part").startswith(f"{month}=")).select(value.alias("month"), "file", "bytes")


def commit_batch(spark: SparkSession, path: str, folder: str, batch: str, month: str) -> None:
    """Make a staged batch the one that has its months."""
    place = max((int(c.getPath().getName().partition("-")[0]) for c in _children(spark, f"{path}/_commits")), default=0) + 1
    rows = staged_files(spark, path, folder, month).select(
        F.lit(batch).alias("batch"), F.lit(place).cast("long").alias("place"), F.lit(folder).alias("folder"), "month", "file", "bytes"
    )
    waiting = f"{path}/_waiting-{uuid.uuid4().hex}"
    rows.coalesce(MANIFEST_FILES).write.parquet(waiting)
    system, source = _system(spark, waiting)
    _, commits = _system(spark, f"{path}/_commits")
    system.mkdirs(commits)
    _, target = _system(spark, f"{path}/_commits/{place:08d}-{uuid.uuid4().hex}")
    if not system.rename(source, target):
        raise OSError(f"the commit of batch {batch} could not be moved into place")


def append_months(df: DataFrame, path: str, batch: str, month: str = "trip_month", batch_size: int = 5_000_000) -> None:
    """Add the months of ``df`` as batch ``batch``, replacing what earlier commits have of them."""
    spark = df.sparkSession
    commit_batch(spark, path, stage_batch(df, path, month, batch_size), batch, month)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """The files that count: for each month those of its latest commit."""
    commits = [c.getPath().toString() for c in _children(spark, f"{path}/_commits")]
    if not commits:
        return spark.createDataFrame([], MANIFEST)
    found = spark.read.schema(MANIFEST).parquet(*commits)
    latest = Window.partitionBy("month").orderBy(F.desc("place"))
    # A row for each month and commit: few.
    heads = found.groupBy("month", "place", "folder").agg(F.first("batch").alias("batch"))
    heads = heads.withColumn("_n", F.row_number().over(latest)).filter("_n = 1")
    return found.join(heads.select("month", "place", "folder"), ["month", "place", "folder"], "left_semi").select(*found.columns)


def read_months(spark: SparkSession, path: str, month: str = "trip_month") -> DataFrame:
    """The rows of all committed months."""
    months = manifest(spark, path).select("folder", "month").distinct().collect()
    if not months:
        raise FileNotFoundError(f"no batch is committed at {path}")
    by_folder: dict[str, list[str]] = {}
    for r in months:
        by_folder.setdefault(r["folder"], []).append(r["month"])
    parts = [
        spark.read.option("basePath", f"{path}/{folder}").parquet(*[f"{path}/{folder}/{month}={m}" for m in sorted(own)])
        for folder, own in sorted(by_folder.items())
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole


def files_over(spark: SparkSession, path: str, rows: int, month: str = "trip_month") -> int:
    """How many committed files have more than ``rows`` rows."""
    counts = read_months(spark, path, month).groupBy(F.input_file_name()).agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") > rows).count()

"""Shared scratch folder, materialised intermediate tables, and bounded collection."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


#: Attribute of a written table: where it is.
_PATH = "_scratch_path"


def scratch_root(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a temporary one only for a local master."""
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if shared:
        return shared.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    context.setCheckpointDir(f"file://{tempfile.mkdtemp(prefix='waitspark-')}")
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the scratch folder, removed when the application ends."""
    path = f"{scratch_root(spark)}/waitspark-{name}-{uuid.uuid4().hex}"
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    file_system = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    file_system.mkdirs(jvm_path)
    file_system.deleteOnExit(jvm_path)
    return f"{path}/data"


def materialize(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The copy is columnar, so later passes read only what they need. Its size is known, so a join
    broadcasts it if it lies below the session's threshold and shuffles otherwise. And it outlives
    a lost executor. ``discard`` frees it before the application ends.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.partitionBy(*partition_by).parquet(path)
    schema = T.StructType(
        [f for f in df.schema if f.name not in partition_by] + [df.schema[c] for c in partition_by]
    )
    written = df.sparkSession.read.schema(schema).parquet(path).select(df.columns)
    written.__dict__[_PATH] = path
    return written


def discard(*tables: DataFrame) -> None:
    """Delete written tables of ``materialize`` that no later step reads, not even on a retry."""
    for table in tables:
        path = table.__dict__.pop(_PATH, None)
        if path:
            spark = table.sparkSession
            folder = spark._jvm.org.apache.hadoop.fs.Path(path).getParent()
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def shuffles_freed(spark: SparkSession, rows_at_once: int) -> Iterator[None]:
    """Within it, what an action has shuffled is deleted as soon as the action ends, and Python gets so many rows at once."""
    wanted = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxRecordsPerBatch": str(rows_at_once)}
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def local_table(
    spark: SparkSession, rows: Sequence[tuple], schema: T.StructType
) -> DataFrame:
    """A few driver rows as a table; handed over as Arrow, so the optimizer knows its size."""
    columns = list(zip(*rows)) or [()] * len(schema.fields)
    return spark.createDataFrame(pa.table(dict(zip(schema.names, columns))), schema)


def collect_small(df: DataFrame, max_rows: int = 100_000):
    """``df`` as pandas, refused if it has more than ``max_rows`` rows."""
    got = df.limit(max_rows + 1).toPandas()
    if len(got) > max_rows:
        raise ValueError(f"more than {max_rows} rows: aggregate before collecting")
    return got

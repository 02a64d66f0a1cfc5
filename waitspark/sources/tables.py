"""Readers and writers of trips, weather, zones and the processed table."""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waitspark.functions.hashing import in_hash_sample
from waitspark.operators.sampling import hash_sample, sample
from waitspark.schema import SEED, WEATHER_SCHEMA, ZONE_SCHEMA

# Quotes inside a cell are doubled, as spreadsheets and pandas write and read them.
CSV_OPTIONS = {"header": True, "escape": '"', "encoding": "UTF-8"}


def read_trips(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | None = None,
    fraction: float | None = None,
    seed: int = SEED,
    file: str | None = None,
    row: str | None = None,
) -> DataFrame:
    """All entries of ``path`` whose names end in ``.parquet`` as one table, matched by name.

    An entry is a file or a directory of files; partition columns of a directory are kept. A column
    that an entry lacks is null there, and numbers of different width widen. With a ``schema``
    wanted, the result has its columns and types. ``file`` and ``row`` name columns for each row's file and
    its place there, by which ``sample_files`` draws from each file the same rows however it is split.
    """
    paths = [path] if isinstance(path, str) else list(path)
    parts = []
    for part in _tables(spark, [e for p in paths for e in parquet_entries(spark, p)]):
        for name, source in ((file, "file_path"), (row, "row_index")):
            if name:
                part = part.withColumn(name, F.col(f"_metadata.{source}"))
        parts.append(part)
    trips = parts[0]
    for part in parts[1:]:
        trips = trips.unionByName(part, allowMissingColumns=True)
    if schema:
        present = set(trips.columns)
        columns = [
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema
        ]
        trips = trips.select(*columns, *[name for name in (file, row) if name])
    return sample(trips, fraction, seed)


def _tables(spark: SparkSession, entries: Sequence[tuple[str, bool]]) -> list[DataFrame]:
    """The entries as few tables: plain files whose columns go together are one, whose schema one job finds."""

    def read(*names: str) -> DataFrame:
        return spark.read.options(mergeSchema=True, pathGlobFilter="*.parquet").parquet(*names)

    files = [name for name, folder in entries if not folder and "=" not in name]
    parts, rest = [], [name for name, folder in entries if folder or "=" in name]
    if files:
        try:
            parts.append(read(*files))
        except (Py4JJavaError, PySparkException) as error:
            if "CANNOT_MERGE" not in str(error):
                raise
            rest = files + rest
    by_schema: dict[str, list[str]] = {}
    for name in rest:
        kinds = str(sorted(read(name).dtypes))
        by_schema.setdefault(name if "=" in name else kinds, []).append(name)
    # Folders with partition columns of their own stand by themselves.
    return parts + [read(*same) for same in by_schema.values()]


def parquet_entries(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """(name, whether it is a folder) of a folder's entries that end in ``.parquet``; of ``path`` where it is one or has none."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if folder.getName().endswith(".parquet"):
        return [(path, system.getFileStatus(folder).isDirectory())]
    found = [(s.getPath(), s.isDirectory()) for s in system.listStatus(folder)]
    names = [(p.toString(), d) for p, d in found if p.getName().endswith(".parquet") and p.getName()[0] not in "._"]
    return sorted(names) or [(path, True)]


def sample_files(trips: DataFrame, fraction: float, file: str = "file_path", row: str = "row_index") -> DataFrame:
    """A share of each file's rows, drawn by the row's place in its file."""
    return hash_sample(trips, [file, row], fraction)


def file_counts(
    trips: DataFrame,
    keys: Sequence[str],
    fraction: float = 1.0,
    file: str = "file_path",
) -> DataFrame:
    """Rows and sampled rows per input file, in one pass over the files' key columns.

    ``file`` is the column of paths that ``read_trips`` adds; files of one name in different folders
    stay apart.
    """
    sampled = F.lit(True) if fraction >= 1 else in_hash_sample(keys, fraction)
    counts = trips.groupBy(F.col(file).alias("_path")).agg(
        F.count(F.lit(1)).alias("original_rows"),
        F.count_if(sampled).alias("sampled_rows"),
    )
    name = F.element_at(F.split("_path", "/"), -1).alias("file_name")
    return counts.select(name, "original_rows", "sampled_rows", F.col("_path").alias("file_path"))


def read_weather(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.options(**CSV_OPTIONS).schema(WEATHER_SCHEMA).csv(path)


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """The zone lookup; the text "N/A" is a value, not a null."""
    return spark.read.options(**CSV_OPTIONS).schema(ZONE_SCHEMA).csv(path)


def read_processed(
    spark: SparkSession, path: str, fraction: float | None = None, seed: int = SEED
) -> DataFrame:
    return sample(spark.read.parquet(path), fraction, seed)


def write_processed(
    df: DataFrame, path: str, partition_by: Sequence[str] = ()
) -> None:
    """Replaces what is at ``path``."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def append_in_batches(df: DataFrame, path: str, batch_size: int = 5_000_000) -> None:
    """Appends all rows in one job, in files of at most ``batch_size`` rows."""
    df.write.mode("append").option("maxRecordsPerFile", batch_size).parquet(path)


def one_line(df: DataFrame) -> DataFrame:
    """``df`` with line breaks in its texts as spaces: a record is one line, so large files can be split."""
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.regexp_replace(F.col(c), r"\s*[\r\n]+\s*", " ") for c in texts})


def append_csv(df: DataFrame, path: str) -> None:
    """Appends rows to a folder of CSV files; every file has its own header.

    A line break in a cell becomes a space.
    """
    writer = one_line(df).write.mode("append").options(**CSV_OPTIONS)
    writer = writer.option("ignoreLeadingWhiteSpace", False)
    writer.option("ignoreTrailingWhiteSpace", False).csv(path)


def count_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Reads the folder back and counts its records."""
    rows = spark.read.options(**CSV_OPTIONS).schema(schema).csv(path)
    return rows.agg(F.count(F.lit(1)).alias("records"))


def preview(df: DataFrame, order_by: Sequence[str], rows: int = 2) -> DataFrame:
    """The first rows in a fixed order."""
    return df.orderBy(*order_by).limit(rows)

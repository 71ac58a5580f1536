"""Parquet and JSON tables, SQL views over them, and ad-hoc SQL."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from math import ceil
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType

from profitlens.functions.arithmetic import null_if_not_finite

ROWS_A_FILE = 1 << 19


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The parquet table, or an empty one with the same columns if there is none; numbers that are not finite are null."""
    try:
        return finite_doubles(spark.read.schema(schema).parquet(path))
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def finite_doubles(df: DataFrame) -> DataFrame:
    """NaN and infinite values as null, so that no comparison takes NaN for a large number."""
    numbers = [f.name for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))]
    return df.withColumns({c: null_if_not_finite(F.col(c)) for c in numbers}) if numbers else df


def write_table(df: DataFrame, folder: str, name: str, narrow: bool = False) -> str:
    """One parquet table (Snappy) under ``folder``; returns its path."""
    path = f"{folder.rstrip('/')}/{name}.parquet"
    (narrow_floats(df) if narrow else df).write.mode("overwrite").option("compression", "snappy").parquet(path)
    return path


def write_clustered(
    df: DataFrame, folder: str, name: str, partition_by: Sequence[str], cluster_by: Sequence[str], files: int = 1
) -> str:
    """A parquet table in a folder per partition value, rows in the order of ``cluster_by`` inside.

    Rows are dealt out in ranges of all these columns, so a large partition is
    several files of neighbouring values, whose statistics let a scan skip them.
    There are ``files`` times as many ranges as partition values, and more where a
    range would have over ``ROWS_A_FILE`` rows. Rows that agree in all these
    columns are divided by the hash of the whole row: no value makes a large task.
    Selections of partition values read no other folder.
    """
    path = f"{folder.rstrip('/')}/{name}.parquet"
    keys = [*partition_by, *cluster_by]
    sizes = df.groupBy(*partition_by).agg(F.count("*").alias("rows"))
    values, rows = sizes.agg(F.count("*"), F.coalesce(F.sum("rows"), F.lit(0))).first()
    ranges = max(1, values * files, ceil(rows / ROWS_A_FILE))
    ranged = df.repartitionByRange(ranges, *keys, F.xxhash64(*df.columns)).sortWithinPartitions(*keys)
    ranged.write.mode("overwrite").option("compression", "snappy").partitionBy(*partition_by).parquet(path)
    return path


def write_bucketed(df: DataFrame, path: str, table: str, key: str, buckets: int) -> DataFrame:
    """A catalog table of files hashed and sorted by ``key``; tables with as many buckets are joined on it where they lie.

    ``path`` is a folder that all executors reach. One file per bucket is written.
    """
    spark = df.sparkSession
    dealt = df.repartition(buckets, key).sortWithinPartitions(key)
    dealt.write.mode("overwrite").format("parquet").option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    return spark.table(table)


def narrow_floats(df: DataFrame) -> DataFrame:
    """Double columns as float: half the size, seven digits."""
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, DoubleType)]
    return df.withColumns({c: F.col(c).cast("float") for c in doubles})


def write_json(df: DataFrame, path: str) -> None:
    """Small result tables (KPI rows, reports), one JSON object per line."""
    df.write.mode("overwrite").json(path)


def read_json(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """A JSON document, also one spread over several lines."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)


def register_views(spark: SparkSession, paths: Iterable[str]) -> list[str]:
    """Register each parquet table as a view named like its file."""
    names = []
    for path in paths:
        name = path.rstrip("/").rsplit("/", 1)[-1].removesuffix(".parquet")
        finite_doubles(spark.read.parquet(path)).createOrReplaceTempView(name)
        names.append(name)
    return names


def list_tables(spark: SparkSession, folder: str) -> list[str]:
    """Paths of the parquet tables in a folder of any file system Spark can reach."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = (status.getPath().toString() for status in files.listStatus(hadoop_path))
    return sorted(path for path in found if path.endswith(".parquet"))


def run_sql(spark: SparkSession, text: str, args: Mapping[str, Any] | None = None) -> DataFrame:
    """SQL over the registered views; values go in as named parameters."""
    return spark.sql(text, args=dict(args or {}))


def preview(df: DataFrame, keys: list[str], rows: int = 100) -> DataFrame:
    """The first rows in key order."""
    return df.orderBy(*keys).limit(rows)

"""Session settings, the shared working folder, and tables staged in it."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def local_session(folder: str, cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and for the bench, which stages tables in ``folder``; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("profitlens")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", folder)
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach: the one named in ``spark.checkpoint.dir`` or with ``name_shared_folder``."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return named.rstrip("/")


def name_shared_folder(spark: SparkSession, choose: Callable[[], str]) -> None:
    """Use the chosen folder on a single machine whose session names none; a cluster has to name its own."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named and (context.master == "local" or context.master.startswith("local[")):
        context.setCheckpointDir(choose())


_scope: ContextVar[str] = ContextVar("staging_scope", default="open")


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """What is staged inside goes when the block ends; results have to be written by then."""
    scope = uuid.uuid4().hex
    token = _scope.set(scope)
    try:
        yield
    finally:
        _scope.reset(token)
        _delete(spark, f"{staged_root(spark)}/{scope}")


def staged_root(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/profitlens/{spark.sparkContext.applicationId}"


def staged_path(spark: SparkSession, name: str) -> str:
    return f"{staged_root(spark)}/{_scope.get()}/{uuid.uuid4().hex}/{name}"


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drop_staged(spark: SparkSession) -> None:
    """Delete what this application staged; call it when no result is needed any more."""
    _delete(spark, staged_root(spark))


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where several branches need the same expensive table: lineage is cut,
    a lost executor costs no recomputation, and each branch reads only its own
    columns.
    """
    spark = df.sparkSession
    path = staged_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

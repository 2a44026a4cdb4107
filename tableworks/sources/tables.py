"""Stored tables: parquet by default, any installed format (such as Delta) by name."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shuffles_freed

# What a finished table holds at its root. A half-written folder has neither.
_MARKERS = {"delta": "_delta_log"}
_PLAIN_MARKER = "_SUCCESS"


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A parquet file, or every parquet file of a folder."""
    return spark.read.parquet(path)


def scan_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    return jvm.org.apache.hadoop.fs.Path(path)


def table_exists(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:
    """Looks through the Hadoop file system, so object stores work like local folders."""
    marker = _hadoop_path(spark, f"{path}/{_MARKERS.get(fmt, _PLAIN_MARKER)}")
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return marker.getFileSystem(conf).exists(marker)


def _write(df: DataFrame, path: str, partition_by: Sequence[str], fmt: str) -> None:
    if partition_by:
        # Rebalancing gathers each partition's rows into few files, and splits a partition
        # that is too large for one task.
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format(fmt).mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def sink_if_absent(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    derive: Mapping[str, Column] | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Write unless ``path`` already is a table; ``derive`` adds columns to the copy only.

    Returns the input. An existing table is left as it is, even if the input has new rows.
    """
    if not table_exists(df.sparkSession, path, fmt):
        _write(df.withColumns(dict(derive or {})), path, partition_by, fmt)
    return df


def sink_overwrite(
    df: DataFrame, path: str, partition_by: Sequence[str] = ("year",), fmt: str = "parquet"
) -> DataFrame:
    """Replace the table at ``path``. Returns the input."""
    _write(df, path, partition_by, fmt)
    return df


def sink_bucketed(
    df: DataFrame, table: str, path: str, key: str, order: str, buckets: int
) -> DataFrame:
    """Store a series table in buckets of ``key``, each one file sorted by (key, order).

    Windows and joins over ``key`` then need no shuffle, however often the table is read: the one
    made here is the last. ``table`` names it in the session's catalog; an old one of that name is
    replaced. Give as many buckets as later jobs shall have tasks. Returns the stored table.
    """
    spark = df.sparkSession
    dealt = df.repartition(buckets, key).sortWithinPartitions(key, order)
    writer = dealt.write.bucketBy(buckets, key).sortBy(key, order).option("path", path)
    with shuffles_freed(spark):
        writer.mode("overwrite").saveAsTable(table)
    return spark.table(table)


def list_tables(spark: SparkSession, folder: str, suffix: str = ".parquet") -> list[str]:
    """Sorted paths of the tables in a folder; names only, no data is read."""
    root = _hadoop_path(spark, folder)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [status.getPath().toString() for status in files.listStatus(root)]
    return sorted(path for path in found if path.endswith(suffix))


def sink_many_tables(
    spark: SparkSession,
    source_dir: str,
    target_dir: str,
    fmt: str = "parquet",
    suffix: str = ".parquet",
) -> list[str]:
    """Copy every table of a folder unpartitioned, skipping those already there."""
    targets = []
    for source in list_tables(spark, source_dir, suffix):
        name = source.rstrip("/").rsplit("/", 1)[-1].removesuffix(suffix)
        target = f"{target_dir}/{name}"
        sink_if_absent(scan_parquet(spark, source), target, fmt=fmt)
        targets.append(target)
    return targets


def scan_sql_file(spark: SparkSession, view: str, path: str, distinct: bool = False) -> DataFrame:
    """``CREATE OR REPLACE VIEW view AS SELECT [DISTINCT] * FROM file``, then the view."""
    rows = "DISTINCT *" if distinct else "*"
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {view} AS SELECT {rows} FROM parquet.`{path}`")
    return spark.table(view)


def describe_schema(df: DataFrame) -> DataFrame:
    """Column names and types of a query, as rows."""
    return df.sparkSession.sql("DESCRIBE QUERY SELECT * FROM {query}", query=df).select(
        "col_name", "data_type"
    )


def year_of(date: str) -> dict[str, Column]:
    """The usual derived partition column."""
    return {"year": F.year(date)}

"""Tables that are refreshed in place: missing partitions, and versions published whole.

A published table is a folder of versions and a small pointer file that names the current one.
A version is written beside the others and becomes current when the pointer is replaced, one rename
that either happens or does not. Until then readers see the version before, so a job that dies
leaves the old rows, and a job may read the table that it replaces.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import remove_path, stored
from .tables import sink_overwrite, table_exists

POINTER = "_CURRENT"
_PREFIX = "v-"


# ---------------------------------------------------------------- partitions


def _null_safe(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[n].eqNullSafe(right[f"_have_{n}"]) for n in names])


def partition_values(table: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """The partitions of a table, one row each, told from folders and footers alone."""
    return table.select(*partition_by).distinct()


def sink_missing_partitions(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    derive: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Write the rows of those partitions that the table at ``path`` does not have yet.

    Files of the partitions that it has are left untouched, and their rows in ``df`` are ignored; null
    is a partition like any other. A first run writes everything. ``derive`` adds columns to the copy
    only. New partitions appear when the job commits, each whole: a run that dies adds none, and the
    next one writes them. Returns what was written, read back: no rows where nothing was missing.
    """
    spark, names = df.sparkSession, list(partition_by)
    copy = df.withColumns(dict(derive or {}))
    if not table_exists(spark, path):
        sink_overwrite(copy, path, names)
        return spark.read.schema(copy.schema).parquet(path)
    # Stored first: the write must not depend on the listing that it changes.
    there = spark.read.schema(copy.schema).parquet(path)
    present = stored(partition_values(there, names), "partitions")
    have = present.select(*[F.col(n).alias(f"_have_{n}") for n in names])
    missing = copy.join(have, _null_safe(copy, have, names), "left_anti")
    (
        missing.hint("rebalance", *names)
        .write.partitionBy(*names)
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .parquet(path)
    )
    whole = spark.read.schema(copy.schema).parquet(path)
    return whole.join(have, _null_safe(whole, have, names), "left_anti")


def sink_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> DataFrame:
    """Replace the partitions that ``df`` has rows of and leave all others untouched."""
    names = list(partition_by)
    (
        df.hint("rebalance", *names)
        .write.partitionBy(*names)
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .parquet(path)
    )
    return df


# ---------------------------------------------------------------- versions


def _files(spark: SparkSession, path: str):
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(conf), target


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None where there is no file."""
    files, target = _files(spark, path)
    if not files.exists(target):
        return None
    stream = files.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write beside the file and rename over it: readers see the old text or the new one."""
    files, fresh = _files(spark, f"{path}.{uuid.uuid4().hex}")
    stream = files.create(fresh)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    _, target = _files(spark, path)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fresh.toUri(), conf)
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    over = spark.sparkContext._gateway.new_array(rename, 1)
    over[0] = rename.OVERWRITE
    context.rename(files.makeQualified(fresh), files.makeQualified(target), over)


def current_version(spark: SparkSession, root: str) -> str | None:
    """Path of the published version; None before the first."""
    name = read_text(spark, f"{root}/{POINTER}")
    return f"{root}/{name}" if name else None


def new_version(root: str) -> str:
    """A path for a version to be written to. Names sort by the time they were made."""
    return f"{root}/{_PREFIX}{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def point_to(spark: SparkSession, root: str, version: str) -> None:
    """Make a version that is written the current one."""
    replace_text(spark, f"{root}/{POINTER}", version.rsplit("/", 1)[-1])


def publish(
    df: DataFrame,
    root: str,
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
    view: str | None = None,
) -> str:
    """Write ``df`` as the next version of the table at ``root`` and make it current.

    ``df`` may read the current version. ``view`` names a catalog view that is replaced to show the
    new version, for users who query by name. Returns the version's path.
    """
    spark, version = df.sparkSession, new_version(root)
    sink_overwrite(df, version, partition_by, fmt)
    point_to(spark, root, version)
    if view is not None:
        spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM {fmt}.`{version}`")
    return version


def published(spark: SparkSession, root: str, fmt: str = "parquet") -> DataFrame:
    """The current version. It stays readable while later ones are published."""
    version = current_version(spark, root)
    if version is None:
        raise FileNotFoundError(f"nothing is published at {root}")
    return spark.read.format(fmt).load(version)


def versions(spark: SparkSession, root: str) -> list[str]:
    """All version folders, finished or not, oldest first."""
    files, target = _files(spark, root)
    if not files.exists(target):
        return []
    names = [status.getPath().getName() for status in files.listStatus(target)]
    return [f"{root}/{name}" for name in sorted(names) if name.startswith(_PREFIX)]


def drop_versions(spark: SparkSession, root: str, keep: int = 1) -> list[str]:
    """Delete versions older than the current one but for the last ``keep - 1``; returns them.

    Versions later than the current one are left: a job may still be writing them.
    """
    current = current_version(spark, root)
    if current is None:
        return []
    older = [path for path in versions(spark, root) if path < current]
    gone = older[: max(0, len(older) - (keep - 1))]
    for path in gone:
        remove_path(spark, path)
    return gone

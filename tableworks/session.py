"""Session settings and the shared scratch folder. Operators never need this builder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

BASE = {
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}
DELTA = {
    "spark.sql.extensions": "io.delta.sql.DeltaSparkSessionExtension",
    "spark.sql.catalog.spark_catalog": "org.apache.spark.sql.delta.catalog.DeltaCatalog",
}
LOCAL = {"spark.master": "local[4]", "spark.driver.memory": "6g"}


def session_conf(
    conf: Mapping[str, str] | None = None,
    *,
    delta: bool = False,
    env: Mapping[str, str] = os.environ,
) -> dict[str, str]:
    """Merged settings; later profiles win and the caller's own settings win over all."""
    merged = {"spark.app.name": env.get("SPARK_APP_NAME", "local"), **BASE}
    if delta:
        merged |= DELTA
    if "KUBERNETES_SERVICE_HOST" not in env:
        merged |= LOCAL
    return merged | dict(conf or {})


def build_spark(conf: Mapping[str, str] | None = None, *, delta: bool = False) -> SparkSession:
    builder = SparkSession.builder
    for key, value in session_conf(conf, delta=delta).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: the session's ``spark.checkpoint.dir``.

    A machine-local folder is only right when driver and executors are one process.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root is None:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="tableworks-")
        context.setCheckpointDir(root)
    return root


_scratch: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; the innermost open ``scratch`` removes it."""
    path = f"{_shared_root(spark)}/{name}-{uuid.uuid4().hex}"
    paths = _scratch.get()
    if paths is not None:
        paths.append(path)
    return path


def remove_path(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Intermediate copies written inside go when the block ends.

    Plans are lazy: whatever reads the copies has to be written or collected inside, too.
    Outside any block copies stay, as checkpoints do, for whoever owns the folder to clear.
    """
    token = _scratch.set([])
    try:
        yield
    finally:
        paths = _scratch.get() or []
        _scratch.reset(token)
        for path in paths:
            remove_path(spark, path)


#: Spark then deletes what a query has shuffled as soon as the query ends, not when the driver collects garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a write made inside go when it ends: its table stands in for them."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write once below the shared folder and read back.

    It cuts the lineage like a checkpoint, so a lost executor costs no recomputation, but
    the copy is columnar: later passes prune columns and push filters into the scan. What
    was shuffled to make it is deleted when it is written.
    """
    path = scratch_path(df.sparkSession, name)
    with shuffles_freed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

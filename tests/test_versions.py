import os

import pytest
from pyspark.sql import functions as F

from tableworks.sources import versions


def rows(spark, *years):
    return spark.createDataFrame([(y, k) for y in years for k in range(20)], "year int, k int")


def seen(df):
    return sorted((r["year"] is not None, r["year"] or 0, r["k"]) for r in df.collect())


def files(path):
    return {
        os.path.join(folder, name): os.stat(os.path.join(folder, name)).st_mtime_ns
        for folder, _, names in os.walk(path)
        for name in names
        if name.endswith(".parquet")
    }


def raising(df):
    """The rows, until a task meets one that it cannot handle."""
    return df.withColumn("k", F.when(F.col("k") == 19, F.raise_error(F.lit("lost"))).otherwise(F.col("k")))


def test_missing_partitions_only(spark, tmp_path):
    path = str(tmp_path / "t")
    first = versions.sink_missing_partitions(rows(spark, 2001, 2002), path, ["year"])
    assert seen(first) == seen(rows(spark, 2001, 2002))
    before = files(path)
    # Rows of a year that is there are ignored, changed or not.
    more = rows(spark, 2001, 2002, 2003, None).withColumn("k", F.col("k") + 100)
    added = versions.sink_missing_partitions(more, path, ["year"])
    after = files(path)
    assert {f: t for f, t in after.items() if f in before} == before and len(after) > len(before)
    assert {r["year"] for r in added.select("year").distinct().collect()} == {2003, None}
    assert seen(spark.read.parquet(path)) == sorted(seen(rows(spark, 2001, 2002)) + seen(more.where("year = 2003 OR year IS NULL")))
    assert versions.sink_missing_partitions(more, path, ["year"]).isEmpty()
    assert files(path) == after


def test_first_run_without_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    assert versions.sink_missing_partitions(rows(spark, 2001).limit(0), path, ["year"]).isEmpty()
    assert seen(versions.sink_missing_partitions(rows(spark, 2001), path, ["year"])) == seen(rows(spark, 2001))


def test_several_partition_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    table = rows(spark, 2001, 2002).withColumn("part", F.col("k") % 3)
    versions.sink_missing_partitions(table.where("part < 2"), path, ["year", "part"])
    added = versions.sink_missing_partitions(table, path, ["year", "part"])
    assert {(r["year"], r["part"]) for r in added.collect()} == {(2001, 2), (2002, 2)}
    assert spark.read.parquet(path).count() == 40


def test_a_lost_run_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.sink_missing_partitions(rows(spark, 2001), path, ["year"])
    before = files(path)
    with pytest.raises(Exception, match="lost"):
        versions.sink_missing_partitions(raising(rows(spark, 2002, 2003)), path, ["year"])
    assert seen(spark.read.parquet(path)) == seen(rows(spark, 2001)) and files(path) == before
    versions.sink_missing_partitions(rows(spark, 2002, 2003), path, ["year"])
    assert seen(spark.read.parquet(path)) == seen(rows(spark, 2001, 2002, 2003))


def test_replaced_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.sink_partitions(rows(spark, 2001, 2002), path, ["year"])
    kept = {f: t for f, t in files(path).items() if "year=2001" in f}
    versions.sink_partitions(rows(spark, 2002).withColumn("k", F.lit(7)), path, ["year"])
    assert {f: t for f, t in files(path).items() if "year=2001" in f} == kept
    assert spark.read.parquet(path).where("year = 2002").select("k").distinct().collect() == [(7,)]


def test_publication(spark, tmp_path):
    root = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        versions.published(spark, root)
    versions.publish(rows(spark, 2001), root, ["year"], view="published_rows")
    old = versions.published(spark, root)
    # Reads the table that it replaces.
    versions.publish(old.unionByName(rows(spark, 2002)), root, ["year"], view="published_rows")
    want = seen(rows(spark, 2001, 2002))
    assert seen(versions.published(spark, root)) == want == seen(spark.table("published_rows"))
    assert seen(old) == seen(rows(spark, 2001))
    spark.sql("DROP VIEW published_rows")


def test_a_lost_write_leaves_the_old_rows(spark, tmp_path):
    root = str(tmp_path / "t")
    first = versions.publish(rows(spark, 2001), root)
    with pytest.raises(Exception, match="lost"):
        versions.publish(raising(rows(spark, 2002)), root)
    assert versions.current_version(spark, root) == first
    assert seen(versions.published(spark, root)) == seen(rows(spark, 2001))
    versions.publish(rows(spark, 2003), root)
    assert seen(versions.published(spark, root)) == seen(rows(spark, 2003))


def test_old_versions_go_on_request(spark, tmp_path):
    root = str(tmp_path / "t")
    assert versions.drop_versions(spark, root) == []
    made = [versions.publish(rows(spark, y), root) for y in (2001, 2002, 2003, 2004)]
    unfinished = versions.new_version(root)
    os.mkdir(unfinished)
    assert versions.versions(spark, root) == [*made, unfinished]
    assert versions.drop_versions(spark, root, keep=2) == made[:2]
    assert versions.drop_versions(spark, root) == [made[2]]
    assert versions.versions(spark, root) == [made[3], unfinished]
    assert seen(versions.published(spark, root)) == seen(rows(spark, 2004))
    assert not [name for name in os.listdir(root) if name.startswith(f"{versions.POINTER}.")]

"""Chains that are stored step by step: resumption, changed settings, counts."""

import os

import pytest
from pyspark.sql import functions as F

from tableworks.plans.pipeline import Pipeline, Step, StoredPipeline

ran = []


class Source(Step):
    def run(self, df):
        ran.append("source")
        return self.spark.range(10).withColumn("v", F.col("id") % 3)


class Keep(Step):
    def __init__(self, least):
        self.least = least

    def run(self, df):
        ran.append("keep")
        return df.where(F.col("id") >= self.least)


class Shift(Step):
    """Fails in its tasks while ``broken``; that is no setting."""

    broken = False

    def run(self, df):
        ran.append("shift")
        failing = F.raise_error(F.lit("lost")).cast("long")
        return df.withColumn("v", failing if Shift.broken else F.col("v") + 1)


@pytest.fixture
def chain(spark, tmp_path):
    ran.clear()
    Shift.broken = False

    def make(least=4, source="monday", steps=None):
        return StoredPipeline(steps or [Source(), Keep(least), Shift()], str(tmp_path), source)

    return make


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_resumes_with_the_step_that_failed(chain):
    want = rows(Pipeline([Source(), Keep(4), Shift()]).run())
    Shift.broken = True
    with pytest.raises(Exception, match="lost"):
        chain().run()
    # What the failed write left is no result.
    Shift.broken = False
    ran.clear()
    resumed = chain()
    assert rows(resumed.run()) == want and ran == ["shift"]
    assert [(r.name, r.rows, r.resumed) for r in resumed.runs] == [
        ("Source", 10, True), ("Keep", 6, True), ("Shift", 6, False),
    ]
    ran.clear()
    again = chain()
    assert rows(again.run()) == want and not ran and all(r.resumed for r in again.runs)


def test_changed_settings_redo_what_follows(chain):
    chain().run()
    ran.clear()
    assert chain(least=8).run().count() == 2 and ran == ["keep", "shift"]
    ran.clear()
    assert chain(source="tuesday").run().count() == 6 and ran == ["source", "keep", "shift"]
    ran.clear()
    # The first results are still there.
    assert chain().run().count() == 6 and not ran
    paths = [set(c.paths()) for c in (chain(), chain(least=8), chain(source="tuesday"))]
    assert len(paths[0] & paths[1]) == 1 and not paths[0] & paths[2]


def test_earlier_folders_may_be_gone(chain, spark):
    first = chain()
    first.run()
    os.rename(first.paths()[0], first.paths()[0] + "-moved")
    ran.clear()
    resumed = chain()
    assert resumed.run().count() == 6 and not ran
    assert [r.name for r in resumed.runs] == ["Keep", "Shift"]


def test_a_folder_without_its_record_is_done_again(chain):
    first = chain()
    first.run()
    os.rename(f"{first.paths()[2]}/_DONE", f"{first.paths()[2]}/_GONE")
    ran.clear()
    assert chain().run().count() == 6 and ran == ["shift"]


def test_empty_steps_and_tables(chain, spark):
    none = chain(least=99)
    assert none.run().count() == 0 and [r.rows for r in none.runs] == [10, 0, 0]
    assert chain(steps=[Keep(3)]).run(spark.range(5)).count() == 2
    df = spark.range(1)
    assert StoredPipeline([], "unused", "x").run(df) is df

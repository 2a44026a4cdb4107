"""A named chain of steps, each from DataFrame to DataFrame; stored step by step if wanted."""

from __future__ import annotations

import hashlib
import json
import logging
import time
from abc import ABC, abstractmethod
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import scan_table, table_exists
from ..sources.versions import read_text, replace_text

log = logging.getLogger(__name__)

#: The file that marks a stored step as done; Spark passes over such names.
DONE = "_DONE"


class Step(ABC):
    """One transformation. Plans stay lazy: a step only extends the plan."""

    @property
    def spark(self) -> SparkSession:
        return SparkSession.active()

    @abstractmethod
    def run(self, df: DataFrame | None) -> DataFrame: ...

    def settings(self) -> dict:
        """What the result depends on beside the input: the step's attributes, as JSON takes them.

        Steps that hold anything else, a function or a table, say here what stands for it.
        """
        return dict(vars(self))


class Pipeline:
    def __init__(self, steps: Iterable[Step]) -> None:
        self.steps = tuple(steps)

    def run(self, df: DataFrame | None = None) -> DataFrame | None:
        """Thread ``df`` through the steps; a failure is logged and raised."""
        job = SparkSession.active().conf.get("spark.app.name")
        begin = time.perf_counter()
        log.info("%s: start", job)
        try:
            for step in self.steps:
                df = self._apply(step, df)
        except Exception:
            log.exception("%s: failed after %.1f s", job, time.perf_counter() - begin)
            raise
        log.info("%s: done in %.1f s", job, time.perf_counter() - begin)
        return df

    @staticmethod
    def _apply(step: Step, df: DataFrame | None) -> DataFrame:
        label = type(step).__name__
        log.info("%s: start", label)
        result = step.run(df)
        if not isinstance(result, DataFrame):
            raise TypeError(f"{label}.run() must return a DataFrame, not {type(result).__name__}")
        log.info("%s: done", label)
        return result


@dataclass(frozen=True)
class StepRun:
    """One step of a stored run: its rows, its seconds of work, and whether it was found done."""

    name: str
    path: str
    rows: int
    seconds: float
    resumed: bool


class StoredPipeline(Pipeline):
    """A chain whose steps are written as they end, counted, and not done again by a later run.

    A step's folder below ``root`` is named by the step, its settings, those of all steps before it
    and ``source``, which stands for the input: a changed step, or a new ``source``, makes new folders
    for itself and for what follows, and leaves the old ones. A step is done when its count is
    written, after its rows; a run that dies in a step resumes with that step. Only the last step
    that is done is read. Counts are taken by the tasks that write. Lineage ends at every step.
    """

    def __init__(self, steps: Iterable[Step], root: str, source: str) -> None:
        super().__init__(steps)
        self.root, self.source = root, source
        self.runs: list[StepRun] = []

    def paths(self) -> list[str]:
        """The folder of each step."""
        digest, found = hashlib.sha256(self.source.encode()), []
        for place, step in enumerate(self.steps):
            label = type(step).__name__
            kept = json.dumps([type(step).__module__, label, step.settings()], sort_keys=True)
            digest.update(f"{len(kept)}:{kept}".encode())
            found.append(f"{self.root}/{place:03d}-{label.strip('_')}-{digest.hexdigest()[:16]}")
        return found

    def run(self, df: DataFrame | None = None) -> DataFrame | None:
        """The last step's result, read back; ``runs`` tells about every step."""
        spark, paths = SparkSession.active(), self.paths()
        self.runs = []
        done = [self._found(spark, path) for path in paths]
        # Steps before one that is done are not needed, whatever became of their folders.
        last = max((place for place, record in enumerate(done) if record), default=-1)
        for place, (step, path) in enumerate(zip(self.steps, paths, strict=True)):
            label = type(step).__name__
            if place <= last:
                record = done[place]
                if record:
                    self.runs.append(StepRun(label, path, record["rows"], record["seconds"], True))
                    log.info("%s: %d rows, done before", label, record["rows"])
                df = scan_table(spark, path) if place == last else df
                continue
            begin = time.perf_counter()
            try:
                rows = self._store(self._apply(step, df), path)
            except Exception:
                log.exception("%s: failed after %.1f s", label, time.perf_counter() - begin)
                raise
            record = {"rows": rows, "seconds": time.perf_counter() - begin}
            replace_text(spark, f"{path}/{DONE}", json.dumps(record))
            self.runs.append(StepRun(label, path, rows, record["seconds"], False))
            log.info("%s: %d rows in %.1f s", label, rows, record["seconds"])
            df = scan_table(spark, path)
        return df

    @staticmethod
    def _found(spark: SparkSession, path: str) -> dict | None:
        text = read_text(spark, f"{path}/{DONE}")
        return json.loads(text) if text and table_exists(spark, path) else None

    @staticmethod
    def _store(df: DataFrame, path: str) -> int:
        counts = Observation("step")
        df.observe(counts, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
        return counts.get["rows"]

"""The corpus pipeline: five operators over documents, each on what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableworks.llm import decontaminate, pieces, quality_rules, secrets, similar_texts
from tableworks.llm.queries import MODEL_PATH
from tableworks.llm.texts import quoted
from tableworks.session import remove_path, scratch, scratch_path


def by_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    whole = F.struct(*map(quoted, docs.columns)).alias("row")
    slim = docs.select(whole, *[quoted(name).alias(name) for name in ("text", "lang", "source")])
    return quality_rules.quality_rules(slim).where("kept").select("row.*")


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts with a similarity of 0.8 on five-word shingles the one with the smallest id stays."""
    return similar_texts.one_of_similar(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that repeat a benchmark item go."""
    return decontaminate.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; a null count of characters stays null."""
    masked = secrets.redact_secrets(docs)
    if "n_chars" in docs.columns:
        counted = F.when(F.col("n_chars").isNotNull(), F.length("text")).cast(docs.schema["n_chars"].dataType)
        masked = masked.withColumn("n_chars", F.coalesce(counted, F.col("n_chars")))
    return masked.select(*map(quoted, docs.columns))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every text, the scores of its best segmentations, and its source."""
    found = pieces.encode(docs, pieces.broadcast(spark, MODEL_PATH))
    scores = F.transform("nbest", lambda way: way["score"])
    shown = ("doc_id", "lang", "source", "pieces", scores.alias("scores"), "round_trip")
    return found.select(*shown)


STAGES = [
    ("quality_rules", by_quality),
    ("near_copies", one_of_each),
    ("decontaminate", without_benchmark),
    ("secrets", without_secrets),
    ("pieces", encoded),
]

#: Structural checks of secrets and segmentations have no SQL form: tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the shared folder and read again.

    A stage's own intermediate tables go when it is written, and its result when the next is.
    """
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if last is not None:
            remove_path(spark, last)
        last = path
    return docs

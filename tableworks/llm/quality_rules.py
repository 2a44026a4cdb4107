"""Quality rules with adaptive thresholds from mergeable quantile sketches.

A sketch counts the values of one metric in integer buckets of a relative width of 1/32: two
sketches merge by adding counts, in any order and with the same result, so Spark combines them
before the shuffle and again by language and over all. The sketch of a language and source is
merged with that of its language, weighted as ``PRIOR`` documents, and that one likewise with the
sketch of all documents: a large group speaks for itself, a small one leans on what is known around
it, by the same rule at every size. Fences come from the quartiles of the merged sketches; documents
then meet the fences of their own language and source in a join.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableworks.session import stored

from .texts import (
    Packed,
    apart,
    as_bytes,
    byte_set,
    quoted,
    repeated,
    span_hashes,
    window_hashes,
    with_text_columns,
)

COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
SYMBOLS = byte_set(b"#*$%&|<>")
WINDOW = 8

#: Base rules: too few words, and the highest share of repeated words in percent.
MIN_WORDS, MAX_REPEATED = 20, 30
#: Weight, in documents, of the language in a group's sketch and of all documents in a language's.
PRIOR = 50
#: Quartile distances from the quartile to its fence.
REACH = 4
#: Metrics, in thousandths: (name, narrowest quartile distance, fenced below, fenced above).
METRICS = (
    ("symbol_rate", 15, False, True),
    ("word_length", 400, True, True),
    ("dup_line_rate", 60, False, True),
    ("repeat_rate", 60, False, True),
)


def text_counts(texts: pa.Array) -> dict[str, np.ndarray]:
    packed = Packed(as_bytes(texts))
    data, docs, owner = packed.data, len(packed.begin), packed.word_texts()
    lead = ((data & 0xC0) != 0x80) & ~packed.separator

    feeds = np.flatnonzero(data == 10)
    starts, ends = feeds[:-1] + 1, feeds[1:]
    wordy = np.searchsorted(packed.starts, ends) > np.searchsorted(packed.starts, starts)
    starts, ends = starts[wordy], ends[wordy]
    line_owner = np.searchsorted(packed.begin, starts, "right") - 1
    _, later = repeated(apart(span_hashes(data, starts, ends), line_owner))

    windows = window_hashes(packed.word_hashes(), WINDOW)
    inside = owner[: len(windows)] == owner[WINDOW - 1 :] if len(windows) else np.zeros(0, bool)
    at = np.flatnonzero(inside)
    twice, _ = repeated(apart(windows[at], owner[at]))
    cover = np.zeros(len(owner) + 1, np.int64)
    cover[at[twice]] += 1
    np.subtract.at(cover, at[twice] + WINDOW, 1)
    covered = np.cumsum(cover)[:-1] > 0
    return {
        "n_words": np.diff(packed.first),
        "word_chars": packed.counts(lead),
        "n_symbols": packed.counts(SYMBOLS[data]),
        "n_dup_lines": np.bincount(line_owner[later], minlength=docs),
        "n_repeat_words": np.bincount(owner[covered], minlength=docs),
    }


def base_failed() -> Column:
    few = F.col("n_words") < MIN_WORDS
    return few | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))


def _metrics() -> dict[str, Column]:
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    found = (
        F.expr("1000 * n_symbols") / chars,
        F.expr("1000 * word_chars") / words,
        F.expr("8000 * n_dup_lines") / words,
        F.expr("1000 * n_repeat_words") / words,
    )
    return {
        name: F.floor(value).cast("long") for (name, *_), value in zip(METRICS, found, strict=True)
    }


def bucket(value: Column) -> Column:
    """The lower end of a value's bucket: its six leading binary digits."""
    shift = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, shift), shift)


def sketches(counted: DataFrame, lang: str, source: str) -> DataFrame:
    """Counts by bucket for each metric: by language and source, by language, and over all.

    Only rows that pass the base rules are counted.
    """
    cells = counted.where(~base_failed()).select(
        quoted(lang).alias("lang"),
        quoted(source).alias("source"),
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(name).alias("metric"), bucket(value).alias("bucket"))
                    for name, value in _metrics().items()
                ]
            )
        ).alias("cell"),
    )
    own = cells.groupBy("lang", "source", "cell.metric", "cell.bucket").agg(
        F.count(F.lit(1)).alias("n")
    )
    levels = F.array(
        F.struct(F.lit(0).alias("level"), "lang", "source"),
        F.struct(F.lit(1).alias("level"), "lang", F.lit(None).cast("string").alias("source")),
        F.struct(
            F.lit(2).alias("level"),
            F.lit(None).cast("string").alias("lang"),
            F.lit(None).cast("string").alias("source"),
        ),
    )
    each = own.withColumns({"lang": F.col("lang").cast("string"), "source": F.col("source").cast("string")})
    return (
        each.select(F.explode(levels).alias("group"), "metric", "bucket", "n")
        .groupBy("group.level", "group.lang", "group.source", "metric", "bucket")
        .agg(F.sum("n").alias("n"))
    )


def merged(found: DataFrame) -> DataFrame:
    """The sketch of every language and source with its priors merged in, as whole numbers.

    Counts are scaled up to a common denominator rather than divided: nothing is rounded, and the
    result is exact for up to 10^12 documents.
    """

    def level(number: int, name: str, *keys: str) -> DataFrame:
        own = found.where(F.col("level") == number)
        return own.select(
            *[F.col(key).alias(f"{key}_{number}") for key in keys],
            F.col("metric").alias(f"metric_{number}"),
            F.col("bucket").alias(f"bucket_{number}"),
            F.col("n").cast("decimal(38,0)").alias(name),
        )

    def same(number: int, *keys: str) -> Column:
        every = F.lit(True)
        for key in (*keys, "metric", "bucket"):
            every = every & F.col(key).eqNullSafe(F.col(f"{key}_{number}"))
        return every

    def totals(df: DataFrame, name: str, *keys: str) -> DataFrame:
        return df.groupBy(*keys).agg(F.sum(name).alias(f"{name}_total"))

    # Buckets have six leading digits, so there are 32 to each power of two: some thousand rows.
    every = F.broadcast(level(2, "all_n"))
    whole = F.broadcast(totals(level(2, "all_n"), "all_n", "metric_2"))
    languages = totals(level(1, "lang_n", "lang"), "lang_n", "lang_1", "metric_1")
    grid = languages.select(F.col("lang_1").alias("lang"), F.col("metric_1").alias("metric"), "lang_n_total")
    grid = grid.join(every, F.col("metric") == F.col("metric_2")).withColumnRenamed("bucket_2", "bucket").drop("metric_2")
    grid = grid.join(whole, F.col("metric") == F.col("metric_2")).drop("metric_2")
    grid = grid.join(level(1, "lang_n", "lang"), same(1, "lang"), "left")
    own = F.coalesce("lang_n", F.lit(0)).cast("decimal(38,0)")
    lang = grid.select(
        F.col("lang").alias("lang_3"),
        F.col("metric").alias("metric_3"),
        "bucket",
        (own * F.col("all_n_total") + PRIOR * F.col("all_n")).cast("decimal(38,0)").alias("lang_c"),
        ((F.col("lang_n_total") + PRIOR) * F.col("all_n_total")).cast("decimal(38,0)").alias("lang_c_total"),
    )
    groups = level(0, "n", "lang", "source").select(
        F.col("lang_0").alias("lang"), F.col("source_0").alias("source"), F.col("metric_0").alias("metric")
    )
    grid = groups.distinct().join(
        lang, F.col("lang").eqNullSafe(F.col("lang_3")) & (F.col("metric") == F.col("metric_3"))
    )
    grid = grid.join(level(0, "n", "lang", "source"), same(0, "lang", "source"), "left")
    own = F.coalesce("n", F.lit(0)).cast("decimal(38,0)")
    count = (own * F.col("lang_c_total") + PRIOR * F.col("lang_c")).cast("decimal(38,0)")
    return grid.select("lang", "source", "metric", "bucket", count.alias("n"))


def fences(found: DataFrame) -> DataFrame:
    """One row per language and source: a low and a high fence for every metric."""
    group = ["lang", "source", "metric"]
    whole = Window.partitionBy(*group)
    up = whole.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    ranked = merged(found).withColumns({"upto": F.sum("n").over(up), "total": F.sum("n").over(whole)})

    def quartile(k: int) -> Column:
        return F.min(F.when(4 * F.col("upto") >= k * F.col("total"), F.col("bucket")))

    by_metric = ranked.groupBy(*group).agg(quartile(1).alias("q1"), quartile(3).alias("q3"))
    ends = []
    for name, width, below, above in METRICS:
        step = REACH * F.greatest(F.col("q3") - F.col("q1"), F.lit(width))
        here = F.col("metric") == name
        low = F.col("q1") - step if below else F.lit(None).cast("long")
        high = F.col("q3") + step if above else F.lit(None).cast("long")
        ends += [F.max(F.when(here, low)).alias(f"{name}_low")]
        ends += [F.max(F.when(here, high)).alias(f"{name}_high")]
    return by_metric.groupBy("lang", "source").agg(*ends)


def quality_rules(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source"
) -> DataFrame:
    """``docs`` with the five counts, ``base_failed`` and ``kept``.

    Null texts count as empty and fail for want of words; null languages and sources form groups
    of their own. Columns of the same names as the new ones give way. Repeated rows count as
    often as they occur. Without any document that passes the base rules there is no fence.

    The counts are made twice, once for the sketches and once beside the rows, rather than
    shuffled or stored with the texts. The fences are stored first: Spark then knows their true
    size, broadcasts them only below the session's threshold and merges otherwise.
    """
    counted = with_text_columns(docs, text, text_counts, COUNTS)
    # The sketches are stored, too: merging reads them several times.
    found = stored(fences(stored(sketches(counted, lang, source), "sketches")), "fences")
    ends = [f"{name}_{end}" for name, *_ in METRICS for end in ("low", "high")]
    taken = {name.lower() for name in counted.columns}
    lang_key, source_key, fence = "_lang", "_source", "_fence"
    while taken & {lang_key, source_key, fence}:
        lang_key, source_key, fence = f"{lang_key}_", f"{source_key}_", f"{fence}_"
    own = found.select(
        F.col("lang").alias(lang_key), F.col("source").alias(source_key), F.struct(*ends).alias(fence)
    )
    met = quoted(lang).cast("string").eqNullSafe(F.col(lang_key))
    met &= quoted(source).cast("string").eqNullSafe(F.col(source_key))
    outside = F.lit(False)
    for name, value in _metrics().items():
        for end, beyond in (("low", value < F.col(fence)[f"{name}_low"]), ("high", value > F.col(fence)[f"{name}_high"])):
            outside = outside | F.coalesce(beyond, F.lit(False))
    kept = [quoted(name) for name in counted.columns if name.lower() not in ("base_failed", "kept")]
    return counted.join(own, met, "left").select(
        *kept, base_failed().alias("base_failed"), (~base_failed() & ~outside).alias("kept")
    )

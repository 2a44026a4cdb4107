"""Registered queries of the pipeline operators, over the driver's tables, and their SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chats, decontaminate, fill_in_middle, hard_negatives, language, licenses
from . import near_copies as copies
from . import personal_data, pieces, quality_model
from . import quality_rules as rules
from . import secrets, url_filters
from .shared import training_row

#: A public vocabulary file; the operators take its path as a parameter.
MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    fixed = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(fixed).alias("text"),
    )
    turns = said.unionByName(extra).withColumn("parts", chats.text_parts(F.col("text")))
    return chats.read_back(chats.format_turns(turns.drop("text")))


def _op1_sql() -> str:
    return rf"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), marked AS (
  SELECT *, length(text) + length(text) - length(replace(text, chr(92), ''))
    + len(regexp_extract_all(text, '{chats.PATTERN}')) AS escaped
  FROM said
), whole AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS every,
    coalesce(string_agg(text, '' ORDER BY turn, role, text)
      FILTER (WHERE role = 'assistant'), '') AS loss,
    sum(escaped + length(role) + length('[TURN][TEXT][/TURN]')) AS formatted_chars
  FROM marked GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(every) AS turns_sha256,
  CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256,
  CAST(formatted_chars AS BIGINT) AS formatted_chars,
  CAST(0 AS BIGINT) AS n_attachments, CAST(0 AS BIGINT) AS expanded_tokens
FROM whole
"""


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    profiles = language.learn(documents.where(training_row(F.col("doc_id"))))
    found = language.identify(documents.select("doc_id", "text"), profiles)
    held_out = ~training_row(F.col("doc_id"))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = table(spark, sf_dir, "documents").select("doc_id", "text")
    return personal_data.find_personal_data(texts).drop("text")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = (table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return decontaminate.contaminated(documents, benchmark)


def op5_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    learnable = training_row(F.col("doc_id"))
    network = quality_model.fit(documents, labels.where(learnable))
    scored = quality_model.score(documents, network)
    return scored.select("doc_id", (~learnable).alias("held_out"), "score", "predicted")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.quality_rules(table(spark, sf_dir, "documents"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select("doc_id", *counts, "base_failed", "kept")


def _op6_sql() -> str:
    metrics = (
        "1000 * n_symbols // greatest(word_chars, 1)",
        "1000 * word_chars // greatest(n_words, 1)",
        "8000 * n_dup_lines // greatest(n_words, 1)",
        "1000 * n_repeat_words // greatest(n_words, 1)",
    )
    values = ", ".join(
        f"{sql} AS {name}" for (name, *_), sql in zip(rules.METRICS, metrics, strict=True)
    )
    cells = " UNION ALL ".join(
        f"SELECT lang, source, '{name}' AS metric, {name} AS v FROM m WHERE NOT base_failed"
        for name, *_ in rules.METRICS
    )
    ends, tests = [], []
    for name, width, below, above in rules.METRICS:
        reach = f"{rules.REACH} * greatest(q3 - q1, {width})"
        for end, edge, sign, used in (("low", "q1 -", "<", below), ("high", "q3 +", ">", above)):
            if used:
                ends.append(
                    f"max(CASE WHEN metric = '{name}' THEN {edge} {reach} END) AS {name}_{end}"
                )
                tests.append(f"coalesce({name} {sign} f.{name}_{end}, false)")
    return rf"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS text
  FROM documents
), w AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM t
), win AS (
  SELECT r, i, array_to_string(w[i:i + 7], ' ') AS s
  FROM w, unnest(range(1, len(w) - 6)) AS u(i)
), dup AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS c FROM win) WHERE c > 1
), cov AS (
  SELECT r, count(DISTINCT p) AS n FROM dup, unnest(range(i, i + 8)) AS u(p) GROUP BY r
), lines AS (
  SELECT r, l FROM t, unnest(string_split(text, chr(10))) AS u(l)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]')
), dl AS (
  SELECT r, count(*) - count(DISTINCT l) AS n FROM lines GROUP BY r
), c AS (
  SELECT r, doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(dl.n, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN dl USING (r) LEFT JOIN cov USING (r)
), m AS (
  SELECT *, {values},
    n_words < {rules.MIN_WORDS}
      OR 100 * n_repeat_words > {rules.MAX_REPEATED} * n_words AS base_failed
  FROM c
), cells AS ({cells}
), b AS (
  SELECT lang, source, metric,
    (v >> greatest(length(bin(v)) - 6, 0)) << greatest(length(bin(v)) - 6, 0) AS bucket
  FROM cells
), s AS (
  SELECT 0 AS level, lang, source, metric, bucket, count(*) AS n FROM b GROUP BY ALL
  UNION ALL SELECT 1, lang, NULL, metric, bucket, count(*) FROM b GROUP BY ALL
  UNION ALL SELECT 2, NULL, NULL, metric, bucket, count(*) FROM b GROUP BY ALL
), t2 AS (SELECT metric, CAST(sum(n) AS HUGEINT) AS total FROM s WHERE level = 2 GROUP BY ALL
), t1 AS (SELECT lang, metric, CAST(sum(n) AS HUGEINT) AS total FROM s WHERE level = 1 GROUP BY ALL
), l AS (
  SELECT t1.lang, t1.metric, a.bucket,
    coalesce(o.n, 0) * t2.total + {rules.PRIOR} * CAST(a.n AS HUGEINT) AS c,
    (t1.total + {rules.PRIOR}) * t2.total AS total
  FROM t1 JOIN t2 ON t1.metric = t2.metric JOIN s a ON a.level = 2 AND a.metric = t1.metric
  LEFT JOIN s o ON o.level = 1 AND o.metric = t1.metric AND o.bucket = a.bucket
    AND o.lang IS NOT DISTINCT FROM t1.lang
), mixed AS (
  SELECT g.lang, g.source, g.metric, l.bucket, coalesce(o.n, 0) * l.total + {rules.PRIOR} * l.c AS n
  FROM (SELECT DISTINCT lang, source, metric FROM s WHERE level = 0) g
  JOIN l ON l.metric = g.metric AND l.lang IS NOT DISTINCT FROM g.lang
  LEFT JOIN s o ON o.level = 0 AND o.metric = g.metric AND o.bucket = l.bucket
    AND o.lang IS NOT DISTINCT FROM g.lang AND o.source IS NOT DISTINCT FROM g.source
), p AS (
  SELECT *, sum(n) OVER (PARTITION BY lang, source, metric ORDER BY bucket) AS upto,
    sum(n) OVER (PARTITION BY lang, source, metric) AS total
  FROM mixed
), q AS (
  SELECT lang, source, metric,
    min(bucket) FILTER (WHERE 4 * upto >= total) AS q1,
    min(bucket) FILTER (WHERE 4 * upto >= 3 * total) AS q3
  FROM p GROUP BY ALL
), f AS (SELECT lang, source, {", ".join(ends)} FROM q GROUP BY ALL)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT ({" OR ".join(tests)}) AS kept
FROM m
LEFT JOIN f ON m.lang IS NOT DISTINCT FROM f.lang AND m.source IS NOT DISTINCT FROM f.source
"""


#: Fixed rules of the query.
RULES = [
    url_filters.Rule("block", "net"),
    url_filters.Rule("allow", "example.net", "/en/"),
    url_filters.Rule("block", "example.com", "/de/"),
    url_filters.Rule("allow", "org", "/fr/"),
]


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = url_filters.judge_urls(pages, RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "score")


def op8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = pieces.encode(texts, pieces.broadcast(spark, MODEL_PATH))
    return encoded.select(
        "doc_id",
        F.size("pieces").cast("long").alias("n_pieces"),
        F.xxhash64("pieces").alias("pieces_hash"),
        "nbest",
        "round_trip",
    )


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets.find_secrets(texts).drop("text")


def op10_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return copies.near_copies(table(spark, sf_dir, "documents"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = fill_in_middle.fill_in_middle(texts)
    back = fill_in_middle.restored(F.col("output"), F.col("form"))
    return cut.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(back, 256).alias("restored_sha256"),
    )


OP11_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text,
    sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
), u AS (
  SELECT doc_id, text, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS l,
    [CAST('0x' || substr(h, 8 * k + 1, 8) AS BIGINT) FOR k IN range(4)] AS d
  FROM t
), c AS (
  SELECT *, least(d[1] % (len(l) + 1), d[2] % (len(l) + 1)) AS a,
    greatest(d[1] % (len(l) + 1), d[2] % (len(l) + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
      OR d[3] % 100 >= 100 THEN 'plain' WHEN d[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM u
), p AS (
  SELECT doc_id, len(l) AS n, form, text, array_to_string(l[1:a], '') AS prefix,
    array_to_string(l[a + 1:b], '') AS middle, array_to_string(l[b + 1:], '') AS suffix
  FROM c
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text
    WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
    ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p
"""


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10)
    rows = vectors.select(
        "vec_id",
        F.coalesce(moved, F.col("label")).alias("label"),
        hard_negatives.quantized(vectors).alias("components"),
    )
    return hard_negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0)


OP12_SQL = """
WITH e AS (
  SELECT row_number() OVER () AS r, vec_id,
    CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT a.r, a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
    CAST(coalesce(list_sum([a.v[i] * b.v[i] FOR i IN range(1, least(len(a.v), len(b.v)) + 1)]), 0)
      AS BIGINT) AS score
  FROM e a, e b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), p AS (
  SELECT r, anchor_id, other_id AS positive_id, score AS positive_score,
    row_number() OVER (PARTITION BY r ORDER BY score DESC, other_id) AS k
  FROM s WHERE same QUALIFY k <= 5
), n AS (
  SELECT anchor_id, positive_id, positive_score, other_id AS negative_id, score AS negative_score,
    row_number() OVER (PARTITION BY r, k ORDER BY score DESC, other_id) AS rank
  FROM p JOIN s USING (r, anchor_id)
  WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score,
  negative_score
FROM n WHERE rank <= 10
"""


def op13_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = licenses.find_licenses(texts)
    first = F.transform("phrases", lambda place: place["first"])
    return found.select(
        "doc_id",
        "n_words",
        F.size("phrases").cast("long").alias("n_base"),
        F.array_min(first).alias("first_word"),
        F.array_max(first).alias("last_word"),
        licenses.joined_labels(F.col("phrases")).alias("base_labels"),
        licenses.joined_labels(F.col("phrases"), F.col("licenses")).alias("labels"),
        "score",
    )


def _license_pattern(markup: str) -> str:
    """A template as a pattern over words that each have one blank after them."""
    pattern, at = "", 0
    tags = re.compile(r"<<(beginOptional|endOptional|var;words=(\d+)-(\d+))>>")
    for tag in [*tags.finditer(markup), None]:
        words = re.findall("[a-z0-9]+", markup[at : tag.start() if tag else None].lower())
        pattern += "".join(f"{word} " for word in words)
        if tag:
            at = tag.end()
            plain = {"beginOptional": "(?:", "endOptional": ")?"}
            pattern += plain.get(tag[1]) or f"(?:[^ ]+ ){{{tag[2]},{tag[3]}}}"
    return pattern


def _op13_sql() -> str:
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    places, found, sizes = [], [], []
    for phrase in licenses.PHRASES:
        words = phrase.markup.lower().split()
        test = " AND ".join(f"w[x + {k}] = '{word}'" for k, word in enumerate(words))
        here = f"[x - 1 FOR x IN range(1, len(w) - {len(words) - 2}) IF {test}]"
        places.append(f"{here} AS p{len(places)}")
        found.append(f"CASE WHEN len(p{len(found)}) > 0 THEN '{phrase.label}' END")
        sizes.append(f"CASE WHEN len(p{len(sizes)}) > 0 THEN {len(words)} ELSE 0 END")
    base = ", ".join(found)
    for template in licenses.TEMPLATES:
        test = f"regexp_matches(s, ' {_license_pattern(template.markup)}')"
        outside = re.sub("<<beginOptional>>.*?<<endOptional>>|<<var[^>]*>>", " ", template.markup, flags=re.S)
        found.append(f"CASE WHEN {test} THEN '{template.label}' END")
        sizes.append(f"CASE WHEN {test} THEN {len(re.findall('[A-Za-z0-9]+', outside))} ELSE 0 END")
    every = " || ".join(f"p{k}" for k in range(len(places)))

    def joined(labels: str) -> str:
        return f"array_to_string(list_sort(list_distinct([x FOR x IN [{labels}] IF x IS NOT NULL])), ',')"

    return rf"""
WITH t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{letters}', '{letters.lower()}'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), p AS (
  SELECT doc_id, w, ' ' || array_to_string(w, ' ') || ' ' AS s, {", ".join(places)} FROM t
), m AS (
  SELECT doc_id, len(w) AS n, {every} AS places, {joined(base)} AS base_labels,
    {joined(", ".join(found))} AS labels, greatest({", ".join(sizes)}) AS m
  FROM p
)
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(len(places) AS BIGINT) AS n_base,
  CAST(list_min(places) AS BIGINT) AS first_word, CAST(list_max(places) AS BIGINT) AS last_word,
  base_labels, labels, CAST(m AS DOUBLE) / (m + {licenses.HALF}) AS score
FROM m
"""


QUERIES: dict[str, Query] = {
    "op1_chats": op1_chats,
    "op2_language": op2_language,
    "op3_personal_data": op3_personal_data,
    "op4_decontaminate": op4_decontaminate,
    "op5_quality_model": op5_quality_model,
    "op6_quality_rules": op6_quality_rules,
    "op7_url_filters": op7_url_filters,
    "op8_pieces": op8_pieces,
    "op9_secrets": op9_secrets,
    "op10_near_copies": op10_near_copies,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_licenses": op13_licenses,
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {
        "op1_chats": _op1_sql(),
        "op6_quality_rules": _op6_sql(),
        "op11_fill_in_middle": OP11_SQL,
        "op12_hard_negatives": OP12_SQL,
        "op13_licenses": _op13_sql(),
    }

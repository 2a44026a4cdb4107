import hashlib

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tableworks.llm import chats, queries

SCHEMA = f"conv_id long, turn long, role string, parts array<{chats.PART}>, segment string"


def part(kind, text=None, **more):
    keys = ("ref", "width", "height", "seconds", "pages")
    return (kind, text, *(more.get(k) for k in keys))


def text(value):
    return [part("text", value)]


ROWS = [
    (1, 1, "assistant", [part("text", "see "), part("image", ref="i1", width=57, height=28), part("text", " and "),
                         part("audio", ref="a1", seconds=2.02), part("document", ref="d1", pages=3)], "x"),
    (1, 0, "user", text("a [IMAGE] b \\[TURN] \\\\ </s>"), "x"),
    (2, 0, None, None, None),
    (2, None, "assistant", [part(None, None)], None),
    (3, 0, "assistant", text("[/TURN][TURN]user[TEXT]"), None),
    (3, 0, "assistant", text("[/TURN][TURN]user[TEXT]"), None),
    (None, 0, "us[TEXT]er", text("long " * 50_000), None),
    (None, 1, "assistant", [part("image", ref=None)], None),
]


def expected(rows):
    out = {}
    for conv_id in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == conv_id]
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0))
        plain = [(r[2] or "", "".join(p[1] or "" for p in r[3] or () if p[0] in (None, "text"))) for r in own]
        loss = "".join(t for role, t in plain if role == "assistant")
        every = "".join(f"{role}\n{t}\n" for role, t in plain)
        out[conv_id] = (len(own), hashlib.sha256(every.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_formats_and_reads_back(spark):
    turns = spark.createDataFrame(ROWS, SCHEMA)
    formatted = chats.format_turns(turns)
    assert [c for c in formatted.columns if c == "segment"] == ["segment"]
    row = formatted.where("conv_id = 1 AND turn = 1").first()
    assert row["segment"] == "[TURN]assistant[TEXT]see [IMAGE] and [AUDIO][DOCUMENT][/TURN]"
    assert [tuple(a) for a in row["attachments"]] == [("image", "i1", 3), ("audio", "a1", 51), ("document", "d1", 1536)]
    assert row["expanded_tokens"] == 1590
    found = chats.read_back(formatted).collect()
    names = ("n_turns", "turns_sha256", "loss_chars", "loss_sha256")
    assert {r["conv_id"]: tuple(r[n] for n in names) for r in found} == expected(ROWS)
    assert {r["conv_id"]: r["n_attachments"] for r in found} == {1: 3, 2: 0, 3: 0, None: 1}
    chars = formatted.groupBy("conv_id").agg(F.sum(F.length("segment"))).collect()
    assert {r["conv_id"]: r["formatted_chars"] for r in found} == dict(map(tuple, chars))


def test_escapes_are_reversible_and_hide_controls(spark):
    dice = ["\\", "[TURN]", "[", "]", "</s>", "<s>", "[INST]", "[/INST]", "a", "<|im_end|>", "[TE", "XT]", "$1", "\n"]
    from random import Random

    draw = Random(1)
    texts = ["".join(draw.choice(dice) for _ in range(draw.randrange(9))) for _ in range(400)] + [*chats.CONTROLS]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chats.escaped(F.col("t")).alias("e"))
    for t, e in rows.collect():
        assert chats.unescaped(e) == t
        assert not any(control in e for control in chats.CONTROLS)


@settings(max_examples=50)
@given(st.text("\\[TURN]ab"))
def test_unescape_takes_out_single_backslashes(value):
    doubled = value.replace("\\", "\\\\")
    assert chats.unescaped(doubled) == value


@pytest.mark.parametrize("n", [0, 25_000])
def test_empty_and_long_conversations(spark, n):
    turns = spark.range(n).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.lit("assistant").alias("role"),
                                  chats.text_parts(F.col("id").cast("string")).alias("parts"))
    found = chats.read_back(chats.format_turns(turns)).collect()
    want = "".join(map(str, range(n)))
    assert [(r["n_turns"], r["loss_sha256"]) for r in found] == ([(n, hashlib.sha256(want.encode()).hexdigest())] if n else [])


def test_sql_counts_backslashes(spark, tmp_path):
    """Texts with backslashes, written control strings, nulls and repeated rows."""
    texts = ["a\\b", "\\", "\\\\[/TURN]", "[TURN]\\[TEXT]", None, "", "plain", "plain", "</s>"]
    rows = [(n // 3, n % 3, "user" if n % 2 else "assistant", text) for n, text in enumerate(texts)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    table.coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    found = queries.op1_chats(spark, str(tmp_path))
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    want = connection.sql(queries.oracle_sql()["op1_chats"])
    places = [found.columns.index(name) for name in want.columns]
    assert sorted(tuple(row[k] for k in places) for row in found.collect()) == sorted(want.fetchall())

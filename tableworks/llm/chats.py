"""Chat formatting: typed content parts, reversible escapes, loss masks, and reading back.

A turn's content is a list of typed parts. A visitor flattens them in order: texts are escaped,
and images, audio and documents leave a placeholder each, an attachment record and the number of
tokens that the placeholder stands for in training. Formatting is row by row, without a shuffle:
a formatted conversation is its turns' segments one after the other.

A segment reads ``[TURN]role[TEXT]body[/TURN]``. Inside texts a backslash is doubled, and a single
backslash after the first character breaks every control string; taking it out again gives the
text back exactly. Control strings hold brackets only at their ends, so none can arise where a
mark and a text meet.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .texts import quoted

#: Strings that mean something to this template or to common other ones.
CONTROLS = (
    "[TURN]", "[TEXT]", "[/TURN]", "[IMAGE]", "[AUDIO]", "[DOCUMENT]",
    "[INST]", "[/INST]", "<s>", "</s>", "<|im_start|>", "<|im_end|>", "<|endoftext|>",
)
PATTERN = "|".join(re.sub(r"([\[\]|/])", r"\\\1", c) for c in CONTROLS)
SPLIT = re.compile(r"\[TURN\](.*?)\[TEXT\](.*?)\[/TURN\]", re.S)
PLACEHOLDER = re.compile(r"\[(?:IMAGE|AUDIO|DOCUMENT)\]")

PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
ATTACHMENT = "struct<kind:string,ref:string,tokens:long>"


def escaped(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, f"(?=(?:{PATTERN}))(.)", "$1\\\\")


def unescaped(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


class PartVisitor:
    """What each kind of part becomes: a piece of the body, and the tokens it stands for.

    ``patch`` is the side of the square of pixels that one token shows, ``rate`` the tokens for a
    second of audio, ``page`` the tokens for a page of a document.
    """

    def __init__(self, patch: int = 28, rate: float = 25.0, page: int = 512):
        self.patch, self.rate, self.page = patch, rate, page

    def text(self, part: Column) -> tuple[Column, Column]:
        return escaped(F.coalesce(part["text"], F.lit(""))), F.lit(0).cast("long")

    def image(self, part: Column) -> tuple[Column, Column]:
        side = [F.ceil(F.coalesce(part[k], F.lit(0)) / self.patch) for k in ("width", "height")]
        return F.lit("[IMAGE]"), F.greatest(side[0] * side[1], F.lit(1)).cast("long")

    def audio(self, part: Column) -> tuple[Column, Column]:
        tokens = F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * self.rate)
        return F.lit("[AUDIO]"), F.greatest(tokens, F.lit(1)).cast("long")

    def document(self, part: Column) -> tuple[Column, Column]:
        tokens = F.coalesce(part["pages"], F.lit(0)) * self.page
        return F.lit("[DOCUMENT]"), F.greatest(tokens, F.lit(1)).cast("long")

    def visit(self, part: Column) -> tuple[Column, Column]:
        """Unknown and null kinds count as text."""
        body, tokens = self.text(part)
        for kind in ("image", "audio", "document"):
            own_body, own_tokens = getattr(self, kind)(part)
            here = F.coalesce(part["kind"] == kind, F.lit(False))
            body = F.when(here, own_body).otherwise(body)
            tokens = F.when(here, own_tokens).otherwise(tokens)
        return body, tokens


def text_parts(text: Column) -> Column:
    """A plain text as a list of one part."""
    return F.array(
        F.struct(
            F.lit("text").alias("kind"), text.cast("string").alias("text"), F.lit(None).cast("string").alias("ref"),
            F.lit(None).cast("int").alias("width"), F.lit(None).cast("int").alias("height"),
            F.lit(None).cast("double").alias("seconds"), F.lit(None).cast("int").alias("pages"),
        )
    ).cast(f"array<{PART}>")


def format_turns(
    turns: DataFrame,
    parts: str = "parts",
    role: str = "role",
    loss_role: str = "assistant",
    visitor: PartVisitor | None = None,
) -> DataFrame:
    """``turns`` with ``segment``, ``has_loss``, ``attachments`` and ``expanded_tokens``.

    ``parts`` is an array of ``PART``. A null list is an empty turn, null parts are empty texts,
    a null role is the empty role. ``attachments`` are in the order of their placeholders.
    Columns with the new names give way.
    """
    visitor = visitor or PartVisitor()
    found = F.coalesce(quoted(parts), F.array().cast(f"array<{PART}>"))
    name = F.coalesce(quoted(role).cast("string"), F.lit(""))
    body = F.array_join(F.transform(found, lambda part: visitor.visit(part)[0]), "")
    kept = F.filter(found, lambda part: part["kind"].isin("image", "audio", "document"))
    attached = F.transform(
        kept,
        lambda part: F.struct(
            part["kind"].alias("kind"), part["ref"].alias("ref"), visitor.visit(part)[1].alias("tokens")
        ),
    )
    new = {
        "segment": F.concat(F.lit("[TURN]"), escaped(name), F.lit("[TEXT]"), body, F.lit("[/TURN]")),
        "has_loss": name == loss_role,
        "attachments": attached.cast(f"array<{ATTACHMENT}>"),
        "expanded_tokens": F.aggregate(attached, F.lit(0).cast("long"), lambda a, x: a + x["tokens"]),
    }
    others = [quoted(c) for c in turns.columns if c.lower() not in new]
    return turns.select(*others, *[column.alias(name) for name, column in new.items()])


CHECKED = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long, n_attachments long, expanded_tokens long"
)


class _Reader:
    """One conversation, read segment by segment; nothing is kept but digests and counts."""

    def __init__(self, conv_id):
        self.conv_id, self.turns, self.loss, self.chars = conv_id, 0, 0, 0
        self.attached = self.tokens = 0
        self.all_text, self.loss_text = hashlib.sha256(), hashlib.sha256()

    def read(self, segment: str, has_loss: bool, tokens: int) -> None:
        for found in SPLIT.finditer(segment):
            role, body = unescaped(found[1]), found[2]
            self.attached += len(PLACEHOLDER.findall(body))
            text = unescaped(PLACEHOLDER.sub("", body))
            self.turns += 1
            self.all_text.update(f"{role}\n{text}\n".encode())
            if has_loss:
                self.loss += len(text)
                self.loss_text.update(text.encode())
        self.chars += len(segment)
        self.tokens += tokens

    def row(self) -> tuple:
        digests = self.all_text.hexdigest(), self.loss_text.hexdigest()
        return (
            self.conv_id, self.turns, digests[0], self.loss, digests[1], self.chars,
            self.attached, self.tokens,
        )


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [field.split()[0] for field in CHECKED.split(", ")]
    reader, done = None, []

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(names, zip(*rows, strict=True), strict=True)
        kinds = [pa.string() if name.endswith("sha256") else pa.int64() for name in names]
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), k) for (_, c), k in zip(columns, kinds, strict=True)], names
        )

    for found in batches:
        for conv_id, segment, has_loss, tokens in zip(*(c.to_pylist() for c in found.columns), strict=True):
            if reader is None or reader.conv_id != conv_id:
                done += [reader.row()] if reader else []
                reader = _Reader(conv_id)
            reader.read(segment, has_loss, tokens)
        if done:
            yield batch(done)
            done = []
    if reader:
        yield batch([reader.row()])


def read_back(
    formatted: DataFrame, conv_id: str = "conv_id", turn: str = "turn"
) -> DataFrame:
    """What the segments hold, by conversation: counts and digests of texts and loss texts.

    Turns follow each other by ``turn``, nulls first, and rows of the same turn by segment;
    repeated rows count as often as they occur. Rows with a null id are one conversation. A
    SHA-256 digest can only be taken in order, so one task reads a conversation, whatever its
    length; it streams, and keeps no more than one batch of turns.
    """
    ids = quoted(conv_id).cast("long").alias("conv_id"), quoted(turn).alias("turn")
    rows = formatted.select(*ids, "segment", "has_loss", "expanded_tokens")
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "segment")
    return dealt.select("conv_id", "segment", "has_loss", "expanded_tokens").mapInArrow(_read, CHECKED)

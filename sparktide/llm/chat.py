"""Conversations as token streams that are assembled from separately encoded segments.

A turn is ``<|im_start|>`` role ``<|im_sep|>`` text ``<|im_end|>``. The three control
strings are reserved ids behind the vocabulary and only ever spliced in: role and
text are encoded on their own, as ordinary text, so no content can make one.

In the text form of the output, content can't be taken for a control string either:
a backslash is put in front of the bar of every ``<|``, ``<\\|``, ``<\\\\|`` ... in it, and
taking one away again gives the content back.

Where a turn starts in its conversation, and which tokens count for the loss (the
assistant's text, without the marks around it), come from prefix sums of token
counts over the turns. The output has a row per turn, so that a conversation of any
length is written and read as a stream.

Defined results: null roles and texts are empty, rows without a conversation id form
one, null turns come first, equal turns go by their tokens, repeated rows are turns
of their own, an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparktide.llm.bpe import Vocabulary, read_vocabulary, vocabulary
from sparktide.llm.common import map_batches, ordered, text_of
from sparktide.workspace import materialise

# Fixed: the control strings of the template.
CONTROL = ("<|im_start|>", "<|im_sep|>", "<|im_end|>")
LEARNT = "assistant"

_ESCAPED = re.compile(r"<\\(\\*)\|")


def escaped(column: Column) -> Column:
    return F.regexp_replace(column, r"<(\\*+)\|", r"<$1\\|")


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def reserved(v: Vocabulary) -> list[int]:
    """The ids of ``CONTROL``: the first three behind the vocabulary."""
    first = max(v.bytes_of) + 1
    return [first, first + 1, first + 2]


def assemble(df: DataFrame, vocabulary_path: str, conv_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """One row per turn: conv, position, token_start, ids, loss_from, loss_to.

    ``ids`` are packed as little-endian unsigned 32-bit integers. ``token_start`` and
    the loss range count tokens from the start of the conversation; the range is
    empty for turns that aren't learnt.
    """
    shared = df.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path))
    rows = df.select(
        ordered(F.col(conv_col).cast("long")).alias("conv"),
        F.col(turn_col).cast("long").alias("turn"),
        (text_of("role") == LEARNT).alias("learnt"),
        escaped(text_of("role")).alias("role"),
        escaped(text_of("text")).alias("text"),
    )

    def make():
        v = vocabulary(shared.value)
        start, sep, end = (struct.pack("<I", i) for i in reserved(v))

        def step(batch: pa.RecordBatch) -> dict:
            made = {"ids": [], "n_role": [], "n_text": []}
            for role, text in zip(batch.column("role"), batch.column("text"), strict=True):
                a, b = v.plain(role.as_py()), v.plain(text.as_py())
                made["ids"].append(b"".join((start, a, sep, b, end)))
                made["n_role"].append(len(a) // 4)
                made["n_text"].append(len(b) // 4)
            return made | {c: batch.column(c) for c in ("conv", "turn", "learnt")}

        return step

    schema = T.StructType(
        [T.StructField(n, k()) for n, k in (("conv", T.LongType), ("turn", T.LongType), ("learnt", T.BooleanType))]
        + [T.StructField("ids", T.BinaryType()), T.StructField("n_role", T.LongType()), T.StructField("n_text", T.LongType())]
    )
    encoded = map_batches(rows, make, schema)
    in_order = Window.partitionBy("conv").orderBy("turn", "ids")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    n_tokens = F.col("n_role") + F.col("n_text") + len(CONTROL)
    text_from = F.col("token_start") + 2 + F.col("n_role")
    placed = encoded.withColumns(
        {"position": F.row_number().over(in_order), "token_start": F.coalesce(F.sum(n_tokens).over(before), F.lit(0))}
    )
    return placed.select(
        "conv",
        "position",
        "token_start",
        "ids",
        text_from.alias("loss_from"),
        (text_from + F.when(F.col("learnt"), F.col("n_text")).otherwise(0)).alias("loss_to"),
    )


def loss_mask(ids: bytes, token_start: int, loss_from: int, loss_to: int) -> np.ndarray:
    """One byte per token of a turn: 1 where it counts for the loss."""
    mask = np.zeros(len(ids) // 4, np.uint8)
    mask[loss_from - token_start : loss_to - token_start] = 1
    return mask


def read_turns(output: DataFrame, vocabulary_path: str) -> DataFrame:
    """The turns of assembled rows: conv, position, role, text, loss_text, formatted_chars."""
    shared = output.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path))

    def make():
        v = vocabulary(shared.value)
        start, sep, end = reserved(v)

        def step(batch: pa.RecordBatch) -> dict:
            made = {n: [] for n in ("role", "text", "loss_text", "formatted_chars")}
            spans = zip(*(batch.column(c).to_pylist() for c in ("token_start", "loss_from", "loss_to")), strict=True)
            for raw, (at, first, last) in zip(batch.column("ids"), spans, strict=True):
                raw = raw.as_py()
                ids = np.frombuffer(raw, "<u4")
                cut = int((ids == sep).argmax())
                if ids[0] != start or ids[-1] != end or ids[cut] != sep or np.isin(ids, (start, sep, end)).sum() != 3:
                    raise ValueError("a turn isn't framed by its control ids")
                role, text = v.decode(raw[4 : 4 * cut]), v.decode(raw[4 * cut + 4 : -4])
                masked = ids[loss_mask(raw, at, first, last) == 1]
                made["role"].append(unescaped(role))
                made["text"].append(unescaped(text))
                made["loss_text"].append(unescaped(v.decode(masked.tobytes())))
                made["formatted_chars"].append(len(role) + len(text) + sum(map(len, CONTROL)))
            return made | {c: batch.column(c) for c in ("conv", "position")}

        return step

    schema = T.StructType(
        [
            T.StructField("conv", T.LongType()),
            T.StructField("position", T.IntegerType()),
            *(T.StructField(n, T.StringType()) for n in ("role", "text", "loss_text")),
            T.StructField("formatted_chars", T.LongType()),
        ]
    )
    return map_batches(output, make, schema)


class _Digest:
    """Running digests of one conversation."""

    def __init__(self, conv: int):
        self.conv, self.turns, self.loss_chars, self.formatted = conv, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, role: str, text: str, loss: str, chars: int) -> None:
        self.turns += 1
        self.all.update(f"{role}\n{text}\n".encode())
        self.loss.update(loss.encode())
        self.loss_chars += len(loss)
        self.formatted += chars

    def row(self) -> tuple:
        return self.conv, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.formatted


DIGESTS = "conv long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digests(turns: DataFrame) -> DataFrame:
    """Counts and digests per conversation; turns go by as a stream, in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [(n, pa.string() if kind == "string" else pa.int64()) for n, kind in (c.split(" ") for c in DIGESTS.split(", "))]
        )

        def packed(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

        now = None
        for batch in batches:
            done = []
            columns = [batch.column(c).to_pylist() for c in ("conv", "role", "text", "loss_text", "formatted_chars")]
            for conv, *turn in zip(*columns, strict=True):
                if now is None or now.conv != conv:
                    if now:
                        done.append(now.row())
                    now = _Digest(conv)
                now.add(*turn)
            if done:
                yield packed(done)
        if now:
            yield packed([now.row()])

    dealt = turns.repartition("conv").sortWithinPartitions("conv", "position")
    return dealt.mapInArrow(run, DIGESTS)


def write_conversations(df: DataFrame, vocabulary_path: str) -> DataFrame:
    """The assembled output, written."""
    return materialise(assemble(df, vocabulary_path), "conversations")

"""Chat formatting: conversations to token ids with a loss mask.

Method: token-level assembly. Role and text of a turn are encoded as segments of
their own; reserved ids (outside the vocabulary) are spliced between them:

    START role SEP text END        (one turn; as text: <|im_start|>role\\ntext<|im_end|>\\n)

so that no text can produce a control id. Control strings in a text are escaped
as well, so that the plain-text form is unambiguous too: a backslash is put
after each ``<`` that backslashes (none included) and a ``|`` follow. Taking one
such backslash away is the exact inverse. In roles, backslashes and line breaks
are escaped first.

The loss mask covers the text ids of assistant turns. Token positions and mask
spans come from prefix sums of segment lengths: turns are range-partitioned by
(conversation, turn), summed inside each partition, and carried over partitions
by a table with at most one row per partition; a conversation with a third of
all turns is split over many tasks.

Nulls and ties: null text and null role count as empty; null conv_id or turn
sort first; turns of equal number are ordered by role, then a hash of the text;
repeated rows
are turns of their own; an empty table gives no rows. Other columns are not
read.

Texts of any length are processed whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.common import col, slices, stored
from touchline.llm.tokens import encoder

START, SEP, END = range(3)  # offsets of the reserved ids from the vocabulary's size
LOSS_ROLE = "assistant"
SEGMENT = ("conv_id long, turn long, part int, position long, ids binary, n_ids long, local_start long, "
           "text_start long, text_end long, formatted_chars long, is_loss boolean")


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    parts = F.split(unescape(role), r"\\\\")  # pairs of backslashes
    return F.array_join(F.transform(parts, lambda x: F.replace(x, F.lit("\\n"), F.lit("\n"))), "\\")


def format_chat(turns: DataFrame, tokenizer_path: str, conv_col: str = "conv_id", turn_col: str = "turn",
                role_col: str = "role", text_col: str = "text", loss_role: str = LOSS_ROLE) -> DataFrame:
    """One row per turn: conv_id, turn, (part, position) giving the global order,
    ids (little-endian unsigned 32-bit, reserved ids included), token_start in
    its conversation, the half-open loss span loss_start..loss_end there (empty
    for other roles), and formatted_chars of the turn's plain-text form."""
    is_loss = F.coalesce(col(turns, role_col).cast("string") == loss_role, F.lit(False)).alias("is_loss")
    source = turns.select(is_loss, col(turns, conv_col).cast("long").alias("conv_id"),
                          col(turns, turn_col).cast("long").alias("turn"),
                          escape_role(F.coalesce(col(turns, role_col).cast("string"), F.lit(""))).alias("role"),
                          escape(F.coalesce(col(turns, text_col).cast("string"), F.lit(""))).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part = encoder(tokenizer_path, special_as_text=True), TaskContext.get().partitionId()
        start, sep, end = (np.array([enc.vocabulary + k], "<u4") for k in (START, SEP, END))
        conv, at, position = object(), 0, 0
        for batch in batches:
            for a, b in slices(batch.column("text")):
                cut = batch.slice(a, b - a)
                ids, ends = enc.encode(cut.column("text"))
                role_ids, role_ends = enc.encode(cut.column("role"))
                chars = pa.compute.add(pa.compute.utf8_length(cut.column("role")),
                                       pa.compute.utf8_length(cut.column("text"))).to_pylist()
                rows = []
                for i, (c, t, is_loss) in enumerate(zip(*(cut.column(x).to_pylist() for x in (
                        "conv_id", "turn", "is_loss")))):
                    if c != conv:
                        conv, at = c, 0
                    head = role_ids[role_ends[i]:role_ends[i + 1]].astype("<u4")
                    body = ids[ends[i]:ends[i + 1]].astype("<u4")
                    own = np.concatenate([start, head, sep, body, end])
                    rows.append((c, t, part, position, own.tobytes(), len(own), at, at + len(head) + 2,
                                 at + len(head) + 2 + len(body), chars[i] + len("<|im_start|>\n<|im_end|>\n"), is_loss))
                    at, position = at + len(own), position + 1
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), *[pa.int64()] * 5, pa.bool_())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, k) for x, k in zip(zip(*rows), kinds)],
                    names=[f.split()[0] for f in SEGMENT.split(", ")])

    keys = ["conv_id", "turn", "role", F.xxhash64("text")]
    ordered = source.repartitionByRange(*keys).sortWithinPartitions(*keys, "text")
    segments = stored(ordered.mapInArrow(run, SEGMENT), "chat")
    # a conversation that began in earlier partitions: at most one such per partition
    sums = segments.groupBy("part", "conv_id").agg(F.sum("n_ids").alias("_n"))
    over = Window.partitionBy("conv_id").orderBy("part")
    carry = (sums.withColumn("_carry", F.sum("_n").over(over) - F.col("_n")).where("_carry > 0")
             .select(F.col("part").alias("_part"), F.col("conv_id").alias("_conv"), "_carry"))
    same = (F.col("part") == F.col("_part")) & F.col("conv_id").eqNullSafe(F.col("_conv"))
    placed = segments.join(carry, same, "left")
    before = F.coalesce("_carry", F.lit(0))
    return placed.select(
        "conv_id", "turn", "part", "position", "ids", (F.col("local_start") + before).alias("token_start"), "n_ids",
        "is_loss", (F.col("text_start") + before).alias("loss_start"),
        (F.when(F.col("is_loss"), F.col("text_end")).otherwise(F.col("text_start")) + before).alias("loss_end"),
        "formatted_chars")


def read_chat(formatted: DataFrame, tokenizer_path: str) -> DataFrame:
    """Decode formatted turns: role and text (unescaped), and loss_text, the
    text under the loss mask (empty for turns of other roles)."""
    schema = ("conv_id long, turn long, part int, position long, is_loss boolean, formatted_chars long, role string, "
              "text string, loss_text string")
    kept = ["conv_id", "turn", "part", "position", "is_loss", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path, special_as_text=True)
        reserved = [enc.vocabulary + k for k in (START, SEP, END)]
        for batch in batches:
            role, text, loss = [], [], []
            for ids, token_start, loss_start, loss_end in zip(*(batch.column(c).to_pylist() for c in (
                    "ids", "token_start", "loss_start", "loss_end"))):
                own = np.frombuffer(ids, "<u4")
                sep = int(np.flatnonzero(own == reserved[1])[0])
                role.append(own[1:sep].tolist())
                text.append(own[sep + 1:-1].tolist())
                loss.append(own[loss_start - token_start:loss_end - token_start].tolist())
            decode = lambda lists: enc.tokenizer.decode_batch(lists, skip_special_tokens=False)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), *(pa.array(decode(x), pa.string()) for x in (role, text, loss))],
                names=[*kept, "role", "text", "loss_text"])

    out = formatted.mapInArrow(run, schema)
    return (out.withColumn("role", unescape_role(F.col("role"))).withColumn("text", unescape(F.col("text")))
            .withColumn("loss_text", unescape(F.col("loss_text"))))

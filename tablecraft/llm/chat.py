"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are context, and only the
reply is trainable. A conversation that does not end with an assistant turn also gets one example
that holds all of it and trains nothing, so that no turn is missing from the output.

A turn is written as ``### role: text</turn>`` and a line break. Inside roles and texts a backslash,
``###`` and ``</turn>`` (in roles also ``:``) get a backslash in front, so that no text can forge a
mark, and reading back drops one backslash before any character.

No conversation and no example is ever one value. Turns are written once, one row each, in order and with
the characters before them. ``example_pieces`` expands them: one row for every turn of every example, at its
place in the example, so an example may be as long as it likes. The turns of a conversation are dealt by
chunks of ``CHUNK`` turns, and an example asks for its chunks, so a long conversation is expanded in many
tasks. The expansion itself grows with the square of the turns of a conversation; that is what the method
asks for. Only an example that is asked for as one text by ``examples`` is one value, which ends at 2 GB.
Defined results: null texts and roles are empty; turns with equal numbers go by role, then text; null turn
numbers come first; rows with a null conversation id form one conversation; an empty table gives no
example. Other columns of any name do no harm.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tablecraft.llm.batches import slices
from tablecraft.sources import stage

TRAINED_ROLE = "assistant"
END = "</turn>"
CHUNK = 64  # turns that are dealt together
FLUSH = 16_000_000  # characters of examples that a task holds before it passes them on
_TURN = re.compile(r"### ((?:[^\\:]|\\.)*): ((?:[^\\<]|\\.|<(?!/turn>))*)</turn>\n", re.DOTALL)
_ESCAPE = re.compile(r"\\(.)", re.DOTALL)


def escape(text: Column) -> Column:
    for mark in ("\\", "###", END):
        text = F.replace(text, F.lit(mark), F.lit("\\" + mark))
    return text


def unescape(text: str) -> str:
    return _ESCAPE.sub(r"\1", text)


def conversation_examples(turns: DataFrame, *, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per turn, in order within its conversation: key, turn_no, ``written``, the characters
    ``before`` it, whether it is the ``last``, whether it is ``trained``, and its loss span.

    The example of a turn that is trained or last is what is written up to it. The loss span is in code
    points of the example, end exclusive; it is empty where nothing is trained. ``examples`` and
    ``read_back`` take these rows in this order.
    """
    role_text, said = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    rows = turns.select(F.col(key).alias("key"), F.col(turn).alias("turn"), role_text.alias("role"), said.alias("text"))
    head = F.concat(F.lit("### "), F.replace(escape(F.col("role")), F.lit(":"), F.lit("\\:")), F.lit(": "))
    body = escape(F.col("text"))
    sized = rows.withColumns({"head": F.char_length(head).cast("long"), "body": F.char_length(body).cast("long")})
    whole = F.col("head") + F.col("body") + len(END) + 1
    order = Window.partitionBy("key").orderBy("turn", "role", "text")
    placed = sized.select(
        "*",
        F.row_number().over(order).alias("turn_no"),
        (F.sum(whole).over(order.rowsBetween(Window.unboundedPreceding, 0)) - whole).alias("before"),
        F.lead(F.lit(1)).over(order).isNull().alias("last"),
        (F.col("role") == TRAINED_ROLE).alias("trained"),
    )
    start = F.col("before") + F.col("head")
    return placed.select(
        "key",
        "turn_no",
        F.concat(head, body, F.lit(f"{END}\n")).alias("written"),
        "before",
        "last",
        "trained",
        F.when(F.col("trained"), start).otherwise(0).alias("loss_start"),
        F.when(F.col("trained"), start + F.col("body")).otherwise(0).alias("loss_end"),
    )


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """The turns of a task one by one; raises when they do not come as they were written."""
    key, number = None, 0
    for batch in batches:
        for i in range(batch.num_rows):
            turn = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
            if turn["turn_no"] != 1 and (turn["turn_no"] != number + 1 or turn["key"] != key):
                raise RuntimeError("turns of a conversation are not in order")
            key, number = turn["key"], turn["turn_no"]
            yield turn


def _whole_examples(kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "turn_no", "text", "loss_start", "loss_end"]
        kinds = (kind, pa.int32(), pa.string(), pa.int64(), pa.int64())
        made: list[tuple] = []
        held = 0
        context: list[str] = []
        for t in _in_order(batches):
            if t["turn_no"] == 1:
                context = []
            context.append(t["written"])
            if t["trained"] or t["last"]:
                context = ["".join(context)]
                made.append((t["key"], t["turn_no"], context[0], t["loss_start"], t["loss_end"]))
                held += len(context[0])
            if held >= FLUSH:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*made), kinds)], names=names)
                made, held = [], 0
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*made), kinds)], names=names)

    return run


def examples(turns: DataFrame, **names: str) -> DataFrame:
    """One row per example: key, turn_no, text, loss_start, loss_end. Every example is a row of its own
    and repeats the turns before it."""
    written = conversation_examples(turns, **names)
    key = written.schema["key"].dataType
    run = _whole_examples(to_arrow_type(key))
    return written.mapInArrow(run, f"key {key.simpleString()}, turn_no int, text string, loss_start long, loss_end long")


def read_turns(text: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted example."""
    return [(unescape(r), unescape(t)) for r, t in _TURN.findall(text)]


def example_pieces(conversations: DataFrame) -> DataFrame:
    """The examples of :func:`conversation_examples`, piece by piece: key, example (the number of its last turn),
    piece, ``at`` (characters of the example before it), text, the loss span of the example, and whether it is
    the ``last`` example of the conversation, which holds all turns."""
    chunk = F.expr(f"(turn_no - 1) div {CHUNK}")
    turns = conversations.select("key", "turn_no", "written", "before", chunk.alias("chunk"))
    asked = conversations.where("trained or last").select(
        F.col("key").alias("of"),
        F.col("turn_no").alias("example"),
        "loss_start",
        "loss_end",
        "last",
        F.explode(F.sequence(F.lit(0).cast("long"), chunk)).alias("asked"),
    )
    same = F.col("key").eqNullSafe(F.col("of")) & (F.col("chunk") == F.col("asked")) & (F.col("turn_no") <= F.col("example"))
    return turns.join(asked, same).select(
        "key", "example", F.col("turn_no").alias("piece"), F.col("before").alias("at"), F.col("written").alias("text"), "loss_start", "loss_end", "last"
    )


def _digests(kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "n_turns", "turns_sha256", "loss_chars", "loss_sha256"]
        kinds = (kind, pa.int64(), pa.string(), pa.int64(), pa.string())
        made: list[tuple] = []
        key, begun = None, False
        whole, loss = hashlib.sha256(), hashlib.sha256()
        n_turns = loss_chars = 0
        for batch in batches:
            for row in (r for a, b in slices(batch.column("text")) for r in batch.slice(a, b - a).to_pylist()):
                if not begun or row["key"] != key:
                    if begun:
                        made.append((key, n_turns, whole.hexdigest(), loss_chars, loss.hexdigest()))
                    key, begun = row["key"], True
                    whole, loss = hashlib.sha256(), hashlib.sha256()
                    n_turns = loss_chars = 0
                text, at = row["text"], row["at"]
                said = unescape(text[max(row["loss_start"] - at, 0) : max(row["loss_end"] - at, 0)])
                loss_chars += len(said)
                loss.update(said.encode("utf-8", "surrogatepass"))
                for r, t in read_turns(text) if row["last"] else ():
                    n_turns += 1
                    whole.update(f"{r}\n{t}\n".encode("utf-8", "surrogatepass"))
            if len(made) >= 5000:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*made), kinds)], names=names)
                made = []
        if begun:
            made.append((key, n_turns, whole.hexdigest(), loss_chars, loss.hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*made), kinds)], names=names)

    return run


def read_back(conversations: DataFrame) -> DataFrame:
    """What the written examples of each conversation say when they are read again, one row per conversation:
    the turns of its last example, the text under the loss masks of all, and the characters of all.

    All is taken from the pieces, which are written first. The characters are counted where the pieces lie; the
    pieces under a mask and those of the last example, as many as there are turns, are hashed in order, one
    conversation in one task, as SHA-256 needs it, and none is held whole.
    """
    key = conversations.schema["key"].dataType
    pieces = stage(example_pieces(stage(conversations, "chat-turns")), "chat-examples")
    counted = pieces.groupBy("key").agg(F.sum(F.char_length("text")).cast("long").alias("formatted_chars"))
    masked = "at < loss_end and at + char_length(text) > loss_start"
    wanted = pieces.where(f"last or ({masked})").repartition("key").sortWithinPartitions("key", "example", "piece")
    fields = wanted.select("key", "text", "at", "loss_start", "loss_end", "last")
    kinds = f"key {key.simpleString()}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string"
    digests = fields.mapInArrow(_digests(to_arrow_type(key)), kinds)
    counted = counted.withColumnRenamed("key", "counted")
    return digests.join(counted, F.col("key").eqNullSafe(F.col("counted"))).drop("counted")

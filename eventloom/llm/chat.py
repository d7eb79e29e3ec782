"""Chat formatting: fold event logs of conversations into messages and render them.

A log row is (conv_id, seq, turn, kind, role, text). Kinds:

* ``delta``: text is added to the end of the message at ``turn``;
* ``edit``: the message at ``turn`` becomes ``text``; what it had and all later
  turns written before go;
* ``regenerate``: the message at ``turn`` starts anew, empty; later turns go too.

Output is one row per message (conv_id, pos, role, formatted, loss_start,
loss_chars). A conversation's formatted text is its rows' ``formatted`` joined by
``pos``, so no cell holds more than one message and a conversation of any length
streams through. The loss mask is a range of code points of ``formatted``: the
body of an assistant message, without its marks.

Defined cases: null text is empty; a null role is an empty role; a null conv_id
is a conversation of its own; a null kind is a delta; rows with null turn come
first. Equal ``seq`` are ordered by turn, kind, role and text. An empty log gives
no rows. Other columns of the log are not looked at.

A conversation is read in order by one task, as its digest has to be, with
memory for one message; folding sorts its rows on disk when they are many.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The marks of the template.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"

MESSAGES = "conv_id long, pos long, role string, formatted string, loss_start long, loss_chars long"
DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def escape(text: str) -> str:
    """No ``<|`` is left: each gets one more backslash between its signs than it had."""
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def _role_out(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _role_in(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(text))


def render(role: str, text: str) -> tuple[str, int, int]:
    """A formatted message, and the range of its body if the loss covers it."""
    head, body = f"{OPEN}{_role_out(role)}\n", escape(text)
    return f"{head}{body}{CLOSE}\n", len(head), len(body) if role == "assistant" else 0


def parse(formatted: str) -> tuple[str, str]:
    """Role and text of a formatted message."""
    role, body = formatted.removeprefix(OPEN).removesuffix(f"{CLOSE}\n").split("\n", 1)
    return _role_in(role), unescape(body)


def surviving(log: DataFrame) -> DataFrame:
    """Log rows that no later edit or regeneration of the same or an earlier turn has replaced."""
    later = (
        Window.partitionBy("conv_id")
        .orderBy(*[F.col(c).desc_nulls_last() for c in ("seq", "turn", "kind", "role", "text")])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    restart = F.when(F.col("kind").isin("edit", "regenerate"), F.coalesce("turn", F.lit(-(2**63))))
    return (
        log.select("conv_id", "seq", "turn", F.coalesce("kind", F.lit("delta")).alias("kind"), "role", "text")
        .withColumn("cut", F.min(restart).over(later))
        .where(F.col("cut").isNull() | (F.coalesce("turn", F.lit(-(2**63))) < F.col("cut")))
        .drop("cut")
    )


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Messages of rows sorted by conversation, turn and sequence."""
    key, role, parts, pos, out = None, "", [], 0, []

    def close() -> None:
        if key is not None:
            formatted, start, chars = render(role, "".join(parts))
            out.append((key[0], pos, role, formatted, start, chars))

    for batch in batches:
        for conv, turn, kind, who, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if (conv, turn) != key:
                close()
                pos = pos + 1 if key is not None and key[0] == conv else 0
                key, role, parts = (conv, turn), who or "", []
            elif who and kind != "regenerate":
                role = who
            if kind != "regenerate" and text:
                parts.append(text)
        yield _rows(out, ("i8", "i8", "s", "s", "i8", "i8"), MESSAGES)
        out = []
    close()
    yield _rows(out, ("i8", "i8", "s", "s", "i8", "i8"), MESSAGES)


def _rows(rows: list[tuple], kinds: tuple[str, ...], schema: str) -> pa.RecordBatch:
    names = [c.split()[0] for c in schema.split(", ")]
    types = [pa.int64() if k == "i8" else pa.string() for k in kinds]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def format_chats(log: DataFrame) -> DataFrame:
    """Rendered messages of an event log; see the module's text."""
    return (
        surviving(log)
        .sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "seq", "kind", "role", "text")
        .select("conv_id", "turn", "kind", "role", "text")
        .mapInArrow(_fold, MESSAGES)
    )


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of conversations from formatted messages sorted by conversation and position."""
    state, out, kinds = None, [], ("i8", "i8", "s", "i8", "s", "i8")

    def close() -> None:
        if state:
            conv, turns, all_turns, chars, loss, total = state
            out.append((conv, turns, all_turns.hexdigest(), chars, loss.hexdigest(), total))

    for batch in batches:
        for conv, formatted, start, chars in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if not state or state[0] != conv:
                close()
                state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            role, text = parse(formatted)
            learned = unescape(formatted[start : start + chars])
            state[1] += 1
            state[2].update(f"{role}\n{text}\n".encode())
            state[3] += len(learned)
            state[4].update(learned.encode())
            state[5] += len(formatted)
        yield _rows(out, kinds, DIGESTS)
        out = []
    close()
    yield _rows(out, kinds, DIGESTS)


def read_digests(messages: DataFrame) -> DataFrame:
    """One row per conversation, read back from formatted messages alone."""
    return (
        messages.select("conv_id", "pos", "formatted", "loss_start", "loss_chars")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "pos")
        .select("conv_id", "formatted", "loss_start", "loss_chars")
        .mapInArrow(_digest, DIGESTS)
    )


def as_log(conversations: DataFrame) -> DataFrame:
    """Event log of conversations as they may have been written: one message for each row, by turn, role and text.

    A message is a draft of its first half, which an edit, or a regeneration of the
    assistant, takes back, and then the halves of its text as deltas (a later one
    names no role). Formatting the log gives the rows again.
    """
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    place = F.row_number().over(order).cast("long")
    rows = conversations.select("conv_id", "role", "text", place.alias("place"))
    half = (F.length("text") / 2).cast("int")
    first, second = F.substring("text", F.lit(1), half), F.substring("text", half + 1, F.length("text"))
    again = F.coalesce(F.col("role") == "assistant", F.lit(False))
    none = F.lit(None).cast("string")
    steps = (
        (F.lit("delta"), F.col("role"), first),
        (F.when(again, "regenerate").otherwise("edit"), F.col("role"), F.when(~again, first)),
        (F.lit("delta"), F.when(again, F.col("role")), F.when(again, first)),
        (F.lit("delta"), none, second),
    )
    log = F.array(
        *[
            F.struct((4 * F.col("place") + k).alias("seq"), kind.alias("kind"), role.alias("role"), text.alias("text"))
            for k, (kind, role, text) in enumerate(steps)
        ]
    )
    rows = rows.select("conv_id", F.col("place").alias("turn"), F.explode(log).alias("step"))
    return rows.select("conv_id", "step.seq", "turn", "step.kind", "step.role", "step.text")

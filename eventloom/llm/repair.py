"""Conversation repair: the cheapest edits that make roles alternate, with an audit.

A conversation is legal if its roles read ``(s?(ua)+)?``: an optional system message,
then user and assistant in turn. Each message is kept (0), given the role user or
assistant (3) or deleted (4); empty messages are inserted (3). Blank messages and
repeats of an earlier one must be deleted; a truncated one that stays adds 3. Of the
cheapest edits those with the ASCII-least initials (D, I, K, R) are taken.

What a message allows depends on its symbol only, the class of its role and its fault.
A symbol is a 4 x 4 matrix in min-plus arithmetic over the states of the pattern, so a
run of equal symbols is a power of its matrix, put together from cached binary powers.
Conversations are cut into segments of consecutive messages, a bounded number each:

1. every segment becomes its matrix (product of its runs);
2. one row per segment is enough to carry the cost to go back from a conversation's end;
3. segments unroll their choices, for each state they may be entered in: a run is
   halved by its powers until it is short, so few vectors are held at a time;
4. the states are followed forward over segments, which picks one choice of each.

So a conversation may hold a large share of all rows: only step 2 and 4 see it whole,
with one row for 4096 messages. Rows are put in order by range partitions of (id,
turn, digest of the message), which split such a conversation as well. The digest of
repaired texts is a running one, so there one task reads a conversation, streaming.

Defined cases: messages are ordered by turn, NULLs first, then by role and digest of
the text; a null role or text is one space; null ids are one conversation; repeated
rows are repeats, so all but one go; an empty table gives no rows; texts of any length
are only hashed and looked at at their end; other columns are not looked at. A role's class
is its first letter, s, u or a; any other role, and the empty one, fits nowhere.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import stored

SEGMENT_BITS = 12
BLANK = r"[^\x20\x09-\x0D]"
ROLES = {"u": "user", "a": "assistant"}

# The costs of edits.
REROLE, DELETE, INSERT, CUT_OFF = 3, 4, 3, 3

# States: nothing yet, after system, after user, after assistant.
NEVER = 1 << 60
STATES = range(4)
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
WANTED = {0: "u", 1: "u", 2: "a", 3: "u"}  # what may be inserted, or a message turned into
AT_END = (0, 2 * INSERT, INSERT, 0)  # cost of the inserts that complete the pattern

# Symbols: class of the role (s, u, a, other) and fault (none, must go, truncated), as one character each.
CLASSES = "sua-"
SOUND, MUST_GO, TRUNCATED = "0", "1", "2"
SHORT = 16


def _edits(role: str, fault: str, state: int) -> list[tuple[str, int, int]]:
    """(initial, cost, next state) of the edits that use up a message, by initial."""
    out = [("D", DELETE, state)]
    if fault != MUST_GO:
        more = CUT_OFF if fault == TRUNCATED else 0
        if (state, role) in NEXT:
            out.append(("K", more, NEXT[state, role]))
        out.append(("R", REROLE + more, NEXT[state, WANTED[state]]))
    return out


Matrix = tuple[tuple[int, ...], ...]


def _times(a: Matrix, b: Matrix) -> Matrix:
    columns = list(zip(*b, strict=True))
    return tuple(tuple(min(min(map(int.__add__, row, column)), NEVER) for column in columns) for row in a)


def _applied(a: Matrix, v: tuple[int, ...]) -> tuple[int, ...]:
    return tuple(min(min(map(int.__add__, row, v)), NEVER) for row in a)


IDENTITY: Matrix = tuple(tuple(0 if p == q else NEVER for q in STATES) for p in STATES)


@cache
def _inserts() -> Matrix:
    """Cheapest way from state to state by inserts alone."""
    once = [[0 if p == q else NEVER for q in STATES] for p in STATES]
    for p in STATES:
        once[p][NEXT[p, WANTED[p]]] = INSERT
    step = tuple(map(tuple, once))
    return _times(step, step)


@cache
def power(role: str, fault: str, k: int) -> Matrix:
    """The matrix of 2**k messages of one symbol, inserts before each of them included."""
    if k:
        half = power(role, fault, k - 1)
        return _times(half, half)
    own = [[NEVER] * 4 for _ in STATES]
    for p in STATES:
        for _, cost, q in _edits(role, fault, p):
            own[p][q] = min(own[p][q], cost)
    return _times(_inserts(), tuple(map(tuple, own)))


def _powers(symbol: tuple[str, str], n: int) -> Iterator[Matrix]:
    for k in range(n.bit_length()):
        if n >> k & 1:
            yield power(*symbol, k)


def _advance(symbol: tuple[str, str], n: int, v: tuple[int, ...]) -> tuple[int, ...]:
    """Cost to go before a run, from that after it."""
    for matrix in _powers(symbol, n):
        v = _applied(matrix, v)
    return v


def runs_of(classes: str, faults: str) -> list[tuple[tuple[str, str], int]]:
    return [(symbol, len(list(same))) for symbol, same in groupby(zip(classes, faults, strict=True))]


def segment_matrix(classes: str, faults: str) -> Matrix:
    out = IDENTITY
    for symbol, n in runs_of(classes, faults):
        for matrix in _powers(symbol, n):
            out = _times(out, matrix)
    return out


def unroll(classes: str, faults: str, after: tuple[int, ...], state: int) -> tuple[list[tuple[str, str]], int]:
    """(edits, roles) of each message from ``state`` on, and the state in the end.

    Edits are initials, that of the message last; roles are the first letters of what
    is written for them, '-' for nothing and '=' for the message's own role.
    """
    runs = runs_of(classes, faults)
    ends = [after]
    for symbol, n in reversed(runs[1:]):
        ends.append(_advance(symbol, n, ends[-1]))
    out: list[tuple[str, str]] = []

    def walk(symbol: tuple[str, str], n: int, end: tuple[int, ...], p: int) -> int:
        if n > SHORT:
            half = 1 << ((n - 1).bit_length() - 1)
            p = walk(symbol, n - half, _advance(symbol, half, end), p)
            return walk(symbol, half, end, p)
        to_go = [end]
        for _ in range(n):
            to_go.append(_applied(power(*symbol, 0), to_go[-1]))
        for left in range(n, 0, -1):
            now, then = to_go[left], to_go[left - 1]
            edits, roles = "", ""
            while True:
                options = [(e, cost + then[q], q) for e, cost, q in _edits(*symbol, p)]
                added = NEXT[p, WANTED[p]]
                options.append(("I", INSERT + now[added], added))
                edit, _, q = min(option for option in options if option[1] == now[p])
                edits += edit
                roles += {"D": "-", "K": "="}.get(edit, WANTED[p])
                p = q
                if edit != "I":
                    break
            out.append((edits, roles))
        return p

    for (symbol, n), end in zip(runs, reversed(ends), strict=True):
        state = walk(symbol, n, end, state)
    return out, state


def _completion(state: int) -> str:
    """Roles to be added after the last message."""
    out = ""
    while AT_END[state]:
        out += WANTED[state]
        state = NEXT[state, WANTED[state]]
    return out


# --- Spark ---------------------------------------------------------------------------------


def ordered(rows: DataFrame) -> DataFrame:
    """Messages (conv_id, turn, role, text, mark, at), stored; ``at`` rises in the order of conversations and messages."""
    space = F.lit(" ")
    rows = rows.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"))
    length = F.length("role").cast("string")
    rows = rows.withColumn("mark", F.sha2(F.concat(length, F.lit(":"), F.col("role"), F.col("text")), 256))
    # equal messages may be many: their number keeps them apart in ranges
    rows = rows.withColumn("at", F.monotonically_increasing_id())
    keys = ["conv_id", F.col("turn").asc_nulls_first(), F.substring("role", 1, 64), "mark", "at"]
    sorted_rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return stored(sorted_rows.withColumn("at", F.monotonically_increasing_id()), "repair-ordered")


def with_faults(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, at, class, fault) with the first fault of each message: blank, duplicate, truncated or null."""
    last = F.regexp_extract("text", rf"(?s)({BLANK})[\x20\x09-\x0D]*\z", 1)
    first = F.when(F.substring("role", 1, 1).isin("s", "u", "a"), F.substring("role", 1, 1)).otherwise("-")
    narrow = messages.select("conv_id", "turn", "at", "mark", first.alias("class"), last.alias("last"))
    repeated = messages.groupBy(F.col("conv_id").alias("_conv"), F.col("mark").alias("_mark")).agg(
        F.min("at").alias("_first"), F.count("*").alias("_n")
    )
    same = [F.col("conv_id").eqNullSafe(F.col("_conv")), F.col("mark") == F.col("_mark")]
    joined = narrow.join(repeated.where("_n > 1").drop("_n"), same, "left")
    fault = (
        F.when(F.col("last") == "", "blank")
        .when(F.col("at") > F.col("_first"), "duplicate")
        .when(~F.col("last").isin(".", "!", "?"), "truncated")
    )
    return joined.select("conv_id", "turn", "at", "class", fault.alias("fault"))


def _segments(faults: DataFrame) -> DataFrame:
    """(conv_id, seg, start, classes, faults): consecutive messages, one character each."""
    code = F.when(F.col("fault").isNull(), SOUND).when(F.col("fault") == "truncated", TRUNCATED).otherwise(MUST_GO)
    item = F.struct("at", "class", code.alias("fault"))
    grouped = faults.groupBy("conv_id", F.shiftright("at", SEGMENT_BITS).alias("seg")).agg(
        F.array_sort(F.collect_list(item)).alias("items")
    )
    return grouped.select(
        "conv_id",
        "seg",
        F.element_at("items", 1)["at"].alias("start"),
        F.array_join("items.class", "").alias("classes"),
        F.array_join("items.fault", "").alias("faults"),
    )


_LEGAL = {"su", "ua", "au"}


def _with_matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        classes, faults = batch.column("classes").to_pylist(), batch.column("faults").to_pylist()
        pairs = zip(classes, faults, strict=True)
        matrices = pa.array([[x for row in segment_matrix(*p) for x in row] for p in pairs], pa.list_(pa.int64()))
        illegal = [sum(x + y not in _LEGAL for x, y in zip(c, c[1:], strict=False)) for c in classes]
        yield batch.append_column("matrix", matrices).append_column("illegal", pa.array(illegal, pa.int64()))


def _back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cost to go at the end of each segment of a conversation."""
    for batch in batches:
        out = {name: [] for name in ("conv_id", "seg", "to_go", "is_first", "is_last", "cost", "illegal")}
        for row in batch.to_pylist():
            v, later = AT_END, None
            segments = row["segments"]
            for i in range(len(segments) - 1, -1, -1):
                segment = segments[i]
                out["conv_id"].append(row["conv_id"])
                out["seg"].append(segment["seg"])
                out["to_go"].append(list(v))
                out["is_first"].append(i == 0)
                out["is_last"].append(later is None)
                joint = later is not None and segment["last"] + later not in _LEGAL
                out["illegal"].append(segment["illegal"] + joint)
                flat = segment["matrix"]
                v = _applied(tuple(tuple(flat[4 * p : 4 * p + 4]) for p in STATES), v)
                out["cost"].append(v[0])
                later = segment["first"]
        types = {"conv_id": batch.column(0).type, "to_go": pa.list_(pa.int64())}
        flags = {"is_first": pa.bool_(), "is_last": pa.bool_()}
        arrays = [pa.array(values, types.get(name) or flags.get(name, pa.int64())) for name, values in out.items()]
        yield pa.RecordBatch.from_arrays(arrays, list(out))


_CHOICE = pa.struct([("exit", pa.int64()), ("edits", pa.list_(pa.string())), ("roles", pa.list_(pa.string()))])


def _unrolled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        choices = []
        for row in batch.to_pylist():
            own = []
            for state in [0] if row["is_first"] else STATES:
                after = tuple(row["to_go"])
                steps, exit_state = unroll(row["classes"], row["faults"], after, state)
                if row["is_last"]:
                    added = _completion(exit_state)
                    steps[-1] = (steps[-1][0] + "I" * len(added), steps[-1][1] + added)
                own.append({"exit": exit_state, "edits": [e for e, _ in steps], "roles": [r for _, r in steps]})
            choices.append(own)
        kept = batch.select(["conv_id", "seg", "start"])
        yield kept.append_column("choices", pa.array(choices, pa.list_(_CHOICE)))


def _forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state in which each segment is entered."""
    for batch in batches:
        out: tuple[list, list, list] = ([], [], [])
        for row in batch.to_pylist():
            state = 0
            for segment in row["segments"]:
                for values, value in zip(out, (row["conv_id"], segment["seg"], state), strict=True):
                    values.append(value)
                state = segment["exits"][state]
        arrays = [pa.array(out[0], batch.column(0).type), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64())]
        yield pa.RecordBatch.from_arrays(arrays, ["conv_id", "seg", "entry"])


def _same_segment(left: DataFrame, right: DataFrame) -> DataFrame:
    """Inner join on (conv_id, seg); the ids may be null."""
    right = right.withColumnsRenamed({"conv_id": "_conv", "seg": "_seg"})
    same = [F.col("conv_id").eqNullSafe(F.col("_conv")), F.col("seg") == F.col("_seg")]
    return left.join(right, same).drop("_conv", "_seg")


def solve(faults: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cheapest edits for messages with faults: those of each message, and a summary.

    The first has (conv_id, at, edits, roles) for each message, see ``unroll``; the second
    (conv_id, illegal, cost, audit) for each conversation with messages.
    """
    key = dict(faults.dtypes)["conv_id"]
    shape = f"conv_id {key}, seg long, start long, classes string, faults string"
    segments = stored(
        _segments(faults).mapInArrow(_with_matrices, f"{shape}, matrix array<long>, illegal long"), "repair-segments"
    )
    brief = F.struct(
        "seg",
        "matrix",
        "illegal",
        F.substring("classes", 1, 1).alias("first"),
        F.substring("classes", -1, 1).alias("last"),
    )
    whole = segments.groupBy("conv_id").agg(F.array_sort(F.collect_list(brief)).alias("segments"))
    back = f"conv_id {key}, seg long, to_go array<long>, is_first boolean, is_last boolean, cost long, illegal long"
    costs = stored(whole.mapInArrow(_back, back), "repair-costs")
    choice = "struct<exit: long, edits: array<string>, roles: array<string>>"
    at_segments = _same_segment(segments, costs.drop("cost", "illegal"))
    unrolled = at_segments.mapInArrow(_unrolled, f"conv_id {key}, seg long, start long, choices array<{choice}>")
    unrolled = stored(unrolled, "repair-choices")
    exits = unrolled.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("seg", F.col("choices.exit").alias("exits")))).alias("segments")
    )
    entries = exits.mapInArrow(_forward, f"conv_id {key}, seg long, entry long")
    chosen = _same_segment(unrolled, entries).select(
        "conv_id", "seg", "start", F.get("choices", F.col("entry").cast("int")).alias("choice")
    )
    chosen = stored(chosen, "repair-chosen")
    pair = F.arrays_zip(F.col("choice.edits").alias("edits"), F.col("choice.roles").alias("roles"))
    edits = chosen.select("conv_id", "start", F.posexplode(pair).alias("i", "step")).select(
        "conv_id", (F.col("start") + F.col("i")).alias("at"), "step.edits", "step.roles"
    )
    audits = chosen.groupBy(F.col("conv_id").alias("_conv")).agg(
        F.array_sort(F.collect_list(F.struct("seg", F.array_join("choice.edits", "").alias("edits")))).alias("parts")
    )
    totals = costs.groupBy("conv_id").agg(
        F.sum("illegal").alias("illegal"), F.max(F.when(F.col("is_first"), F.col("cost"))).alias("cost")
    )
    summary = totals.join(audits, F.col("conv_id").eqNullSafe(F.col("_conv"))).select(
        "conv_id", "illegal", "cost", F.array_join("parts.edits", "").alias("audit")
    )
    return edits, summary


def repaired(messages: DataFrame, edits: DataFrame) -> DataFrame:
    """The messages that stay and those inserted: (conv_id, at, no, edit, role, text) in order of (at, no)."""
    steps = edits.select(F.col("at").alias("_at"), "edits", "roles")
    joined = messages.join(steps, F.col("at") == F.col("_at"))
    numbers = F.sequence(F.lit(1), F.length("edits"))
    step = joined.withColumn("no", F.explode(numbers)).withColumn("edit", F.expr("substring(edits, no, 1)"))
    letter = F.expr("substring(roles, no, 1)")
    new_role = F.when(letter == "u", ROLES["u"]).when(letter == "a", ROLES["a"]).otherwise(F.col("role"))
    text = F.when(F.col("edit") == "I", "").otherwise(F.col("text"))
    return step.where("edit <> 'D'").select("conv_id", "at", "no", "edit", new_role.alias("role"), text.alias("text"))


def digests(fixed: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): running digest of ``role:text`` lines of each conversation, in order."""

    def running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest, key_type = None, None, None
        done: tuple[list, list] = ([], [])
        for batch in batches:
            key_type = batch.column(0).type
            for conv, role, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                line = f"{role}:{text}".encode()
                if digest is not None and current == conv:
                    digest.update(b"\n")
                else:
                    if digest is not None:
                        done[0].append(current)
                        done[1].append(digest.hexdigest())
                    current, digest = conv, hashlib.sha256()
                digest.update(line)
            yield pa.RecordBatch.from_arrays([pa.array(done[0], key_type), pa.array(done[1], pa.string())], ["conv_id", "sha"])
            done = ([], [])
        if digest is not None:
            last = [pa.array([current], key_type), pa.array([digest.hexdigest()])]
            yield pa.RecordBatch.from_arrays(last, ["conv_id", "sha"])

    rows = fixed.repartition("conv_id").sortWithinPartitions("conv_id", "at", "no").select("conv_id", "role", "text")
    key = dict(fixed.dtypes)["conv_id"]
    return rows.mapInArrow(running, f"conv_id {key}, repaired_sha256 string")


def gap_count(messages: DataFrame) -> Column:
    return F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps")


def report(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text): faults, cost, audit and digest of the repair."""
    messages = ordered(rows)
    faults = stored(with_faults(messages), "repair-faults")
    edits, summary = solve(faults)
    kinds = ("blank", "duplicate", "truncated")
    counts = faults.groupBy("conv_id").agg(
        gap_count(faults), *[F.count_if(F.col("fault") == kind).alias(kind) for kind in kinds]
    )
    empty = hashlib.sha256(b"").hexdigest()
    out = counts
    for part in (summary, digests(repaired(messages, edits))):
        part = part.withColumnRenamed("conv_id", "_conv")
        out = out.join(part, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").drop("_conv")
    return out.withColumn("repaired_sha256", F.coalesce("repaired_sha256", F.lit(empty)))


def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` with faults put in by a keyed hash of (conv_id, turn): some dropped, emptied, cut, repeated or re-roled."""
    part = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat(part[0], F.lit(":"), part[1])) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    rows = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        copies.alias("copy"),
    ).drop("copy")


def damage_report(rows: DataFrame) -> DataFrame:
    """``report`` of the damaged rows, with every conversation of ``rows``, also those left without messages."""
    found = report(damaged(rows)).withColumnRenamed("conv_id", "_conv")
    every = rows.select("conv_id").distinct()
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return every.join(found, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").select(
        "conv_id",
        *counts,
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )

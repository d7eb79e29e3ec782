"""Suffix-array dedup: removes bytes covered by a long string that also starts earlier.

Every suffix of every document counts with its first ``length`` bytes, so the suffixes of
equal prefixes are copies of one string; all but the earliest of them (smaller doc_id, then
earlier start) cover bytes that are removed. The suffixes are sorted bucket by bucket:

1. Of the ``length - SEED + 1`` seeds (strings of ``SEED`` bytes) that begin in a string, the
   one of least hash is its anchor. Equal strings have equal anchors at the same distance,
   so the anchor's hash is the bucket of a suffix, and a suffix is known by its anchor and
   distance. About one place in 31 is an anchor, and only anchors are moved, packed, with
   a hash of their surroundings (all strings that can have them as anchor).
2. Anchors of equal surroundings are copies as a whole: all but the first are removed
   without another look. Anchors of a seed that is found once are dropped. What is left
   are the first of each surroundings, of seeds that have several.
3. These are read from their documents, and their suffixes sorted one bucket at a time.
   Long ties are resolved by ranks made beforehand: those of the strings of
   ``length - PERIOD + 1`` bytes at the places of a difference cover modulo ``PERIOD``. Two suffixes
   are equal if the ranks at their first and last place of the cover are, and the few bytes
   before and after. So no suffix is held as a string, and a bucket takes memory for its
   surroundings and the ranks at some 18 places of each.
4. Seeds with more than ``MOST`` different surroundings would be one large bucket. Their
   strings are grouped by digest instead, where Spark adds up before it shuffles.

Step 2 compares hashes (64 bits of the seed and 64 of its surroundings), step 3 bytes,
step 4 digests of 256 bits.

Defined cases: a null text is empty; a null id counts as the largest number; rows of equal
id are ordered by a hash of their text, and rows equal in both are one document, which all
of them show alike; documents shorter than ``length`` lose nothing; long texts are looked at
in pieces; an empty table gives no rows; other columns of the table are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import WORD_BASE, mix, steps, stored

LENGTH = 100
SEED = 40
# A difference cover, so every distance modulo the period is that of two of its members.
PERIOD, COVER = 31, (0, 1, 3, 8, 12, 18)

#: Bytes of a text that are looked at together, and anchors that are packed together.
PIECE = 1 << 20
PACK = 1 << 18
#: Bytes of text for each bucket, which makes some 130,000 anchors, and buckets for each task, one after the other.
BUCKET_BYTES = 4 << 20
TASK_BUCKETS = 4
#: Different surroundings of a seed that are sorted as one bucket.
MOST = 50_000
LARGEST_ID = (1 << 63) - 1

PLACE = [("seed", np.uint64), ("around", np.uint64), ("id", np.int64), ("mark", np.int64), ("at", np.int64)]


# --- anchors ------------------------------------------------------------------------------


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (WORD_BASE, pow(WORD_BASE, -1, 1 << 64)):
        row = np.full(n, np.uint64(base))
        row[0] = 1
        out.append(np.multiply.accumulate(row))
    return out[0], out[1]


def _spread(values: np.ndarray, width: int, of) -> np.ndarray:
    """``of`` (minimum or maximum) over ``width`` neighbours from each place on."""
    span = 1
    while 2 * span <= width:
        values = of(values[:-span], values[span:])
        span *= 2
    return of(values[: len(values) - (width - span)], values[width - span :]) if width > span else values


def anchors(data: np.ndarray, owners: np.ndarray, length: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, hash of the seed, hash of the surroundings) of the anchors of ``data``, the bytes of texts end to end.

    ``owners`` are the starts of the texts and the end of the last.
    """
    n, reach = len(data), length - seed + 1
    nothing = np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64)
    if n < length:
        return nothing
    size = 1 << max(16, (n - 1).bit_length())
    power, inverse = _powers(size)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:n], out=sums[1:])
    own = mix((sums[seed:] - sums[: n + 1 - seed]) * inverse[: n + 1 - seed]) | np.uint64(1)
    least = _spread(own, reach, np.minimum)  # for each string of ``length`` bytes
    # strings that run over the end of a text have no anchor
    for end in owners[1:]:
        least[max(end - length + 1, 0) : end] = 0
    sides = np.zeros(reach - 1, np.uint64)
    best = _spread(np.concatenate((sides, least, sides)), reach, np.maximum)
    at = np.flatnonzero(best == own)
    text = np.searchsorted(owners, at, side="right") - 1
    low, high = np.maximum(at - reach + 1, owners[text]), np.minimum(at + length, owners[text + 1])
    around = mix((sums[high] - sums[low]) * inverse[low])
    around = mix(around + mix((at - low).astype(np.uint64) << np.uint64(32) | (high - at).astype(np.uint64)))
    return at, own[at], around


def _texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column end to end, and the places where its texts start and the last ends."""
    whole = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(whole.buffers()[1], np.int64)[whole.offset : whole.offset + len(whole) + 1]
    if offsets[-1] == offsets[0]:
        return np.empty(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(whole.buffers()[2], np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def _anchors_of(batch: pa.RecordBatch, length: int) -> Iterator[np.ndarray]:
    """Anchors of the texts of a batch (id, mark, text), in pieces."""
    ids, marks = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
    margin = 2 * length
    for low, high in steps(batch.column(2), PIECE):
        data, owners = _texts(batch.column(2).slice(low, high - low))
        for start in range(0, max(len(data), 1), PIECE if high - low == 1 else max(len(data), 1)):
            first, last = max(start - margin, 0), start + PIECE + margin
            # a piece of a long text is looked at with what is next to it
            whole = high - low > 1 or len(data) <= PIECE
            part = data if whole else data[first:last]
            at, seed, around = anchors(part, owners if whole else np.array([0, len(part)]), length)
            if not whole:
                at = at + first
                kept = (at >= start) & (at < start + PIECE)
                at, seed, around = at[kept], seed[kept], around[kept]
            text = np.searchsorted(owners, at, side="right") - 1
            out = np.empty(len(at), PLACE)
            out["seed"], out["around"], out["at"] = seed, around, at - owners[text]
            out["id"], out["mark"] = ids[low:high][text], marks[low:high][text]
            yield out


def _packed(rows: np.ndarray) -> bytes:
    """Rows column by column and byte by byte, so that equal bytes lie side by side."""
    return b"".join(np.ascontiguousarray(rows[c]).view(np.uint8).reshape(-1, 8).T.tobytes() for c, _ in PLACE)


def _unpacked(payloads: list[bytes]) -> np.ndarray:
    size = 8 * len(PLACE)
    out = np.empty(sum(map(len, payloads)) // size, PLACE)
    low = 0
    for payload in payloads:
        n = len(payload) // size
        planes = np.frombuffer(payload, np.uint8).reshape(len(PLACE), 8, n)
        for (name, kind), plane in zip(PLACE, planes, strict=True):
            out[name][low : low + n] = np.ascontiguousarray(plane.T).view(kind)[:, 0]
        low += n
    return out


def _in_order(rows: np.ndarray) -> np.ndarray:
    """Rows by seed, surroundings and place, each once: equal documents have the same places."""
    rows = rows[np.lexsort((rows["at"], rows["mark"], rows["id"], rows["around"], rows["seed"]))]
    new = np.ones(len(rows), bool)
    new[1:] = np.logical_or.reduce([rows[c][1:] != rows[c][:-1] for c, _ in reversed(PLACE)])
    return rows[new]


def _firsts(rows: np.ndarray) -> np.ndarray:
    """Which of ordered rows are the first with their seed and surroundings."""
    new = np.ones(len(rows), bool)
    new[1:] = (rows["seed"][1:] != rows["seed"][:-1]) | (rows["around"][1:] != rows["around"][:-1])
    return new


REPEAT, SORT, GROUP = 0, 1, 2
_PACKS = "bucket int, kind int, payload binary"
_FOUND = "id long, mark long, at long, seed long, kind int"


def _found(rows: np.ndarray, kind: int | np.ndarray) -> pa.RecordBatch:
    n = len(rows)
    kinds = np.broadcast_to(np.asarray(kind, np.int32), n)
    columns = [pa.array(np.ascontiguousarray(rows[c])) for c in ("id", "mark", "at")]
    columns.append(pa.array(np.ascontiguousarray(rows["seed"]).view(np.int64)))
    return pa.RecordBatch.from_arrays([*columns, pa.array(kinds)], ["id", "mark", "at", "seed", "kind"])


def _pack_anchors(length: int, buckets: int):
    def pack(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        rows = _in_order(rows)
        first = _firsts(rows)
        # a later copy inside these rows is a later copy among all
        for kind, part in ((REPEAT, rows[~first]), (SORT, rows[first])):
            bucket = (part["seed"] % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
            used = np.flatnonzero(np.diff(edges))
            for low in range(0, len(used), 32):
                some = used[low : low + 32]
                payloads = [_packed(part[order[edges[b] : edges[b + 1]]]) for b in some]
                kinds = pa.array([kind] * len(some), pa.int32())
                columns = [pa.array(some, pa.int32()), kinds, pa.array(payloads, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["bucket", "kind", "payload"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, count = [], 0
        for batch in batches:
            for rows in _anchors_of(batch, length):
                waiting.append(rows)
                count += len(rows)
                if count >= PACK:
                    yield from pack(np.concatenate(waiting))
                    waiting, count = [], 0
        if count:
            yield from pack(np.concatenate(waiting))

    return run


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[bytes]]]:
    """(kind, payloads) of rows (bucket, kind, payload) ordered by bucket: repeats as they come, others by bucket."""
    current, payloads = None, []
    for batch in batches:
        for bucket, kind, payload in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if kind == REPEAT:
                yield kind, [payload]
                continue
            if bucket != current and payloads:
                yield SORT, payloads
                payloads = []
            current = bucket
            payloads.append(payload)
    if payloads:
        yield SORT, payloads


def _compare_anchors(most: int):
    """Later copies of equal surroundings, and the first of those whose seed has several."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kind, payloads in _by_bucket(batches):
            if kind == REPEAT:
                yield _found(_unpacked(payloads), REPEAT)
                continue
            rows = _in_order(_unpacked(payloads))
            first = _firsts(rows)
            yield _found(rows[~first], REPEAT)
            rows = rows[first]
            new = np.ones(len(rows), bool)
            new[1:] = rows["seed"][1:] != rows["seed"][:-1]
            sizes = np.diff(np.append(np.flatnonzero(new), len(rows)))
            several = np.repeat(sizes, sizes)
            kept = several > 1
            yield _found(rows[kept], np.where(several[kept] > most, GROUP, SORT))

    return run


# --- surroundings ---------------------------------------------------------------------------


def _surroundings(data: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes around anchors of a text, zeros outside of it, and the range of strings that are inside."""
    reach = length - SEED + 1
    width = reach - 1 + length
    padded = np.zeros(len(data) + 2 * width, np.uint8)
    padded[width : width + len(data)] = data
    rows = np.lib.stride_tricks.sliding_window_view(padded, width)[at - (reach - 1) + width]
    low = np.maximum(reach - 1 - at, 0)
    high = np.minimum(len(data) - length - (at - (reach - 1)), reach - 1)
    return rows, low, high


def _extract(length: int):
    """Surroundings of the anchors of each document: rows (seed, id, mark, at, kind, around, low, high)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                data = np.frombuffer(batch.column("text")[i].as_buffer(), np.uint8)
                wanted = batch.column("wanted")[i].values
                at, seed, kind = (wanted.field(c).to_numpy() for c in ("at", "seed", "kind"))
                for start in range(0, len(at), 4096):
                    part = slice(start, start + 4096)
                    # only the bytes that are needed are copied
                    order = np.argsort(at[part], kind="stable")
                    places = at[part][order]
                    first = max(int(places[0]) - 2 * length, 0)
                    rows, low, high = _surroundings(data[first : int(places[-1]) + 2 * length], places - first, length)
                    n = len(places)
                    offsets = pa.py_buffer(np.arange(n + 1, dtype=np.int32) * rows.shape[1])
                    around = pa.Array.from_buffers(pa.binary(), n, [None, offsets, pa.py_buffer(rows.tobytes())])
                    same = [pa.array([batch.column(c)[i].as_py()] * n, pa.int64()) for c in ("id", "mark")]
                    columns = [pa.array(seed[part][order]), *same, pa.array(places), pa.array(kind[part][order])]
                    columns += [around, pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32))]
                    yield pa.RecordBatch.from_arrays(columns, _AROUND_NAMES)

    return run


_AROUND_NAMES = ["seed", "id", "mark", "at", "kind", "around", "low", "high"]
_AROUND = "seed long, id long, mark long, at long, kind int, around binary, low int, high int"


def _word(rows: np.ndarray, at: int) -> np.ndarray:
    """Eight bytes of each row as a number that orders like them."""
    return np.ascontiguousarray(rows[:, at : at + 8]).view(">u8")[:, 0].astype(np.uint64)


def _words(rows: np.ndarray, low: int, high: int) -> list[np.ndarray]:
    """The bytes [low, high) of each row as words, the last of which may overlap others; at least eight bytes."""
    places = [*range(low, high - 7, 8)]
    if places[-1] + 8 < high:
        places.append(high - 8)
    return [_word(rows, p) for p in places]


def _dense(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(order, rank in that order) by keys, the first of them first; equal rows share a rank."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    for key in keys:
        ordered = key[order]
        new[1:] |= ordered[1:] != ordered[:-1]
    return order, np.cumsum(new)


def cover_places(length: int) -> list[int]:
    """Places of the difference cover at which surroundings hold a whole sample string."""
    last = (length - SEED) + length - (length - PERIOD + 1)
    return [p for p in range(last + 1) if p % PERIOD in COVER]


def repeated_strings(rows: np.ndarray, seeds: np.ndarray, low: np.ndarray, high: np.ndarray, length: int) -> np.ndarray:
    """Which strings of each row of surroundings, by distance, an earlier row of the same seed has too.

    Rows are in order of documents and places.
    """
    reach, sample = length - SEED + 1, length - PERIOD + 1
    ranks = {}
    for p in cover_places(length):
        order, rank = _dense(_words(rows, p, p + sample))
        ranks[p] = np.empty(len(rows), np.uint64)
        ranks[p][order] = rank
    places = np.array(cover_places(length))
    out = np.zeros((len(rows), reach), bool)
    for o in range(reach):
        held = np.flatnonzero((low <= o) & (o <= high))
        if len(held) < 2:
            continue
        first = int(places[places >= o][0]) if (places >= o).any() else int(places[-1])
        last = int(places[places <= o + PERIOD - 1][-1])
        ties = ranks[first][held] << np.uint64(32) | ranks[last][held]
        keys = [seeds[held], ties]
        # what the samples leave over at either side is less than the widest gap of the cover
        if first > o:
            keys += _words(rows[held], o, max(first, o + 8))
        if last + sample < o + length:
            keys += _words(rows[held], min(last + sample, o + length - 8), o + length)
        order, rank = _dense(keys)
        # stable: the first of equal strings is the earliest
        later = np.zeros(len(held), bool)
        later[1:] = rank[1:] == rank[:-1]
        out[held[order[later]], o] = True
    return out


def _sort_buckets(length: int):
    """Later copies of strings, as ranges (id, mark, low, high) of bytes, from surroundings ordered by bucket."""
    reach = length - SEED + 1

    def sort(batch: pa.Table) -> pa.RecordBatch:
        rows = np.frombuffer(b"".join(batch.column("around").to_pylist()), np.uint8).reshape(batch.num_rows, -1)
        columns = {c: batch.column(c).to_numpy() for c in ("seed", "id", "mark", "at", "low", "high")}
        order = np.lexsort((columns["at"], columns["mark"], columns["id"]))
        # equal documents have the same places
        places = [columns[c][order] for c in ("id", "mark", "at")]
        new = np.ones(len(order), bool)
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in places])
        order = order[new]
        rows, columns = rows[order], {c: v[order] for c, v in columns.items()}
        found = repeated_strings(rows, columns["seed"], columns["low"], columns["high"], length)
        edges = np.diff(np.pad(found, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        row, start = np.nonzero(edges == 1)
        _, end = np.nonzero(edges == -1)
        base = columns["at"][row] - (reach - 1)
        arrays = [columns["id"][row], columns["mark"][row], base + start, base + end - 1 + length]
        return pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], ["id", "mark", "low", "high"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, waiting = None, []
        for batch in batches:
            buckets = batch.column("bucket").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(buckets)) + 1).tolist(), len(buckets)]
            for low, high in zip(edges, edges[1:], strict=False):
                if low == high:
                    continue
                if waiting and buckets[low] != current:
                    yield sort(pa.Table.from_batches(waiting))
                    waiting = []
                current = buckets[low]
                waiting.append(batch.slice(low, high - low))
        if waiting:
            yield sort(pa.Table.from_batches(waiting))

    return run


def _grouped(around: DataFrame, length: int) -> DataFrame:
    """Later copies of strings of seeds with very many surroundings, by their digests."""
    reach = length - SEED + 1
    strings = around.where(F.col("kind") == GROUP).select(
        "id", "mark", "at", "around", F.explode(F.sequence("low", "high")).alias("o")
    )
    strings = strings.select(
        F.sha2(F.expr(f"substring(around, o + 1, {length})"), 256).alias("digest"),
        F.struct("id", "mark", (F.col("at") - (reach - 1) + F.col("o")).alias("low")).alias("place"),
    )
    first = strings.groupBy("digest").agg(F.min("place").alias("first"))
    later = strings.join(first, "digest").where("place > first")
    return later.select("place.id", "place.mark", "place.low", (F.col("place.low") + length).alias("high"))


# --- documents --------------------------------------------------------------------------------


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(LARGEST_ID))
    return docs.select("doc_id", key.alias("id"), F.xxhash64(text).alias("mark"), text.alias("text"))


def _of_documents(docs: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    """Documents joined with one row for each (id, mark) of them."""
    lists = lists.withColumnsRenamed({"id": "_id", "mark": "_mark"})
    return docs.join(lists, (F.col("id") == F.col("_id")) & (F.col("mark") == F.col("_mark")), how).drop("_id", "_mark")


def repeated_ranges(docs: DataFrame, length: int = LENGTH, most: int = MOST) -> DataFrame:
    """(id, mark, low, high): ranges of bytes that later copies of strings cover; they may overlap and reach over ends."""
    if length < SEED + PERIOD or length < 2 * PERIOD + 8:
        raise ValueError(f"strings have at least {SEED + PERIOD} bytes")
    keyed = _keyed(docs).select("id", "mark", "text").where(F.octet_length("text") >= length)
    size = keyed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(8, -(-size // BUCKET_BYTES))
    tasks = max(8, buckets // TASK_BUCKETS)
    packed = keyed.mapInArrow(_pack_anchors(length, buckets), _PACKS).repartition(tasks, "bucket")
    compared = stored(
        packed.sortWithinPartitions("bucket").mapInArrow(_compare_anchors(most), _FOUND), "suffix-compared"
    )
    wanted = compared.where(F.col("kind") != REPEAT).groupBy("id", "mark")
    wanted = wanted.agg(F.collect_list(F.struct("at", "seed", "kind")).alias("wanted"))
    around = _of_documents(keyed, wanted, "inner").mapInArrow(_extract(length), _AROUND)
    to_group = not compared.where(F.col("kind") == GROUP).isEmpty()
    if to_group:
        around = stored(around, "suffix-around")
    to_sort = around.where(F.col("kind") == SORT).withColumn("bucket", F.pmod("seed", F.lit(buckets)).cast("int"))
    to_sort = to_sort.repartition(tasks, "bucket").sortWithinPartitions("bucket")
    found = to_sort.mapInArrow(_sort_buckets(length), "id long, mark long, low long, high long")
    copies = compared.where(F.col("kind") == REPEAT)
    copies = copies.select("id", "mark", (F.col("at") - (length - SEED)).alias("low"), (F.col("at") + length).alias("high"))
    found = copies.unionByName(found)
    return found.unionByName(_grouped(around, length)) if to_group else found


def merged(low: np.ndarray, high: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Ranges that overlap or touch put together, inside a text of ``size`` bytes."""
    order = np.argsort(low, kind="stable")
    low, high = np.maximum(low[order], 0), np.minimum(np.maximum.accumulate(high[order]), size)
    new = np.ones(len(low), bool)
    new[1:] = low[1:] > high[:-1]
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(low)) - 1
    return low[starts], high[ends[: len(starts)]]


def with_repeats(docs: DataFrame, length: int = LENGTH, most: int = MOST) -> DataFrame:
    """``docs`` as (doc_id, text, repeats): the ranges (low, high) that its text loses, as bytes, merged or not."""
    ranges = stored(repeated_ranges(docs, length, most).distinct(), "suffix-ranges")
    lists = ranges.groupBy("id", "mark").agg(F.collect_list(F.struct("low", "high")).alias("repeats"))
    return _of_documents(_keyed(docs), lists, "left").select("doc_id", "text", "repeats")


def digests(found: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of ``with_repeats``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = np.zeros((3, batch.num_rows), np.int64)
            shas = []
            for i in range(batch.num_rows):
                text = memoryview(batch.column(1)[i].as_buffer())
                numbers[0, i] = len(text)
                digest, at = hashlib.sha256(), 0
                ranges = batch.column(2)[i]
                if ranges.is_valid:
                    low, high = (ranges.values.field(c).to_numpy() for c in ("low", "high"))
                    low, high = merged(low, high, len(text))
                    numbers[1, i], numbers[2, i] = (high - low).sum(), len(low)
                    for start, end in zip(low.tolist(), high.tolist(), strict=True):
                        digest.update(text[at:start])
                        at = end
                digest.update(text[at:])
                shas.append(digest.hexdigest())
            columns = [batch.column(0), *map(pa.array, numbers), pa.array(shas, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    kind = dict(found.dtypes)["doc_id"]
    return found.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")

"""Substring dedup: paragraphs that repeat in other documents, by MinHash banding.

A paragraph is a line of ``LEAST`` words or more. Words are runs of characters other
than ASCII blanks, A-Z lower-cased. Paragraphs are sets of 5-word shingles; equal
lines are one class. Each of ``BANDS`` bands is ``ROWS`` minwise shingles of a class;
classes of similarity 0.8 share a bucket with probability 1 - (1 - 0.8 ** 3) ** 8 =
0.9968. In every bucket all classes are paired with its least one. Classes of
buckets with three or more also go through a prefix filter: two sets of similarity
0.8 share one of the 0.2 n + 1 rarest shingles of each, and all classes with such
a shingle are paired with the least of them. Where such classes are still in different
components, each is first paired with ``HEADS`` more of them, chosen by a hash, which joins most of a
large group; then all pairs of different components that are left are taken, so no link between
classes that went through the filter is lost. These are dealt in squares of ``BLOCK`` times ``BLOCK`` classes, and
those are left out whose sizes or places in the order of rarity rule out a similarity of 0.8. Pairs are
confirmed by exact Jaccard similarity of their shingles, and confirmed links are joined to components.

Passages that are no paragraphs of their own are found by windows of ``LENGTH`` words,
over lines' ends too, that start at words chosen by content: those whose hash with
the next two is the least in some ``REACH`` places in a row. Two documents that share any
run of ``LENGTH + REACH - 1`` = 51 words therefore share a whole window of it, wherever
it stands. Windows are compared for equality only.

A component, or a window, that occurs in two documents or more is a repeat. It stays in
the document of smallest id and is removed from the others; overlapping ones are one span.
Repeats inside one document stay.

Windows are samples, so they only find a shared passage; its extent is then taken
word by word. Beyond both ends of each row of touching repeated windows, all runs of
``LENGTH`` words that start up to ``AROUND`` words away are looked up among those at the same
windows of other documents, and those that an earlier document has as well are removed too.
Chosen places are at most ``REACH`` apart where a text has so many, and the first and last
of a shared passage less than ``REACH`` from its ends, so no word of the passage is left.

Words, shingles and classes are compared by 64-bit hashes.

Defined cases: null and empty texts have no paragraphs and stay as they are; rows
with null doc_id teach nothing and stay as they are; rows of one doc_id count as
one document; texts and lines of any length are whole. Other columns are kept as they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.common import MIX_1, fresh, mix, seeds, shingle_hashes, steps, stored, words_of
from eventloom.llm.graph import components

LEAST = 20
LENGTH, REACH = 24, 28
SHINGLE = 5
BANDS, ROWS = 8, 3
HEADS = 16
BLOCK = 256
#: Rows and paragraphs of a side that may be sent to all tasks (some 32 bytes of the driver's memory each); a larger one is joined by shuffle.
SENT_ROWS, SENT_PLACES = 250_000, 1_000_000
#: Ids alone that may be sent, so that texts of other documents stay out of a shuffle.
SENT_IDS = 1_000_000
AROUND = REACH - 1

_SEEDS = seeds(BANDS * ROWS, 1618033988)
_BUCKETS = [f"bucket_{band}" for band in range(BANDS)]
_BLANKS = re.compile(rb"[^\x20\x09-\x0D]+")
_MOST = np.uint64(2**64 - 1)


def _sliding(values: np.ndarray, width: int, take) -> np.ndarray:
    """``take`` (minimum or maximum) of each ``width`` values in a row, in steps of doubled width."""
    done = 1
    while done < width:
        more = min(done, width - done)
        values = take(values[: len(values) - more], values[more:])
        done += more
    return values


def _inside(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers ``starts`` to ``starts + sizes - 1``, one row behind the other, and where each row begins."""
    begins = np.cumsum(sizes) - sizes
    return np.repeat(starts - begins, sizes) + np.arange(int(sizes.sum())), begins


class Paragraphs:
    """Lines and windows of some texts: text, number of the first word, key, and size of the lines."""

    def __init__(self, texts: list[bytes]):
        data = b"\n".join(texts).lower()
        self.words, offsets = words_of(data)
        lengths = np.array([len(t) + 1 for t in texts], np.int64)
        self.first = np.searchsorted(offsets, np.cumsum(lengths) - lengths)  # number of each text's first word
        self.count = np.diff(np.append(self.first, len(self.words)))
        self.owner = np.repeat(np.arange(len(texts)), self.count)
        line = np.searchsorted(np.flatnonzero(np.frombuffer(data, np.uint8) == 10), offsets)
        begins = np.flatnonzero(np.diff(line, prepend=-1))
        sizes = np.diff(np.append(begins, len(self.words)))
        self.begins, self.sizes = begins[sizes >= LEAST], sizes[sizes >= LEAST]
        self.text = self.owner[self.begins]
        self.start = self.begins - self.first[self.text]
        self.key = self._line_keys()

    def _line_keys(self) -> np.ndarray:
        if not len(self.begins):
            return np.empty(0, np.uint64)
        at, rows = _inside(self.begins, self.sizes)
        place = (at - np.repeat(self.begins, self.sizes) + 1).astype(np.uint64)
        sums = np.add.reduceat(mix(self.words[at] ^ place * np.uint64(MIX_1)), rows)
        return mix(sums + self.sizes.astype(np.uint64))

    def shingles(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Shingles of some lines, one line behind the other, and where each one's begin."""
        at, begins = _inside(self.begins[rows], self.sizes[rows] - SHINGLE + 1)
        return shingle_hashes(self.words, SHINGLE)[at], begins

    def runs(self, at: np.ndarray) -> np.ndarray:
        """Hashes of the ``LENGTH`` words from each of some numbers on."""
        out = np.full(len(at), np.uint64(LENGTH))
        for k in range(LENGTH):
            out = mix(out * np.uint64(3) + self.words[at + k])
        return out

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, start, key) of the windows."""
        room = np.maximum(self.count - LENGTH + 1, 0)  # places in each text
        if not room.any():
            return self.text[:0], self.start[:0], self.key[:0]
        at = self._starts(self.words, self.count, room, self.owner)
        return self.owner[at], at - self.first[self.owner[at]], self.runs(at)

    def _starts(self, words: np.ndarray, count: np.ndarray, room: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Numbers of the words, over all texts, at which windows start."""
        place = np.arange(len(words)) - self.first[owner]
        good = place < room[owner]
        marks = np.full(len(words), _MOST)
        marks[: len(words) - 2] = mix(shingle_hashes(words, 3) ^ np.uint64(5))
        marks[~good] = _MOST
        chosen = np.zeros(len(words), bool)
        if (room >= REACH).any():
            whole = place[: len(words) - REACH + 1] + REACH <= room[owner[: len(words) - REACH + 1]]
            least = np.where(whole, _sliding(marks, REACH, np.minimum), np.uint64(0))
            edge = np.zeros(REACH - 1, np.uint64)
            # a place is chosen if it is the least of some window, that is, of the one with the largest least
            chosen |= _sliding(np.concatenate((edge, least, edge)), REACH, np.maximum) == marks
        short = (room > 0) & (room < REACH)
        if short.any():
            filled = np.flatnonzero(count)
            lowest = np.zeros(len(count), np.uint64)
            lowest[filled] = np.minimum.reduceat(marks, self.first[filled])
            chosen |= short[owner] & (marks == lowest[owner])
        return np.flatnonzero(chosen & good)

    def around(self, text: int, places: np.ndarray, before: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the runs of ``LENGTH`` words before and after some places of a text, and the hashes of the runs."""
        away = np.arange(1, AROUND + 1)
        near = np.concatenate(((places[before][:, None] - away).ravel(), (places[after][:, None] + away).ravel()))
        near = np.unique(near[(near >= 0) & (near <= self.count[text] - LENGTH)])
        return near, self.runs(self.first[text] + near)


def _in_steps(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, Paragraphs]]:
    for batch in batches:
        for low, high in steps(batch.column(column)):
            part = batch.slice(low, high - low)
            yield part, Paragraphs([(t.as_py() or "").encode() for t in part.column(column)])


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, doc_id, place, size, line) of all lines and windows."""
    for batch, found in _in_steps(batches, 1):
        text, start, key = found.windows()
        docs = batch.column(0).take(pa.array(np.concatenate((found.text, text))))
        line = np.arange(len(docs)) < len(found.text)
        columns = [
            pa.array(np.concatenate((found.key, key)).view(np.int64)),
            docs,
            pa.array(np.concatenate((found.start, start)).astype(np.int32)),
            pa.array(np.concatenate((found.sizes, np.full(len(text), LENGTH))).astype(np.int32)),
            pa.array(line),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["key", "doc_id", "place", "size", "line"])


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, bucket_0, bucket_1, ...) of all lines; copies within a step once."""
    for _, found in _in_steps(batches, 0):
        keys, rows = np.unique(found.key, return_index=True)
        columns = [pa.array(keys.view(np.int64))]
        shingles, begins = found.shingles(rows) if len(rows) else (keys, keys)
        for band in range(BANDS):
            bucket = np.full(len(keys), np.uint64(band))
            for seed in _SEEDS[band * ROWS : (band + 1) * ROWS] if len(rows) else ():
                bucket = mix(bucket ^ mix(np.minimum.reduceat((shingles ^ (seed >> np.uint64(7))) * seed, begins)))
            columns.append(pa.array(bucket.view(np.int64)))
        yield pa.RecordBatch.from_arrays(columns, ["key", *_BUCKETS])


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, shingles) of the lines at ``places`` of each text."""
    for batch, found in _in_steps(batches, 0):
        places = batch.column(1)
        wanted = np.repeat(np.arange(len(batch)), places.value_lengths().to_numpy()) << 32 | places.flatten().to_numpy()
        rows = np.flatnonzero(np.isin(found.text << 32 | found.start, wanted))
        values, begins = found.shingles(rows) if len(rows) else (found.key, rows)
        sets = [np.unique(x).view(np.int64) for x in np.split(values, begins[1:])] if len(rows) else []
        columns = [pa.array(found.key[rows].view(np.int64)), pa.array(sets, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["key", "shingles"])


def _around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(run, doc_id, place) of the runs of ``LENGTH`` words before and after ``places`` of each text."""
    for batch, found in _in_steps(batches, 1):
        for i, places in enumerate(batch.column(2)):
            at, before, after = (places.values.field(k).to_numpy(zero_copy_only=False) for k in range(3))
            near, runs = found.around(i, at, before, after)
            docs = pa.repeat(batch.column(0)[i], len(near))
            columns = [pa.array(runs.view(np.int64)), docs, pa.array(near.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["run", "doc_id", "place"])


def _small(found: DataFrame) -> DataFrame:
    """``found`` (with ``places``), marked to be sent to all tasks if it is small enough for that."""
    found = stored(found, "found")
    return F.broadcast(found) if _fits(found) else found


def _fits(found: DataFrame) -> bool:
    size = found.agg(F.count("*").alias("rows"), F.sum(F.size("places")).alias("places")).first()
    return size.rows <= SENT_ROWS and (size.places or 0) <= SENT_PLACES


def _with_places(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``found`` (one row per doc_id) has places for, with these.

    If ``found`` is too large to be sent, its ids may still be: texts of other documents then stay out of the shuffle.
    """
    found = stored(found, "found").withColumnRenamed("doc_id", "named")
    same = F.col("doc_id") == F.col("named")
    if _fits(found):
        return docs.join(F.broadcast(found), same).drop("named")
    if found.count() <= SENT_IDS:
        docs = docs.join(F.broadcast(found.select("named")), same, "left_semi")
    return docs.join(found, same).drop("named")


def _candidates(docs: DataFrame, places: DataFrame, classes: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Lines that may be similar: (a, b) in buckets, (token, key) of prefixes, and the sets (key, shingles) of all.

    ``classes`` has the first document of each key.
    """
    sketches = docs.select("text").mapInArrow(_sketches, ", ".join(f"{c} long" for c in ["key", *_BUCKETS]))
    sketches = stored(sketches.groupBy("key").agg(*[F.min(c).alias(c) for c in _BUCKETS]), "sketches")
    rows = sketches.select("key", F.explode(F.array(*_BUCKETS)).alias("bucket"))
    heads = rows.groupBy("bucket").agg(F.min("key").alias("head"), F.count("*").alias("n")).where("n > 1")
    met = stored(rows.join(heads, "bucket").select("key", "head", F.col("n") > 2), "met").toDF("key", "head", "crowded")
    keys = met.groupBy("key").agg(F.max("crowded").alias("crowded"))
    wanted = classes.join(keys, "key").select("key", "crowded", F.col("first").alias("doc_id"))
    wanted = places.where("line").join(wanted, ["key", "doc_id"]).groupBy("key", "doc_id").agg(F.min("place").alias("place"))
    texts = _with_places(docs, wanted.groupBy("doc_id").agg(F.collect_list("place").alias("places")))
    contents = texts.select("text", "places").mapInArrow(_contents, "key long, shingles array<long>")
    contents = stored(contents.dropDuplicates(["key"]), "contents")
    tokens = keys.where("crowded").join(contents, "key").select("key", F.explode("shingles").alias("token"))
    counted = tokens.join(tokens.groupBy("token").agg(F.count("*").alias("n")), "token").where("n > 1")
    sizes = contents.select("key", F.size("shingles").alias("size"))
    # shingles of one set only come first in the order of all and find nothing
    ranked = counted.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("n", "token"))).alias("ranked"))
    prefix = F.expr("size - ceil(0.8BD * size) + 1 - (size - size(ranked))")
    ranked = ranked.join(sizes, "key").withColumn("prefix", F.greatest(prefix, F.lit(0)).cast("int"))
    # shingles of this set only are in front of all others
    own = F.col("size") - F.size("ranked")
    ranked = ranked.select("key", "size", own.alias("own"), F.posexplode(F.slice("ranked", F.lit(1), "prefix")["token"]).alias("at", "token"))
    ranked = stored(ranked.select("token", "key", "size", (F.col("own") + F.col("at")).alias("at")), "prefixes")
    return met.where("head <> key").select(F.col("head").alias("a"), F.col("key").alias("b")), ranked, contents


def _similar(pairs: DataFrame, contents: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) whose sets are similar."""
    pairs, sizes = pairs.distinct(), contents.select("key", F.size("shingles").alias("size"))
    for x in "ab":
        pairs = pairs.join(sizes.toDF(x, f"size_{x}"), x)
    pairs = pairs.where("100 * least(size_a, size_b) >= 80 * greatest(size_a, size_b)").select("a", "b")
    for x in "ab":
        pairs = pairs.join(contents.toDF(x, f"set_{x}"), x)
    common = F.size(F.array_intersect("set_a", "set_b"))
    pairs = pairs.where(100 * common >= 80 * (F.size("set_a") + F.size("set_b") - common))
    return stored(pairs.select("a", "b"), "similar")


def _mixed(tokens: DataFrame, part: DataFrame) -> DataFrame:
    """``tokens`` with the component (``part``) of each class, of those shared by classes of several components."""
    named = tokens.join(part, F.col("key") == F.col("node"), "left").drop("node")
    named = stored(named.withColumn("part", F.coalesce("component", "key")).drop("component"), "named")
    shared = named.groupBy("token").agg(F.min("part").alias("low"), F.max("part").alias("high"), F.count("*").alias("n"))
    return named.join(shared.where("low < high").select("token", "n"), "token")


def _apart(mixed: DataFrame) -> DataFrame:
    """(a, b) of all classes of ``mixed`` (of ``_mixed``) that share a token, are of different components and may be similar.

    A token's classes are dealt to blocks of about ``BLOCK``, and its pairs to tasks by two blocks.
    """
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    dealt = mixed.withColumn("block", F.pmod(F.xxhash64("key", "token"), blocks).cast("int")).withColumn("blocks", blocks)
    first = F.explode(F.sequence("block", F.col("blocks") - 1))
    second = F.explode(F.sequence(F.lit(0), "block"))
    columns = ["key", "size", "at", "part"]
    left = dealt.select("token", F.col("block").alias("i"), first.alias("j"), *[F.col(c).alias(f"{c}_a") for c in columns])
    right = dealt.select("token", second.alias("i"), F.col("block").alias("j"), *[F.col(c).alias(f"{c}_b") for c in columns])
    pairs = left.join(right, ["token", "i", "j"]).where("part_a <> part_b and (i < j or key_a < key_b)")
    pairs = pairs.where("100 * least(size_a, size_b) >= 80 * greatest(size_a, size_b)")
    # shingles in common are at most the rest of either set from the first one in common on
    pairs = pairs.where("180 * least(size_a - at_a, size_b - at_b) >= 80 * (size_a + size_b)")
    return pairs.select(F.least("key_a", "key_b").alias("a"), F.greatest("key_a", "key_b").alias("b"))


def _linked(docs: DataFrame, places: DataFrame, classes: DataFrame) -> DataFrame:
    """(node, component) of the keys of lines that are linked to others, as in ``components``."""
    pairs, tokens, contents = _candidates(docs, places, classes)
    least = tokens.groupBy("token").agg(F.min("key").alias("a"))
    stars = tokens.join(least, "token").where("a <> key").select("a", F.col("key").alias("b"))
    part = components(_similar(pairs.unionByName(stars), contents))

    def joined(more: DataFrame) -> DataFrame:
        # parts stand for what was linked before
        return components(more.unionByName(part.toDF("a", "b"))) if more.head(1) else part

    named = stored(_mixed(tokens, part), "mixed")
    order = Window.partitionBy("token").orderBy(F.xxhash64("token", "key"), "key")
    large = named.where(F.col("n") > HEADS + 1)
    heads = large.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= HEADS)
    heads = heads.select("token", F.col("key").alias("a"), F.col("part").alias("part_a"))
    more = large.join(heads, "token").where("part <> part_a")
    more = more.select(F.least("a", "key").alias("a"), F.greatest("a", "key").alias("b"))
    if large.head(1):
        part = joined(_similar(more, contents))
        named = stored(_mixed(named.select(tokens.columns), part), "mixed")
    return joined(_similar(_apart(named), contents))


def repeats(docs: DataFrame) -> DataFrame:
    """(key, doc_id, source, place, size, line) of all lines and windows that occur in two documents or more.

    ``source`` is the smallest id of a document with the line, or one similar to it,
    or with the window; ``place`` is the number of the word at which it starts in
    ``doc_id``, ``size`` its words.
    """
    docs = docs.select("doc_id", "text").where("doc_id is not null and text is not null")
    places = stored(docs.mapInArrow(_places, "key long, doc_id long, place int, size int, line boolean"), "places")
    classes = places.groupBy("line", "key").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    classes = stored(classes.where("line or first < last"), "paragraphs")
    lines = classes.where("line").drop("line")
    found = _linked(docs, places, lines)
    linked = found.select("component").distinct().withColumn("node", F.col("component")).unionByName(found)
    linked = linked.join(lines, F.col("node") == F.col("key")).select("component", "key", "first", "last")
    linked = stored(linked, "linked")
    sources = linked.groupBy("component").agg(F.min("first").alias("source"), F.max("last").alias("until"))
    near = linked.join(sources.where("source < until"), "component").select("key", "source")
    alone = lines.where("first < last").join(linked.select("key"), "key", "left_anti")
    shared = near.unionByName(alone.select("key", F.col("first").alias("source"))).withColumn("line", F.lit(True))
    windows = classes.where("not line and first < last").select("key", F.col("first").alias("source"), "line")
    shared = stored(shared.unionByName(windows), "shared")
    return places.join(shared, ["line", "key"]).select("key", "doc_id", "source", "place", "size", "line")


def extended(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(doc_id, source, place, size) of all runs of words beyond the windows ``found`` (of ``repeats``) that an earlier document has.

    ``source`` is the smallest id of a document with the run near one of its repeats.
    """
    docs = docs.select("doc_id", "text").where("doc_id is not null and text is not null")
    windows = found.where("not line").select("key", "doc_id", "place", "source")
    order = Window.partitionBy("doc_id").orderBy("place")
    ends = windows.where("source < doc_id").select("doc_id", "key", "place").distinct()
    ends = ends.select(
        "key",
        F.coalesce(F.col("place") - F.lag("place").over(order) > LENGTH, F.lit(True)).alias("before"),
        F.coalesce(F.lead("place").over(order) - F.col("place") > LENGTH, F.lit(True)).alias("after"),
    )
    ends = ends.where("before or after").groupBy("key").agg(F.max("before").alias("before"), F.max("after").alias("after"))
    places = windows.join(ends, "key").groupBy("doc_id")
    texts = _with_places(docs, places.agg(F.collect_set(F.struct("place", "before", "after")).alias("places")))
    near = stored(texts.mapInArrow(_around, "run long, doc_id long, place int"), "around")
    shared = near.groupBy("run").agg(F.min("doc_id").alias("source"), F.max("doc_id").alias("last"))
    near = near.join(shared.where("source < last"), "run").where("source < doc_id")
    return near.select("doc_id", "source", "place", F.lit(LENGTH).alias("size"))


def spans_of(places: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Word ranges covered by the (place, size) of ``places``."""
    spans: list[list[int]] = []
    for at, size in sorted(places):
        if spans and at <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], at + size)
        else:
            spans.append([at, at + size])
    return [tuple(s) for s in spans]


def without(text: str, places: list[tuple[int, int]]) -> tuple[str, int]:
    """``text`` less the paragraphs at ``places``, and the number of words removed."""
    data = text.encode()
    bounds = [m.span() for m in _BLANKS.finditer(data)]
    kept, at, words = [], 0, 0
    for first, end in spans_of(places):
        kept.append(data[at : bounds[first][0]])
        at = bounds[end - 1][1]
        words += end - first
        if kept[-1][-1:].isspace() and data[at : at + 1].isspace():
            at += 1
    return b"".join([*kept, data[at:]]).decode(), words


def _spans(places: Column) -> Column:
    """The (place, size) of ``places`` with those that overlap or touch as one, as in ``spans_of``."""
    span = pa.struct([("place", pa.int32()), ("size", pa.int32())])

    @F.arrow_udf("array<struct<place: int, size: int>>")
    def joined(places: pa.Array) -> pa.Array:
        text = np.repeat(np.arange(len(places)), places.value_lengths().to_numpy())
        flat = places.flatten()
        at, size = (flat.field(k).to_numpy().astype(np.int64) for k in range(2))
        order = np.lexsort((at, text))
        text, at, size = text[order], at[order], size[order]
        # texts one behind the other, further apart than any place reaches
        starts = at + (text << 32)
        ends = np.maximum.accumulate(starts + size)
        first = np.flatnonzero(np.diff(text, prepend=-1).astype(bool) | (starts > np.concatenate((starts[:1], ends[:-1]))))
        sizes = ends[np.append(first[1:], len(ends)) - 1] - starts[first] if len(first) else first
        found = [pa.array(x.astype(np.int32)) for x in (at[first], sizes)]
        offsets = pa.array(np.searchsorted(text[first], np.arange(len(places) + 1)).astype(np.int32))
        return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(found, fields=list(span)))

    return joined(places)


def members(docs: DataFrame) -> DataFrame:
    """Per document with a repeated paragraph: (doc_id, sources, places to be removed).

    A long passage is found at each of its words. Its places are one before they are sent to all tasks.
    """
    found = stored(repeats(docs), "repeats")
    found = found.select("doc_id", "source", "place", "size").unionByName(extended(docs, found))
    removed = F.collect_set(F.when(F.col("source") != F.col("doc_id"), F.struct("place", "size")))
    found = found.groupBy("doc_id").agg(F.array_sort(F.collect_set("source")).alias("sources"), removed.alias("places"))
    return _small(found.withColumn("places", _spans(F.col("places"))))


def _pairs(places: pa.ListScalar) -> list[tuple[int, int]]:
    if not places.is_valid:
        return []
    return list(zip(*(places.values.field(k).to_pylist() for k in range(2)), strict=True))


def _removed(text: str, places: str) -> Column:
    """(text, words, spans) columns: the text less the paragraphs at ``places``, and how many words and spans went."""
    kind = pa.struct([("text", pa.string()), ("words", pa.int64()), ("spans", pa.int64())])

    @F.arrow_udf("struct<text: string, words: long, spans: long>")
    def removed(texts: pa.Array, places: pa.Array) -> pa.Array:
        found = [
            (t, 0, 0) if t is None or not at else (*without(t, at), len(spans_of(at)))
            for t, at in zip(texts.to_pylist(), map(_pairs, places), strict=True)
        ]
        return pa.array([dict(zip(("text", "words", "spans"), f, strict=True)) for f in found], kind)

    return removed(text, places)


def remove_repeats(docs: DataFrame, found: DataFrame) -> DataFrame:
    """All rows of ``docs`` with the paragraphs that ``found`` (of ``members``) names removed from their texts."""
    key, places = fresh("found_id", docs), fresh("found_places", docs)
    found = found.withColumnsRenamed({"doc_id": key, "places": places}).drop("sources")
    joined = docs.join(found, F.col("doc_id") == F.col(key), "left")
    cleaned = F.when(F.size(places) > 0, _removed("text", places)["text"]).otherwise(F.col("text"))
    return joined.select(*[cleaned.alias(c) if c == "text" else F.col(c) for c in docs.columns])


def removals(docs: DataFrame) -> DataFrame:
    """Per document with a repeated paragraph: what its text loses, and to which documents."""
    rows = docs.select("doc_id", "text").join(members(docs), "doc_id")
    rows = rows.withColumn("found", _removed("text", "places"))
    return rows.select(
        "doc_id",
        "sources",
        F.col("found.spans").alias("paragraphs_removed"),
        F.col("found.words").alias("words_removed"),
        F.sha2("found.text", 256).alias("text_sha256"),
    )

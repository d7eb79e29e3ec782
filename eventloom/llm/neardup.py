"""Near-duplicate documents by a chosen-path set similarity join.

A document is the set of its distinct 2-word shingles. Documents with equal sets
are one class. Each of ``TREES`` independent trees branches the classes: on every
level a class follows its minwise shingle under the hash function of that tree
and level, until it stands in a node of at most ``SMALL`` classes or on the last
of ``LEVELS`` levels. Small nodes are compared exhaustively. Two classes of
similarity 0.8 stay together in one tree with probability 0.8 per level, and most
nodes are small after one or two, so with 12 trees a link is missed in about one
of 10**6 cases; where all nodes stay large to the last level, in one of 500.

Every document first names the one that resembles it most in its nodes, by equal
minwise values; in a large node it is compared with those only that do not closely
resemble an earlier one. Naming gives no more than one candidate a document and
tree; the best is confirmed on full sets, and most groups are one component then.
Links inside a component change nothing, so from here on only members of different
components are compared: in small nodes those with at least ``LEAST_EQUAL`` of 48
values equal (a pair of similarity 0.8 has fewer in about one of 3 * 10**7 cases),
confirmed on full sets; in large nodes all members outside the node's largest
component with all others, set against set, in blocks of ``BLOCK``.

Shingles are compared by 64-bit hashes, classes by 128-bit digests of their sets.

Defined cases: null and empty texts, and texts of blanks, have the empty set and
are linked with nothing; one word is a set of one. Rows with one doc_id are
judged each by its own text. Rows with null doc_id take part, but name no
component; a component of such rows only is null, and keeps them.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import mix, seeds, shingle_hashes, stored, word_hashes
from eventloom.llm.graph import components

SHINGLE = 2
TREES, LEVELS = 12, 4
SMALL = 24
LEAST_EQUAL = 23  # of 48 values: worth confirming
CLOSE_EQUAL = 41  # of 48 values: stands behind the other one
BLOCK = 256

_SEEDS = seeds(TREES * LEVELS, 2718281828)
SKETCH = "doc_id long, n_shingles long, set_key binary, sketch binary, " + ", ".join(
    f"level{i} array<long>" for i in range(1, LEVELS + 1)
)
FOUND = "a binary, b binary, equal int"
LINKS = "a binary, b binary"


def shingles(text: str | None) -> np.ndarray:
    """Sorted hashes of the distinct shingles; A-Z are lower-cased first."""
    return np.unique(shingle_hashes(word_hashes((text or "").encode().lower()), SHINGLE))


def key_of(members: np.ndarray) -> bytes:
    return blake2b(members.tobytes(), digest_size=16).digest() if len(members) else b""


def minwise(members: np.ndarray) -> np.ndarray:
    """Least value of the members under each hash function."""
    least = np.full(len(_SEEDS), np.iinfo(np.uint64).max, np.uint64)
    for low in range(0, len(members), 4096):
        part = (members[low : low + 4096, None] ^ _SEEDS[None, ::-1]) * _SEEDS[None, :]
        np.minimum(least, part.min(axis=0), out=least)
    return mix(least)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    trees = mix(np.arange(1, TREES + 1, dtype=np.uint64))
    for batch in batches:
        ids, rows = batch.column(0), []
        for text in batch.column(1):
            members = shingles(text.as_py())
            values = minwise(members).reshape(LEVELS, TREES)
            nodes, levels = trees, []
            for level in range(LEVELS):
                nodes = mix(nodes ^ values[level])
                levels.append(nodes.astype(np.int64))
            rows.append((len(members), key_of(members), (values & np.uint64(255)).astype(np.uint8).tobytes(), levels))
        arrays = [ids, pa.array([r[0] for r in rows], pa.int64())]
        arrays += [pa.array([r[k] for r in rows], pa.binary()) for k in (1, 2)]
        for level in range(LEVELS):
            flat = np.concatenate([r[3][level] for r in rows]) if rows else np.empty(0, np.int64)
            offsets = np.arange(len(rows) + 1, dtype=np.int32) * TREES
            arrays.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)))
        names = ["doc_id", "n_shingles", "set_key", "sketch"] + [f"level{i}" for i in range(1, LEVELS + 1)]
        yield pa.RecordBatch.from_arrays(arrays, names)


def _leaves(classes: DataFrame) -> DataFrame:
    """(node, deep, set_key) of the nodes in which classes come to rest with another one."""
    levels = [f"level{i}" for i in range(1, LEVELS + 1)]
    rows = classes.select("set_key", F.explode(F.arrays_zip(*levels)).alias("at")).select("set_key", "at.*")
    leaves = None
    for i, level in enumerate(levels):
        last = i == LEVELS - 1
        counts = rows.groupBy(level).agg(F.count("*").alias("members")).where("members > 1")
        met = rows.join(counts, level)
        if not last:
            met = stored(met, "branches")
        rest = met if last else met.where(F.col("members") <= SMALL)
        found = rest.select(F.col(level).alias("node"), (F.col("members") > SMALL).alias("deep"), "set_key")
        leaves = found if leaves is None else leaves.unionByName(found)
        rows = met.where(F.col("members") > SMALL).select("set_key", *levels[i + 1 :])
    return leaves


class _Node:
    """Members of a node that later ones are compared with, in arrays that grow."""

    def __init__(self):
        self.keys: list[bytes] = []
        self.of: list[bytes] = []
        self.sizes, self.values = np.zeros(64, np.int64), np.zeros((64, len(_SEEDS)), np.uint8)

    def add(self, key: bytes, of: bytes, size: int, values: np.ndarray) -> None:
        if len(self.keys) == len(self.sizes):
            self.sizes, self.values = np.resize(self.sizes, 2 * len(self.sizes)), np.vstack((self.values, self.values))
        self.sizes[len(self.keys)], self.values[len(self.keys)] = size, values
        self.keys.append(key)
        self.of.append(of)

    def near(self, size: int, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the members that may be linked with one of this size and these values, and their equal values."""
        n = len(self.keys)
        equal = (self.values[:n] == values).sum(axis=1)
        sizes = self.sizes[:n]
        fits = (equal >= LEAST_EQUAL) & (100 * np.minimum(sizes, size) >= 80 * np.maximum(sizes, size))
        found = np.flatnonzero(fits)
        return found, equal[found]


def _compare(batches: Iterator[pa.RecordBatch], all_apart: bool) -> Iterator[pa.RecordBatch]:
    """Candidate pairs of rows sorted by node: the nearest one of each member, or with ``all_apart`` all of other components."""
    at, node = None, _Node()
    for batch in batches:
        out = []
        for row_node, deep, key, of, size, sketch in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row_node != at:
                at, node = row_node, _Node()
            values = np.frombuffer(sketch, np.uint8)
            found, equal = node.near(size, values) if node.keys else ((), ())
            if all_apart:
                out += [(node.keys[i], key, int(e)) for i, e in zip(found, equal, strict=True) if node.of[i] != of]
            elif len(found):
                best = int(np.argmax(equal))
                out.append((node.keys[found[best]], key, int(equal[best])))
            if not (deep and len(found) and max(equal) >= CLOSE_EQUAL):
                node.add(key, of, size, values)
        columns = list(zip(*out, strict=True)) if out else [()] * 3
        kinds = (pa.binary(), pa.binary(), pa.int32())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["a", "b", "equal"]
        )


def _nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _compare(batches, False)


def _all_apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _compare(batches, True)


def _in_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A link for each two components that have one between the two blocks of a row, by exact sets."""
    for batch in batches:
        links = set()
        for row in batch.to_pylist():
            sides = []
            for side in ("outside", "members"):
                sets = [np.frombuffer(m["shingles"], np.uint64) for m in row[side]]
                sides.append((row[side], sets, np.array([len(x) for x in sets])))
            (outside, mine, _), (members, theirs, sizes) = sides
            names, places = np.unique(np.concatenate(theirs), return_inverse=True)
            starts = np.cumsum(sizes) - sizes
            for x, own in zip(outside, mine, strict=True):
                at = np.searchsorted(names, own)
                at[at == len(names)] = 0
                has = np.zeros(len(names), np.int64)
                has[at[names[at] == own]] = 1
                common = np.add.reduceat(has[places], starts)
                linked = 100 * common >= 80 * (len(own) + sizes - common)
                met = set()
                for i in np.flatnonzero(linked):
                    of = members[i]["of"]
                    if of != x["of"] and of not in met:
                        met.add(of)
                        links.add((x["set_key"], members[i]["set_key"]))
        a, b = zip(*sorted(links), strict=True) if links else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sets of texts that have the digest they are wanted for."""
    for batch in batches:
        found = [shingles(t.as_py()) for t in batch.column(1)]
        good = [key_of(x) == k.as_py() for x, k in zip(found, batch.column(0), strict=True)]
        sets = pa.array([x.tobytes() if g else None for x, g in zip(found, good, strict=True)], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), sets], ["set_key", "shingles"]).filter(pa.array(good, pa.bool_()))


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs (a, b, text_a, text_b) whose full sets are similar enough."""
    kept: dict[bytes, np.ndarray] = {}

    def members(key: bytes, text: str) -> np.ndarray:
        found = kept.get(key)
        if found is None:
            if len(kept) == 64:
                kept.clear()
            found = kept[key] = shingles(text)
        return found

    for batch in batches:
        linked = []
        for a, b, text_a, text_b in zip(*batch.columns, strict=True):
            x, y = members(a.as_py(), text_a.as_py()), members(b.as_py(), text_b.as_py())
            if key_of(x) != a.as_py() or key_of(y) != b.as_py():  # another text under the same doc_id
                kept.clear()
                linked.append(False)
                continue
            both = np.concatenate((x, y))
            both.sort()
            common = int((both[1:] == both[:-1]).sum())
            linked.append(100 * common >= 80 * (len(x) + len(y) - common))
        yield pa.RecordBatch.from_arrays(
            [c.filter(pa.array(linked)) for c in batch.columns[:2]], ["a", "b"]
        )


#: Ids of texts to fetch that may be sent to all tasks; more are joined by shuffle.
SENT_IDS = 1_000_000


def _texts(keys: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """(set_key, text) of the classes named in ``keys``."""
    wanted = stored(classes.join(keys, "set_key").select("set_key", F.col("doc_id").alias("wanted_id")), "wanted")
    if wanted.count() <= SENT_IDS:
        wanted = F.broadcast(wanted)
    texts = docs.select("doc_id", "text").join(wanted, F.col("doc_id").eqNullSafe(F.col("wanted_id")))
    return texts.select("set_key", "text")


def confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes that are linked, confirmed on the full sets of their texts."""
    pairs = stored(pairs.select("a", "b"), "pairs")
    keys = pairs.select(F.col("a").alias("set_key")).unionByName(pairs.select(F.col("b").alias("set_key"))).distinct()
    texts = _texts(keys, classes, docs)
    a, b = (texts.select(F.col("set_key").alias(x), F.col("text").alias(f"text_{x}")) for x in "ab")
    return pairs.join(a, "a").join(b, "b").select("a", "b", "text_a", "text_b").mapInArrow(_confirm, LINKS)


def _with_component(rows: DataFrame, column: str, found: DataFrame) -> DataFrame:
    """``rows`` with the component ``of`` the class in ``column``, which is itself where it has no link."""
    named = found.select(F.col("node").alias(column), F.col("component").alias("of"))
    joined = rows.join(named, column, "left")
    return joined.withColumn("of", F.coalesce("of", column))


def _candidates(leaves: DataFrame, classes: DataFrame, compare) -> DataFrame:
    rows = leaves.join(classes.select("set_key", "n_shingles", "sketch"), "set_key").repartition("node")
    rows = rows.sortWithinPartitions("node", "set_key").select("node", "deep", "set_key", "of", "n_shingles", "sketch")
    return rows.mapInArrow(compare, FOUND)


def _mixed(leaves: DataFrame, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The leaves with components, and the nodes that hold more than one: largest component and number of members."""
    rows = stored(_with_component(leaves.drop("of"), "set_key", found), "leaves")
    sizes = rows.groupBy("node", "of").agg(F.count("*").alias("size"))
    return rows, sizes.groupBy("node").agg(
        F.max(F.struct("size", "of"))["of"].alias("main"), F.sum("size").alias("members"), F.count("*").alias("parts")
    ).where("parts > 1")


def _linked_in_large_nodes(leaves: DataFrame, found: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """Links between members of large nodes that are outside the largest component there and any others."""
    rows, nodes = _mixed(leaves.where("deep"), found)
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    rows = rows.join(nodes, "node").select(
        "node", "set_key", "of", (F.col("of") != F.col("main")).alias("apart"), F.pmod(F.xxhash64("set_key"), blocks).alias("block")
    )
    rows = stored(rows, "apart")
    sets = _texts(rows.select("set_key").distinct(), classes, docs).mapInArrow(_sets, "set_key binary, shingles binary")
    full = rows.join(sets, "set_key").withColumn("member", F.struct("set_key", "of", "shingles"))
    outside = full.where("apart").groupBy("node", "block").agg(F.collect_list("member").alias("outside"))
    members = full.groupBy("node", "block").agg(F.collect_list("member").alias("members"))
    return outside.drop("block").join(members.drop("block"), "node").select("outside", "members").mapInArrow(_in_blocks, LINKS)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of each row of ``docs`` (doc_id, text); see the module's text."""
    docs = docs.select("doc_id", "text")
    sketches = stored(docs.mapInArrow(_sketch, SKETCH), "sketches")
    levels = [f"level{i}" for i in range(1, LEVELS + 1)]
    firsts = [F.first(c).alias(c) for c in ("n_shingles", "sketch", *levels)]
    classes = sketches.where("n_shingles > 0").groupBy("set_key").agg(F.min("doc_id").alias("doc_id"), *firsts)
    classes = stored(classes, "classes")
    slim = classes.select("set_key", "doc_id", "n_shingles", "sketch")
    leaves = stored(_leaves(classes), "leaves")

    nearest = _candidates(leaves.withColumn("of", F.col("set_key")), slim, _nearest)
    nearest = nearest.groupBy("b").agg(F.max(F.struct("equal", "a"))["a"].alias("a"))
    links = stored(confirmed(nearest, slim, docs), "confirmed")
    found = components(links)
    rows, nodes = _mixed(leaves.where("not deep"), found)
    apart = _candidates(rows.join(nodes.select("node"), "node", "left_semi"), slim, _all_apart)
    links = links.unionByName(stored(confirmed(apart.select("a", "b").distinct(), slim, docs), "confirmed"))
    found = components(links)
    links = links.unionByName(stored(_linked_in_large_nodes(leaves, found, slim, docs), "confirmed"))
    found = components(links)

    by_class = stored(_with_component(slim.select("set_key", "doc_id"), "set_key", found), "members")
    ids = by_class.groupBy("of").agg(F.min("doc_id").alias("component_id"))
    named = by_class.join(ids, "of").select("set_key", "component_id")
    rows = sketches.select("doc_id", "n_shingles", "set_key")
    linked = rows.where("n_shingles > 0").join(named, "set_key").select("doc_id", "n_shingles", "component_id")
    alone = rows.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))

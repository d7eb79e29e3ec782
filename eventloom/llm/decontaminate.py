"""Benchmark decontamination: BM25 over test items with block-max WAND, then exact overlap.

Test items are indexed by word: postings in the order of the item's number, in
blocks of ``BLOCK`` items with the largest impact of each block that has any. Impacts are BM25
weights divided by the item's own score, so a passage that holds all words of an
item scores 1 for it, and one threshold fits items of any length.

Every passage of every document is a query: passages are ``2 * w`` words at every
``w`` words, where ``w`` is the length of the longest item, so any copy of an item
lies whole in one of them. Sums of block maxima bound a passage's score in each
block of items; for the passages that no bound rules out, WAND walks the postings,
skips what the maxima rule out, and returns every item of ``THRESHOLD`` or more.

A retrieved item is confirmed when the passage holds ``OVERLAP`` or more of its
runs of five words, and some of the question and of the answer. The answer is
what follows the last question mark, else the last line, else the last quarter of
the words. Words are runs of letters, digits and underscores, lower-cased.

An item of fewer than five words has no run to confirm it by, so it matches only a
text that has its words and no others.

The index is sent to all tasks in parts of at most ``PART_ITEMS`` items and
``PART_CHARS`` characters (a longer item is a part of its own); more items make more
parts, each with a pass over the documents. An index grows with the words of its
items, not with items times words. Word statistics are those of all items.

Defined cases: null and empty texts and items without words match nothing;
documents and items with null id are matched like any other; repeated documents match
each, repeated items (same id and text) once. Texts of one id, or without id, are items
of their own, so a pair of ids is returned once for each text that matches. Of passages
with equal scores the first counts. Texts of any length are read whole. Other columns
play no part, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K1, B = 1.2, 0.75
THRESHOLD = 0.6
OVERLAP = 0.8
GRAM = 5
BLOCK = 4
SUMS = 1 << 18  # sums of block maxima held at a time
PART_ITEMS, PART_CHARS = 20_000, 1 << 24
WORD = re.compile(r"\w+")
MATCHES = "doc_id long, item_id long, passage int, score double, question_overlap double, answer_overlap double"


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """Words of both parts of an item; a part may be empty."""
    text = text.lower().strip()
    cut = text.rfind("?") + 1
    if not 0 < cut < len(text):
        cut = text.rfind("\n")
    if cut > 0 and (question := WORD.findall(text[:cut])) and (answer := WORD.findall(text[cut:])):
        return question, answer
    words = WORD.findall(text)
    cut = len(words) - len(words) // 4
    return words[:cut], words[cut:]


def grams(words: list[str]) -> set[tuple[str, ...]]:
    return {tuple(words[i : i + GRAM]) for i in range(max(1, len(words) - GRAM + 1))} if words else set()


@dataclass
class Index:
    """One part of the items, by word."""

    ids: list[int | None] = field(default_factory=list)
    parts: list[tuple[set, set]] = field(default_factory=list)
    words: dict[str, int] = field(default_factory=dict)
    postings: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)  # item numbers and impacts, by word
    maxima: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)  # blocks and their largest impacts, by word
    at: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))  # where each word's maxima start in the next two
    blocks: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    largest: np.ndarray = field(default_factory=lambda: np.zeros(0))
    most: np.ndarray = field(default_factory=lambda: np.zeros(0))  # by word: largest impact
    short: dict[tuple[str, ...], list[int | None]] = field(default_factory=dict)  # ids of items too short for a run
    longest: int = 1


def build_index(
    items: list[tuple[int | None, str]], frequency: dict[str, int], count: int, mean: float, longest: int = 1
) -> Index:
    """Index of ``items`` given how many of all ``count`` items hold each word, and their mean and largest length."""
    index, lists = Index(longest=longest), {}
    for item_id, text in items:
        question, answer = question_and_answer(text)
        tf = Counter(question + answer)
        length = tf.total()
        if length < GRAM:
            if tf:
                index.short.setdefault(tuple(question + answer), []).append(item_id)
            continue
        idf = {w: math.log(1 + (count - frequency[w] + 0.5) / (frequency[w] + 0.5)) for w in tf}
        norm = K1 * (1 - B + B * length / mean)
        impact = {w: idf[w] * n * (K1 + 1) / (n + norm) for w, n in tf.items()}
        own = sum(impact.values())
        for w in sorted(impact):
            lists.setdefault(w, []).append((len(index.ids), impact[w] / own))
        index.longest = max(index.longest, length)
        index.ids.append(item_id)
        index.parts.append((grams(question), grams(answer)))
    for w, found in lists.items():
        index.words[w] = len(index.words)
        numbers, impacts = np.array([n for n, _ in found], np.int32), np.array([x for _, x in found])
        blocks, starts = np.unique(numbers // BLOCK, return_index=True)
        index.postings.append((numbers, impacts))
        index.maxima.append((blocks, np.maximum.reduceat(impacts, starts)))
    index.most = np.array([largest.max() for _, largest in index.maxima])
    if lists:
        index.blocks, index.largest = (np.concatenate(x) for x in zip(*index.maxima, strict=True))
        index.at = np.concatenate(([0], np.cumsum([len(x) for x, _ in index.maxima])))
    return index


def _largest(maxima: tuple[np.ndarray, np.ndarray], block: int) -> float:
    """Largest impact of a word in a block; 0 if no item of the block has it."""
    at = int(np.searchsorted(maxima[0], block))
    return float(maxima[1][at]) if at < len(maxima[0]) and maxima[0][at] == block else 0.0


def wand(index: Index, words: np.ndarray, least: float = THRESHOLD) -> list[tuple[int, float]]:
    """(item number, score) of all items that score ``least`` or more for the distinct ``words`` of a passage."""
    lists = [[0, *index.postings[w], index.maxima[w], float(index.most[w])] for w in words]
    edge, found = least - 1e-9, []
    while True:
        lists = [x for x in lists if x[0] < len(x[1])]
        lists.sort(key=lambda x: x[1][x[0]])
        total, pivot = 0.0, None
        for k, x in enumerate(lists):
            total += x[4]
            if total >= edge:
                pivot = k
                break
        if pivot is None:
            return found
        item = int(lists[pivot][1][lists[pivot][0]])
        block = item // BLOCK
        upto = [x for x in lists if x[1][x[0]] <= item]
        if sum(_largest(x[3], block) for x in upto) < edge:
            # nothing in this block before the next list's item: go to whichever comes first
            later = [x[1][x[0]] for x in lists if x[1][x[0]] > item]
            target = min([(block + 1) * BLOCK, *later])
            for x in upto:
                x[0] += int(np.searchsorted(x[1][x[0] :], target))
        elif lists[0][1][lists[0][0]] == item:
            score = sum(float(x[2][x[0]]) for x in upto)
            if score >= edge:
                found.append((int(item), score))
            for x in upto:
                x[0] += 1
        else:
            for x in upto:
                if x[1][x[0]] < item:
                    x[0] += int(np.searchsorted(x[1][x[0] :], item))


def candidates(index: Index, known: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(passage, its distinct words) of the passages whose bound in some block reaches the threshold.

    ``known`` has the number of each word of a text, or -1 for a word of no item.
    """
    at = np.flatnonzero(known >= 0)
    if not len(at):
        return []
    size = len(index.words)
    passage = at // index.longest
    keys = np.concatenate((passage * size, (passage[passage > 0] - 1) * size)) + np.concatenate(
        (known[at], known[at[passage > 0]])
    )
    keys = np.unique(keys)
    passage, words = keys // size, keys % size
    starts = np.flatnonzero(np.diff(passage, prepend=-1))
    edge = THRESHOLD - 1e-4
    most = np.add.reduceat(index.most[words], starts)
    ends = np.append(starts[1:], len(words))
    blocks = -(-len(index.ids) // BLOCK)
    bounded = np.flatnonzero(most >= edge)
    out = []
    for low in range(0, len(bounded), step := max(1, SUMS // blocks)):
        some = bounded[low : low + step]
        rows, at = _ranges(starts[some], ends[some])
        mine, of = _ranges(index.at[words[at]], index.at[words[at] + 1])
        sums = np.bincount(rows[mine] * blocks + index.blocks[of], index.largest[of], len(some) * blocks)
        for k in some[(sums.reshape(-1, blocks) >= edge).any(axis=1)]:
            out.append((int(passage[starts[k]]), words[starts[k] : ends[k]]))
    return out


def _ranges(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all ranges in turn, behind the number of the range of each."""
    sizes = ends - starts
    upto = np.cumsum(sizes)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    return rows, np.arange(len(rows)) + (starts - upto + sizes)[rows]


def matches(index: Index, text: str) -> list[tuple[int | None, int, float, float, float]]:
    """(item id, passage, score, overlaps with question and answer) of a text, the best passage of each item."""
    words = WORD.findall(text.lower())
    whole = [(item_id, 0, 1.0, 1.0, 1.0) for item_id in index.short.get(tuple(words), ())] if len(words) < GRAM else []
    known = np.array(list(map(index.words.get, words, repeat(-1))), np.int64)
    best: dict[int, tuple] = {}
    for passage, mine in candidates(index, known):
        retrieved = wand(index, mine)
        if not retrieved:
            continue
        low = passage * index.longest
        have = grams(words[low : low + 2 * index.longest])
        for item, score in retrieved:
            question, answer = index.parts[item]
            shared = [_shared(part, have, words[low : low + 2 * index.longest]) for part in (question, answer)]
            total = sum(shared) / (len(question) + len(answer))
            parts = [s / len(p) for s, p in zip(shared, (question, answer), strict=True)]
            if total >= OVERLAP and min(parts) > 0 and (item not in best or best[item][1] < score):
                best[item] = (passage, score, *parts)
    return whole + [(index.ids[item], *found) for item, found in sorted(best.items())]


def _shared(part: set, have: set, words: list[str]) -> int:
    """How many of a part's runs the passage has; runs of fewer than five words are looked for as they are."""
    n = sum(len(g) == GRAM and g in have for g in part)
    for g in (g for g in part if len(g) < GRAM):
        n += any(tuple(words[i : i + len(g)]) == g for i in range(len(words) - len(g) + 1))
    return n


def _index_parts(items: DataFrame) -> Iterator[Index]:
    """Indexes of bounded parts of the items (item_id, text)."""
    texts = items.where("text is not null").select("item_id", "text").distinct()
    found = F.regexp_extract_all(F.lower("text"), F.lit(r"(?U)\w+"), 0)
    words = texts.select(F.xxhash64("item_id", "text").alias("hash"), found.alias("words"))
    size = words.agg(
        F.count("*").alias("n"), F.sum(F.size("words")).alias("words"), F.max(F.size("words")).alias("longest")
    ).first()
    parts = 1
    while True:  # ends: different rows have different hashes, and one row is a part of any size
        part_of = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
        sizes = texts.groupBy(part_of.alias("part")).agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"))
        if sizes.where((F.col("n") > PART_ITEMS) | ((F.col("chars") > PART_CHARS) & (F.col("n") > 1))).isEmpty():
            break
        parts *= 2
    for part in range(parts):
        mine = texts.where(part_of == part).collect()
        mine = sorted(((r.item_id, r.text) for r in mine), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        frequency = Counter(w for _, t in mine for w in set(WORD.findall(t.lower())))
        if not frequency:
            continue
        if parts > 1:
            held = words.where(F.pmod("hash", F.lit(parts)) == part).select(F.explode("words").alias("word")).distinct()
            each = words.select(F.explode(F.array_distinct("words")).alias("word"))
            counted = each.join(held, "word", "left_semi").groupBy("word").count()
            frequency |= Counter({r.word: r["count"] for r in counted.collect()})
        yield build_index(mine, frequency, size.n, max(1.0, size.words / size.n), size.longest)


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Matches of the texts of ``docs`` (doc_id, text) with ``items`` (item_id, text); see the module's text."""
    spark, found = docs.sparkSession, []
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    for index in _index_parts(items.select(F.col("item_id").cast("long"), "text")):
        shared = spark.sparkContext.broadcast(index)

        def match(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = []
                for doc_id, text in zip(*batch.columns, strict=True):
                    if text.is_valid:
                        rows += [(doc_id.as_py(), *m) for m in matches(shared.value, text.as_py())]
                columns = list(zip(*rows, strict=True)) if rows else [()] * 6
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.float64(), pa.float64()]
                arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in MATCHES.split(", ")])

        found.append(docs.mapInArrow(match, MATCHES))
    if not found:
        return spark.createDataFrame([], MATCHES)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out

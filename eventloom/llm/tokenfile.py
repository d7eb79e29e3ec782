"""Token ids in files with random access: directly addressable codes.

Ids are split into chunks of 8 bits. Level 0 holds the lowest chunk of every id
and a bitmap that says which ids go on; level 1 the next chunk of those, and so
on. A directory of ranks, one per 512 bits of a bitmap, tells where an id goes on
in the next level, so any id is read without reading those before it.

Segment layout, little-endian: ``DAC1``, number of levels (u32), then per level
number of entries (u64), chunks, bitmap (padded to whole bytes), and the
directory (u32 per 512 bits: ones before them).

The files are rows of segments (part, segment, start, doc_ids, counts, payload):
``part`` numbers are in the order of doc_id, a segment holds whole documents up to
about ``SEGMENT`` ids, ``start`` counts the ids before it in its part. They are
written and committed by Spark, one file per part.

Defined cases: null and empty texts have no ids but the end id; a null doc_id
comes first; rows of one doc_id are in the order of their texts; an empty table
gives files without rows. A text of any length is one entry of its segment. Other columns
are not looked at.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventloom.llm.common import hold

MAGIC = b"DAC1"
RANK_BITS = 512
SEGMENT = 1 << 20
END_ID = 2
SEGMENTS = "part int, segment int, start long, doc_ids array<long>, counts array<long>, payload binary"
DOCUMENTS = "part int, segment_start long, doc_id long, before long, n_tokens long, ids_crc32 long"


def pack(ids: np.ndarray) -> bytes:
    """Segment of the ids (unsigned 32-bit)."""
    levels, rest = [], ids.astype(np.uint32)
    while True:
        more = rest > 255
        bitmap = np.packbits(more, bitorder="little")
        ones = np.add.reduceat(more, np.arange(0, len(more), RANK_BITS)) if len(more) else np.empty(0)
        directory = np.concatenate(([0], np.cumsum(ones)))[:-1].astype("<u4") if len(more) else np.empty(0, "<u4")
        chunks = (rest & 255).astype(np.uint8)
        levels.append(np.uint64(len(rest)).tobytes() + chunks.tobytes() + bitmap.tobytes() + directory.tobytes())
        rest = rest[more] >> 8
        if not len(rest):
            return MAGIC + np.uint32(len(levels)).tobytes() + b"".join(levels)


class Segment:
    """Reader of a packed segment."""

    def __init__(self, payload: bytes):
        if payload[:4] != MAGIC:
            raise ValueError("not a segment")
        at, self.levels = 8, []
        for _ in range(int.from_bytes(payload[4:8], "little")):
            n = int.from_bytes(payload[at : at + 8], "little")
            chunks = np.frombuffer(payload, np.uint8, n, at + 8)
            bitmap = np.frombuffer(payload, np.uint8, -(-n // 8), at + 8 + n)
            ranks = -(-n // RANK_BITS)
            directory = np.frombuffer(payload, "<u4", ranks, at + 8 + n + len(bitmap))
            self.levels.append((chunks, bitmap, directory))
            at += 8 + n + len(bitmap) + 4 * ranks

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def __getitem__(self, i: int) -> int:
        """One id, by at most one look at each level."""
        value = shift = 0
        for chunks, bitmap, directory in self.levels:
            value |= int(chunks[i]) << shift
            shift += 8
            if not bitmap[i >> 3] >> (i & 7) & 1:
                break
            first = i // RANK_BITS * (RANK_BITS // 8)
            before = int.from_bytes(bitmap[first : (i >> 3) + 1].tobytes(), "little") & ((1 << (i - 8 * first)) - 1)
            i = int(directory[i // RANK_BITS]) + before.bit_count()
        return value

    def read(self) -> np.ndarray:
        """All ids."""
        out = self.levels[0][0].astype(np.uint32)
        at = np.arange(len(out))
        for k, (_, bitmap, _) in enumerate(self.levels[:-1]):
            more = np.unpackbits(bitmap, count=len(self.levels[k][0]), bitorder="little").view(bool)
            at = at[more]
            out[at] |= self.levels[k + 1][0].astype(np.uint32) << np.uint32(8 * (k + 1))
        return out


# Fixed value: the normal form under which texts may be encoded word by word.
WORD_RULES = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]


class Encoder:
    """Ids by the tokenizers library, special tokens in texts included.

    If the tokenizer lower-cases and parts words at blanks (``by_words``, looked up in its
    file), the ids of a text are those of its words, and the ids of a bounded number of words are
    kept. Special tokens are found in the text as it is, and what lies between them is encoded
    by itself, as the library does. Texts of other tokenizers are encoded whole.
    """

    MOST_WORDS, MOST_CHARS = 1_500_000, 24_000_000
    JOINED = re.compile("[A-Z][^\x00-\u02ff]")
    SIGN = re.compile(r"([.,])(?<=[a-z].)(?= )")  # the sign first, so that the search leaps from sign to sign
    MARK = "\x01"  # put between words that are encoded together; it is one id

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        steps = (rules.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        removes_blanks = steps[0].get("behavior") == "Removed" and r"[^\s" in (steps[0].get("pattern") or {}).get("Regex", "")
        self.by_words = (rules.get("normalizer") or {}).get("normalizers") == WORD_RULES and removes_blanks
        special = {t["content"]: t["id"] for t in rules.get("added_tokens", ()) if t["special"]}
        # a token found before normalization, wherever it stands
        plain = all(not (t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"]) for t in rules.get("added_tokens", ()))
        self.by_words = self.by_words and plain and len(special) == len(rules.get("added_tokens", ()))
        if self.by_words:
            self.tokenizer.encode_special_tokens = True
            self.special = special
            self.find_special = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")")
            (self.mark,) = self._ids(self.MARK)
            self.forget()

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def forget(self) -> None:
        self.places: dict[str, int] = {}
        self.chars = 0
        self.ids = np.empty(1 << 20, np.uint32)
        self.ends = np.zeros(1 << 18, np.int64)  # of each word's ids; a word starts where the one before ends

    def _learn(self, words: list[str]) -> None:
        odd = [w for w in words if self.MARK in w]
        words = [w for w in words if self.MARK not in w]
        ids = np.array(self._ids(f" {self.MARK} ".join(words)), np.uint32)
        marks = np.flatnonzero(ids == self.mark)
        ends = np.append(marks - np.arange(len(marks)), len(ids) - len(marks))[: len(words)]
        self._keep(words, np.delete(ids, marks), ends)
        for word in odd:
            ids = np.array(self._ids(word), np.uint32)
            self._keep([word], ids, np.array([len(ids)]))

    def _keep(self, words: list[str], ids: np.ndarray, ends: np.ndarray) -> None:
        first = len(self.places)
        start = int(self.ends[first - 1]) if first else 0
        while first + len(words) > len(self.ends):
            self.ends = np.concatenate((self.ends, np.zeros_like(self.ends)))
        while start + len(ids) > len(self.ids):
            self.ids = np.concatenate((self.ids, np.empty_like(self.ids)))
        self.places.update(zip(words, range(first, first + len(words)), strict=True))
        self.ids[start : start + len(ids)] = ids
        self.ends[first : first + len(words)] = start + ends
        self.chars += sum(map(len, words))

    def encode(self, text: str) -> np.ndarray:
        """Ids of ``text``."""
        if not self.by_words:
            return np.array(self._ids(text), np.uint32)
        if not self.special or not self.find_special.search(text):
            return self._by_words(text)
        pieces = self.find_special.split(text)
        found = [
            np.array([self.special[piece]], np.uint32) if k % 2 else self._by_words(piece)
            for k, piece in enumerate(pieces)
            if piece
        ]
        return np.concatenate(found) if found else np.empty(0, np.uint32)

    def _by_words(self, text: str) -> np.ndarray:
        """Ids of a text, which is cut finer first where that changes no id, so that words recur.

        The tokenizer lower-cases; doing it for A-Z before tells only where such a
        letter is joined with a mark behind it. It parts a letter from a sign too.
        """
        if text.isascii():
            text = self.SIGN.sub(r" \1 ", text.lower())
        elif not self.JOINED.search(text):
            text = self.SIGN.sub(r" \1 ", text.encode().lower().decode())
        if len(self.places) > self.MOST_WORDS or self.chars > self.MOST_CHARS:
            self.forget()
        words = text.replace("\n", " ").split(" ")
        found = list(map(self.places.get, words))
        if None in found:
            new = [k for k, place in enumerate(found) if place is None]
            self._learn(list({words[k] for k in new}))
            for k in new:
                found[k] = self.places[words[k]]
        at = np.array(found)
        starts = np.where(at > 0, self.ends[at - 1], 0)
        sizes = self.ends[at] - starts
        ends = np.cumsum(sizes)
        return self.ids[np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1])]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    hold("token encoder", _ENCODERS.clear)
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _segments(tokenizer: str, end_id: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, number, start = encoder(tokenizer).encode, TaskContext.get().partitionId(), 0, 0
        doc_ids, counts, ids = [], [], []

        def flush() -> pa.RecordBatch:
            nonlocal doc_ids, counts, ids, number, start
            row = {"part": part, "segment": number, "start": start, "doc_ids": doc_ids, "counts": counts}
            row["payload"] = pack(np.concatenate(ids))
            kinds = [("part", pa.int32()), ("segment", pa.int32()), ("start", pa.int64())]
            kinds += [("doc_ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())), ("payload", pa.binary())]
            number, start = number + 1, start + sum(counts)
            doc_ids, counts, ids = [], [], []
            return pa.RecordBatch.from_pylist([row], pa.schema(kinds))

        for batch in batches:
            for doc_id, text in zip(*batch.columns, strict=True):
                found = np.append(encode(text.as_py() or ""), np.uint32(end_id))
                doc_ids.append(doc_id.as_py())
                counts.append(len(found))
                ids.append(found)
                if sum(counts[-1:]) >= SEGMENT or len(counts) % 64 == 0 and sum(counts) >= SEGMENT:
                    yield flush()
        if counts:
            yield flush()

    return write


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Write the ids of ``docs`` (doc_id, text), in the order of doc_id, below ``path``."""
    # many rows of one id, or without one, are parted by how their texts begin
    ranges = ["doc_id", F.substring("text", 1, 64)]
    rows = docs.select("doc_id", "text").repartitionByRange(*ranges).sortWithinPartitions("doc_id", "text")
    rows.mapInArrow(_segments(tokenizer, end_id), SEGMENTS).write.parquet(path)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = Segment(row["payload"]).read().astype("<u4")
            ends = np.cumsum(row["counts"])
            before = ends - row["counts"]
            sums = [crc32(ids[a:b].tobytes()) for a, b in zip(before, ends, strict=True)]
            n = len(sums)
            columns = [[row["part"]] * n, [row["start"]] * n, row["doc_ids"], before, row["counts"], sums]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64() if k else pa.int32()) for k, c in enumerate(columns)],
                ["part", "segment_start", "doc_id", "before", "n_tokens", "ids_crc32"],
            )


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document in the files below ``path``."""
    files = spark.read.schema(SEGMENTS).parquet(path)
    sizes = F.aggregate("counts", F.lit(0).cast("long"), lambda total, n: total + n)
    parts = files.groupBy("part").agg(F.sum(sizes).alias("size"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per written file
    parts = parts.select("part", F.coalesce(F.sum("size").over(ahead), F.lit(0)).alias("part_start"))
    found = files.mapInArrow(_read, DOCUMENTS).join(parts, "part")
    start = F.col("part_start") + F.col("segment_start") + F.col("before")
    return found.select("doc_id", start.alias("start"), "n_tokens", "ids_crc32")

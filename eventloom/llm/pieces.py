"""SentencePiece BPE with seeded merge-dropout, encoded and decoded without loss.

A text is cut into chunks (a run of blanks with the word or the signs behind it,
or a line feed) that no piece of the vocabulary spans, so chunks encode on their own. In
each chunk the agenda takes the best-scored pair of neighbours, leftmost first,
and merges it, until no pair makes a piece. A candidate merge is skipped when a
keyed hash of (seed, key of the document, number of the chunk in its text, both
pieces, place in the chunk) falls below ``dropout``: the same key gives the same
pieces on any executor, and every occurrence of a chunk is decided on its own. A
worker keeps, for a bounded number of chunks, the merges taken without dropout and
the pieces these give. An occurrence that skips none of them has these pieces, as a
skipped candidate that is never taken changes nothing; all others are merged anew.

Short chunks are merged many at a time, in arrays; long ones with a heap. Both
take the same merges. Without dropout the ids are those of the sentencepiece
library (a literal ``▁`` in a text apart: it is spelled in bytes, as it would
come back as a blank otherwise). Characters without a piece are spelled in bytes.

Defined cases: null text gives null ids, an empty one no ids; a null key is a key
like any other; texts of any length, and chunks of any length, are whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from hashlib import blake2b
from heapq import heapify, heappop, heappush
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from eventloom.llm.common import hold, mix, rest, steps

LONGEST_IN_ARRAYS = 40
MOST_CHUNKS, MOST_CHARS = 150_000, 4_000_000
_AT_A_TIME = 1 << 13  # occurrences of chunks looked at together
SPACE = "▁"


def _cuts(pieces: Iterable[str]) -> re.Pattern:
    """The finest way to cut texts that no piece spans: words and signs, else what stands between blanks, else none.

    A word character that some piece joins with a sign counts as a sign.
    """
    texts = [p.replace(SPACE, " ") for p in pieces]
    joined = {c for t in texts for c in re.findall(r"\w(?=[^\w ])|(?<=[^\w ])\w|_", t)}
    signs = "".join(map(re.escape, sorted(joined)))
    cuts = (rf"\n|[ ]*[^\W{signs}]+|[ ]*(?:[^\w \n]|[_{signs}])+|[ ]+", r"\n|[ ]*[^ \n]+|[ ]+", r"(?s).+")
    return next(c for c in map(re.compile, cuts) if all(map(c.fullmatch, texts)))


NONE = np.int32(2**31 - 1)


class Pieces:
    """A BPE model of the sentencepiece library as tables of merges."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.vocab_size()
        self.names = [model.id_to_piece(i) for i in range(size)]
        normal = [
            i for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
        ]
        self.bytes = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if not all(model.is_byte(i) for i in self.bytes):
            raise ValueError("the model has no pieces for bytes")
        ids = {self.names[i]: i for i in normal}
        self.cut = _cuts(ids).findall
        for char in {c for p in ids if len(p) > 1 for c in p} - ids.keys():
            ids[char] = len(self.names)  # a character that only longer pieces hold
            self.names.append("")
        self.ids, self.size = ids, size
        self.spelled: dict[int, list[int]] = {}
        self.by_code = -2 - np.arange(0x110000, dtype=np.int32)  # symbol of each character
        for char, i in ids.items():
            if len(char) == 1:
                self.by_code[ord(char)] = i
        self.by_code[ord(" ")], self.by_code[ord(SPACE)] = ids.get(SPACE, -2 - 32), -2 - ord(SPACE)
        ranks = np.full(len(self.names) + 1, NONE)
        order = sorted(normal, key=lambda i: (-model.get_score(i), i))
        ranks[order] = np.arange(len(order))
        self.ranks = ranks
        merges = {}
        for piece in (p for p in ids if len(p) > 1):
            for cut in range(1, len(piece)):
                left, right = ids.get(piece[:cut]), ids.get(piece[cut:])
                if left is not None and right is not None:
                    merges[left << 32 | right] = ids[piece]
        self.pairs = np.array(sorted(merges), np.int64)
        self.pair_ranks = ranks[[merges[p] for p in self.pairs.tolist()]]
        self.by_rank = np.array(order, np.int32)
        blank = SPACE.encode()
        self.texts = [b""] * size
        for i in normal:
            self.texts[i] = self.names[i].encode().replace(blank, b" ")
        for b, i in enumerate(self.bytes):
            self.texts[i] = bytes([b])
        self.sizes = np.array([len(t) for t in self.texts])
        self.places = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(self.texts), np.uint8)

    def merged(self, left: int, right: int) -> int | None:
        """The piece that two symbols make; None if they make none."""
        pair = left << 32 | right
        at = self.pairs.searchsorted(pair)
        return int(self.by_rank[self.pair_ranks[at]]) if at < len(self.pairs) and self.pairs[at] == pair else None

    def symbols(self, text: str) -> np.ndarray:
        """Ids of the characters of a text; a character without one is -2 less its code point."""
        return self.by_code[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]

    def spell(self, symbol: int) -> list[int]:
        """The pieces of a symbol: itself, or its bytes."""
        if 0 <= symbol < self.size:
            return [symbol]
        if symbol not in self.spelled:
            char = chr(-2 - symbol) if symbol < 0 else next(c for c, i in self.ids.items() if i == symbol)
            self.spelled[symbol] = [self.bytes[b] for b in char.encode()]
        return self.spelled[symbol]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids, less the blank that encoding puts in front."""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        data = self.data[np.repeat(self.places[ids] - ends + sizes, sizes) + np.arange(total)]
        return data.tobytes().decode(errors="replace").removeprefix(" ")


def skips(left: np.ndarray, right: np.ndarray, place: np.ndarray, key: np.ndarray, dropout: float) -> np.ndarray:
    """Whether the keyed hash drops each candidate merge."""
    if dropout <= 0:
        return np.zeros(len(left), bool)
    pair = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
    mixed = mix(mix(pair ^ key) + place.astype(np.uint64))
    return (mixed >> np.uint64(11)).astype(np.float64) < dropout * 2.0**53


def agenda(pieces: Pieces, symbols: list[int], key: int, dropout: float, taken: list | None = None) -> list[int]:
    """Symbols of one chunk merged with a heap of candidates; ``taken`` gets (left, right, place) of the merges."""
    n = len(symbols)
    left, right, alive = list(range(-1, n - 1)), list(range(1, n + 1)), [True] * n
    symbols = list(symbols)

    def candidates(at: list[int]) -> list[tuple[int, int, int, int, int]]:
        pairs = [(i, symbols[i], symbols[right[i]]) for i in at if symbols[i] >= 0 and symbols[right[i]] >= 0]
        pairs = [(i, a, b, m) for i, a, b in pairs if (m := pieces.merged(a, b)) is not None]
        if not pairs:
            return []
        table = np.array([p[:3] for p in pairs])
        drop = skips(table[:, 1], table[:, 2], table[:, 0], np.full(len(pairs), key, np.uint64), dropout)
        return [(int(pieces.ranks[m]), i, a, b, m) for (i, a, b, m), d in zip(pairs, drop, strict=True) if not d]

    heap = candidates(list(range(n - 1)))
    heapify(heap)
    while heap:
        _, i, a, b, merged = heappop(heap)
        if not alive[i] or symbols[i] != a or right[i] >= n or symbols[right[i]] != b:
            continue
        if taken is not None:
            taken.append((a, b, i))
        gone = right[i]
        symbols[i], alive[gone], right[i] = merged, False, right[gone]
        if right[i] < n:
            left[right[i]] = i
        for fresh in candidates([j for j in (left[i], i) if j >= 0 and right[j] < n]):
            heappush(heap, fresh)
    return [s for s, a in zip(symbols, alive, strict=True) if a]


def in_arrays(
    pieces: Pieces, symbols: np.ndarray, keys: np.ndarray, dropout: float, taken: list | None = None
) -> np.ndarray:
    """What ``agenda`` gives for each of many short chunks, a round of merges at a time.

    ``taken`` gets (rows, left, right, place) of each round's merges.

    ``symbols`` has a row for each chunk, filled up with -1, and at least one -1 at
    the end of each; so has the result.
    """
    count, width = symbols.shape[0], symbols.shape[1] - 1
    symbols = symbols.astype(np.int32)
    columns = np.arange(width + 1, dtype=np.int32)
    places = np.tile(columns, (count, 1))

    def look_up(a: np.ndarray, b: np.ndarray, place: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Ranks of pairs of neighbours."""
        pairs = a.astype(np.int64) << 32 | b
        found = np.minimum(np.searchsorted(pieces.pairs, pairs), len(pieces.pairs) - 1)
        good = (a >= 0) & (b >= 0) & (pieces.pairs[found] == pairs)
        if dropout > 0:
            good[good] = ~skips(a[good], b[good], place[good], keys[good], dropout)
        return np.where(good, pieces.pair_ranks[found], NONE)

    first = look_up(symbols[:, :-1].ravel(), symbols[:, 1:].ravel(), places[:, :-1].ravel(), np.repeat(keys, width))
    ranks = np.pad(first.reshape(count, width), ((0, 0), (0, 1)), constant_values=NONE)
    out, done = symbols.copy(), np.arange(count)
    while len(done):
        best = ranks.argmin(axis=1)
        least = ranks[np.arange(len(done)), best]
        busy = least != NONE
        if not busy.all():
            out[done[~busy]] = symbols[~busy]
            done, best, least, keys = done[busy], best[busy], least[busy], keys[busy]
            symbols, places, ranks = symbols[busy], places[busy], ranks[busy]
        starts = np.arange(len(done)) * (width + 1)
        at = starts + best
        if taken is not None and len(done):
            taken.append((done, *(x.take(y) for x, y in ((symbols, at), (symbols, at + 1), (places, at)))))
        symbols.reshape(-1)[at] = pieces.by_rank[least]
        take = np.minimum(columns + (columns > best[:, None]), width) + starts[:, None]  # all but the second of the pair
        symbols, places, ranks = (x.take(take) for x in (symbols, places, ranks))
        for at, some in ((at, best < width), (at - 1, best > 0)):
            at = at[some]
            ranks.reshape(-1)[at] = look_up(symbols.take(at), symbols.take(at + 1), places.take(at), keys[some])
    return out


class _Runs:
    """Runs of values, one behind the other, that are added and looked up by number."""

    def __init__(self, kind: type):
        self.values = np.empty(1 << 20, kind)
        self.ends = np.zeros(1 << 18, np.int64)  # a run starts where the one before ends
        self.count = 0

    def add(self, values: np.ndarray, ends: np.ndarray) -> None:
        start = int(self.ends[self.count - 1]) if self.count else 0
        while self.count + len(ends) > len(self.ends):
            self.ends = np.concatenate((self.ends, np.zeros_like(self.ends)))
        while start + len(values) > len(self.values):
            self.values = np.concatenate((self.values, np.empty_like(self.values)))
        self.values[start : start + len(values)] = values
        self.ends[self.count : self.count + len(ends)] = start + ends
        self.count += len(ends)

    def of(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values of some runs in turn, and the size of each run."""
        starts = np.where(at > 0, self.ends[at - 1], 0)
        sizes = self.ends[at] - starts
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return self.values[np.repeat(starts - ends + sizes, sizes) + np.arange(total)], sizes


class Encoder:
    """Encodes texts; keeps a bounded number of chunks as they are without dropout."""

    def __init__(self, path: str, dropout: float, seed: int):
        self.pieces, self.dropout, self.seed = _pieces(path), dropout, seed
        self.forget()

    def forget(self) -> None:
        self.kept: dict[str, int] = {}
        self.chars = 0
        self.ids = _Runs(np.int32)
        self.taken = _Runs(np.uint64)  # left piece, right piece and place of each merge
        self.places = _Runs(np.int32)

    def key_of(self, key: str | None) -> int:
        return int.from_bytes(blake2b(f"{self.seed} {key}".encode(), digest_size=8).digest(), "little")

    def merge(
        self, chunks: list[str], keys: np.ndarray, dropout: float, taken: list | None = None
    ) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the chunks in turn, and where each one's end; ``taken`` gets (chunks, left, right, place) of merges."""
        lengths = np.array([len(c) for c in chunks])
        ends = np.cumsum(lengths)
        starts = ends - lengths
        symbols = self.pieces.symbols("".join(chunks))
        counts, found = np.zeros(len(chunks), np.int64), {}
        width = np.minimum(-(-lengths // 4) * 4, LONGEST_IN_ARRAYS)
        order = np.argsort(width, kind="stable")
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        for w in np.unique(width):
            rows = order[width[order] == w]
            long = rows[lengths[rows] > LONGEST_IN_ARRAYS]
            for i in long:
                merges = None if taken is None else []
                row = symbols[starts[i] : ends[i]].tolist()
                found[int(i)] = agenda(self.pieces, row, int(keys[i]), dropout, merges)
                if merges:
                    taken.append((np.full(len(merges), i), *np.array(merges, np.int64).T))
            rows = rows[lengths[rows] <= LONGEST_IN_ARRAYS]
            for low in range(0, len(rows), 8192):
                part = rows[low : low + 8192]
                inside = np.arange(w) < lengths[part][:, None]
                table = np.full((len(part), int(w) + 1), -1, np.int64)
                table[:, :-1][inside] = symbols[(starts[part][:, None] + np.arange(w))[inside]]
                rounds = None if taken is None else []
                table = in_arrays(self.pieces, table, keys[part], dropout, rounds)
                for done, *merges in rounds or ():
                    taken.append((part[done], *merges))
                odd = ((table < -1) | (table >= self.pieces.size)).any(axis=1)
                for i, row in zip(part[odd], table[odd], strict=True):
                    found[int(i)] = row[row != -1].tolist()
                part, table = part[~odd], table[~odd]
                counts[part] = (table != -1).sum(axis=1)
                parts.append((part, table[table != -1]))
        spelled = {i: [p for s in row for p in self.pieces.spell(s)] for i, row in found.items()}
        for i, row in spelled.items():
            counts[i] = len(row)
            parts.append((np.array([i]), np.array(row)))
        ends = np.cumsum(counts)
        ids = np.empty(int(ends[-1]), np.int32)
        for rows, flat in parts:
            sizes = counts[rows]
            upto = np.cumsum(sizes)
            ids[np.repeat(ends[rows] - upto, sizes) + np.arange(len(flat))] = flat
        return ids, ends

    def _learn(self, chunks: list[str]) -> None:
        taken: list[tuple] = []
        ids, ends = self.merge(chunks, np.zeros(len(chunks), np.uint64), 0.0, taken)
        self.kept.update(zip(chunks, range(len(self.kept), len(self.kept) + len(chunks)), strict=True))
        self.chars += sum(map(len, chunks))
        self.ids.add(ids, ends)
        none = np.empty(0, np.int64)
        of, left, right, place = (np.concatenate(c) for c in zip((none,) * 4, *taken, strict=True))
        order = np.argsort(of, kind="stable")
        upto = np.cumsum(np.bincount(of, minlength=len(chunks)))
        pairs = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        self.taken.add(pairs[order], upto)
        self.places.add(place[order], upto)

    def _plain(self, at: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Whether occurrences of kept chunks skip none of the merges taken without dropout."""
        plain = np.ones(len(at), bool)
        if self.dropout <= 0:
            return plain
        # some at a time: the arrays of all merges of a step are many times its text
        for low in range(0, len(at), _AT_A_TIME):
            part = at[low : low + _AT_A_TIME]
            pairs, sizes = self.taken.of(part)
            places, _ = self.places.of(part)
            rows = np.repeat(np.arange(low, low + len(part)), sizes)
            drop = skips(pairs >> np.uint64(32), pairs & np.uint64(2**32 - 1), places, keys[rows], self.dropout)
            plain[rows[drop]] = False
        return plain

    def encode(self, texts: list[str | None], keys: list[str | None]) -> list[np.ndarray | None]:
        if len(self.kept) > MOST_CHUNKS or self.chars > MOST_CHARS:
            self.forget()
        cut = [self.pieces.cut(" " + t) if t else [] for t in texts]
        chunks = [c for part in cut for c in part]
        count = np.array([len(part) for part in cut], np.int64)
        last = np.cumsum(count)
        if new := [c for c in dict.fromkeys(chunks) if c not in self.kept]:
            self._learn(new)
        at = np.array([self.kept[c] for c in chunks], np.int64)
        number = np.arange(len(chunks)) - np.repeat(last - count, count)
        docs = np.repeat(np.array([self.key_of(k) for k in keys], np.uint64), count)
        own = mix(mix(docs) + number.astype(np.uint64))
        plain = self._plain(at, own)
        ids, sizes = self.ids.of(at[plain])
        counts = np.zeros(len(chunks), np.int64)
        counts[plain] = sizes
        odd = np.flatnonzero(~plain)
        if len(odd):
            others, ends = self.merge([chunks[i] for i in odd], own[odd], self.dropout)
            counts[odd] = np.diff(ends, prepend=0)
            out = np.empty(int(counts.sum()), np.int32)
            from_kept = np.repeat(plain, counts)
            out[from_kept], out[~from_kept] = ids, others
            ids = out
        ends = np.concatenate(([0], np.cumsum(counts)))
        bounds = zip(ends[last - count], ends[last], strict=True)
        return [None if text is None else ids[low:high] for text, (low, high) in zip(texts, bounds, strict=True)]


_PIECES: dict[str, Pieces] = {}
_ENCODERS: dict[tuple, Encoder] = {}


def _pieces(path: str) -> Pieces:
    if path not in _PIECES:
        _PIECES[path] = Pieces(path)
    return _PIECES[path]


def _forget() -> None:
    _ENCODERS.clear()
    _PIECES.clear()


def encoder(path: str, dropout: float, seed: int) -> Encoder:
    hold("pieces", _forget)
    if (path, dropout, seed) not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path, dropout, seed] = Encoder(path, dropout, seed)
    return _ENCODERS[path, dropout, seed]


_STEP = 1 << 19  # bytes of text encoded together


def _encoded(work: Encoder, texts: pa.Array, keys: pa.Array) -> Iterator[tuple[list, list]]:
    """Texts and their ids, some at a time."""
    for low, high in steps(texts, _STEP):
        part = texts[low:high].to_pylist()
        yield part, work.encode(part, keys[low:high].to_pylist())


def encode(text: Column, key: Column, path: str, dropout: float = 0.1, seed: int = 0) -> Column:
    """Ids of each text, with the dropout of its key."""

    @F.arrow_udf("array<int>")
    def encoded(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        work = encoder(path, dropout, seed)
        try:
            for texts, keys in batches:
                found = [ids for _, part in _encoded(work, texts, keys) for ids in part]
                yield pa.array(found, pa.list_(pa.int32()))
        finally:
            del work
            rest()

    return encoded(text, key.cast("string"))


def decode(ids: Column, path: str) -> Column:
    """Text of each array of ids."""

    @F.arrow_udf("string")
    def decoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pieces = _pieces(path)
        for batch in batches:
            yield pa.array([None if r is None else pieces.decode(r) for r in _rows(batch)], pa.string())

    return decoded(ids)


def _rows(batch: pa.Array) -> Iterator[np.ndarray | None]:
    """Each list of an array of lists as numbers."""
    flat = batch.flatten().to_numpy(zero_copy_only=False)
    at = 0
    for size in batch.value_lengths():
        yield flat[at : at + size.as_py()] if size.is_valid else None
        at += size.as_py() or 0


def round_trip(text: Column, key: Column, path: str, dropout: float = 0.1, seed: int = 0) -> Column:
    """(ids, ids_crc32, lossless) of each text: its pieces, their digest, and whether they decode to it.

    The digest is the crc32 of the ids as little-endian 32-bit numbers. One Python
    worker does what ``encode`` and ``decode`` would do in two.
    """
    kinds = [("ids", pa.list_(pa.int32())), ("ids_crc32", pa.int64()), ("lossless", pa.bool_())]

    @F.arrow_udf("struct<ids: array<int>, ids_crc32: long, lossless: boolean>")
    def judged(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        work = encoder(path, dropout, seed)
        try:
            for texts, keys in batches:
                ids, sums, same = [], [], []
                for part, found in _encoded(work, texts, keys):
                    ids += found
                    sums += [0 if i is None else crc32(i.astype("<u4").tobytes()) for i in found]
                    same += [t is None if i is None else work.pieces.decode(i) == t for t, i in zip(part, found, strict=True)]
                columns = [pa.array(c, t) for c, (_, t) in zip((ids, sums, same), kinds, strict=True)]
                yield pa.StructArray.from_arrays(columns, [n for n, _ in kinds])
        finally:
            del work
            rest()

    return judged(text, key.cast("string"))

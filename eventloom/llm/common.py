"""What the operators share: stored steps, slices of Arrow batches, hashing of words."""

from __future__ import annotations

import ctypes
import gc
import threading
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from eventloom.session import scratch_path

# Odd multipliers of the 64-bit hash functions, and the base of the word hash.
MIX_1, MIX_2, MIX_3 = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB
WORD_BASE = 0xD6E8FEB86659FD93

#: Bytes of text that one step of array work looks at; a longer text is a step of its own.
STEP_BYTES = 1 << 20


#: Spark's setting to remove the shuffle files of a statement at its end.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared folder and read again: cuts lineage, survives lost executors.

    Shuffle files of the write go at its end, as only what it stored is read from then on.
    """
    path, conf = scratch_path(df.sparkSession, f"llm-{name}"), df.sparkSession.conf
    before = conf.get(CLEAN_UP, "false")
    conf.set(CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.set(CLEAN_UP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(name: str, *frames: DataFrame) -> str:
    """``name``, with as many underscores behind it as no column of the frames has."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


_HELD: dict[str, Callable[[], None]] = {}
_HOLDING = threading.Lock()
_tasks = 0
#: Seconds after its last task in which a worker keeps what it holds.
REST_S = 2.0


def hold(name: str, forget: Callable[[], None]) -> None:
    """Make room for what ``name`` keeps between tasks in this worker: all others forget theirs.

    Workers are used again for later stages, where what earlier ones kept would add up.
    """
    global _tasks
    with _HOLDING:
        _tasks += 1
        if name in _HELD:
            return
        _forget_all()
        _HELD[name] = forget


def rest() -> None:
    """At a task's end: what this worker holds goes soon, unless another task asks for it before.

    An idle worker lives on for a minute, beside the stages that need no Python.
    """
    timer = threading.Timer(REST_S, _let_go, [_tasks])
    timer.daemon = True
    timer.start()


def _let_go(tasks: int) -> None:
    with _HOLDING:
        if tasks == _tasks:
            _forget_all()


def _forget_all() -> None:
    for name in list(_HELD):
        _HELD.pop(name)()
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)  # pages that earlier stages' arrays left free go back to the system


def steps(column: pa.Array, most: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a string column with at most ``most`` bytes each (or one row)."""
    lengths = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(lengths.buffers()[1], np.int64)[lengths.offset : lengths.offset + len(lengths) + 1]
    low = 0
    while low < len(column):
        high = int(np.searchsorted(offsets, offsets[low] + most, side="right")) - 1
        high = min(max(high, low + 1), len(column))
        yield low, high
        low = high


def mix(x: np.ndarray) -> np.ndarray:
    """A well-spread 64-bit hash of each 64-bit number."""
    x = x + np.uint64(MIX_1)
    x ^= x >> np.uint64(30)
    x *= np.uint64(MIX_2)
    x ^= x >> np.uint64(27)
    x *= np.uint64(MIX_3)
    x ^= x >> np.uint64(31)
    return x


def seeds(count: int, seed: int) -> np.ndarray:
    """``count`` odd 64-bit numbers that depend on ``seed`` alone."""
    return mix(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(MIX_1) + np.uint64(seed)) | np.uint64(1)


_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the word base and of its inverse modulo 2**64; only those for usual steps are kept."""
    if len(_POWERS[0]) >= n:
        return _POWERS[0], _POWERS[1]
    rows = []
    for base in (WORD_BASE, pow(WORD_BASE, -1, 1 << 64)):
        row = np.full(n, np.uint64(base))
        row[0] = 1
        rows.append(np.multiply.accumulate(row))
    if n <= 2 * STEP_BYTES:
        _POWERS[:] = rows
    return rows[0], rows[1]


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of the words of ``text``: runs of bytes other than space, tab and line ends."""
    return words_of(text)[0]


def words_of(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of ``text``, and the bytes at which they start."""
    data = np.frombuffer(text, np.uint8)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    edges = np.flatnonzero(np.diff(np.concatenate(([True], blank, [True])).view(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.empty(0, np.uint64), starts
    power, inverse = _powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts]), starts


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words; fewer words are one run as a whole."""
    if not len(words):
        return words
    size = min(size, len(words))
    n = len(words) - size + 1
    out = words[:n].copy()
    for k in range(1, size):
        out = mix(out * np.uint64(MIX_2) + words[k : k + n])
    return mix(out + np.uint64(size))

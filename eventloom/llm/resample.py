"""Importance resampling: draw the documents whose words look like those of a target.

Features of a text are its words and pairs of neighbouring words. They fall into a
fixed number of buckets by their checksum; a bucket's gain is the log ratio of its
smoothed share in the target and in the corpus. The gains are one array of bounded
size, and a document's weight is the floored mean of the gains of its features.
Gumbel noise from a keyed hash of the id turns the weights into a draw without
replacement: the highest scores are taken.

Scores are put in order by a distributed radix sort, least significant digit first.
Each pass is a stable counting sort: rows are counted by digit and block of
``BLOCK_BITS`` positions, prefix sums over (digit, block) say where each count starts,
and a row's place inside its block and digit does the rest. No task holds more than a
block of one digit, and prefix sums run over one digit's blocks at a time. Every pass
is stored, so a lost executor costs one pass at most.

Defined cases: a null or empty text has no features, weight 0; a null id is hashed
as the empty text and comes last among equal scores; repeated rows are scored each,
and equal (score, id) take neighbouring ranks in any order; an empty corpus draws
nothing and an empty target leaves the smoothed corpus shares; very long texts are
cut into pieces at word ends, and only pieces are held as lists of words; other
columns of the tables are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.common import stored

BUCKETS = 10_000
DIGIT_BITS = 12
BLOCK_BITS = 16
#: Bytes of a text whose words are held as a list at a time.
PIECE = 1 << 20

# A-Z become lower case, all other bytes below 128 but digits and letters become blanks.
_AS_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def feature_buckets(text: bytes, buckets: int = BUCKETS) -> Iterator[tuple[int, np.ndarray]]:
    """(number of words, buckets of the features that end in them) of each piece of a text."""
    text = text.translate(_AS_WORDS)
    low, last = 0, None
    while low < len(text):
        high = text.find(b" ", low + PIECE)
        high = len(text) if high < 0 else high
        words = text[low:high].split()
        low = high
        if not words:
            continue
        single = list(map(crc32, words))
        before = single[:-1] if last is None else [last, *single[:-1]]
        after = [b" " + word for word in (words[1:] if last is None else words)]
        # the checksum of a pair goes on where that of its first word ended
        found = np.array(single + list(map(crc32, after, before)), np.int64)
        last = single[-1]
        yield len(words), found % buckets


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all rows of ``texts`` (text) fall into each bucket.

    Every task adds up its own rows; the driver gets at most one row per bucket.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0):
                if text.is_valid:
                    for _, found in feature_buckets(text.as_py().encode(), buckets):
                        total += np.bincount(found, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": used, "n": total[used]})

    rows = texts.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for row in rows.collect():
        out[row.bucket] = row.n
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floored thousandfold log ratio of the smoothed share of each bucket in the target and in the corpus."""
    buckets = len(corpus)
    all_corpus, all_target = float(corpus.sum() + buckets), float(target.sum() + buckets)
    pairs = zip(corpus.tolist(), target.tolist(), strict=True)
    return np.array(
        [math.floor(1000 * math.log((t + 1) * all_corpus / ((s + 1) * all_target))) for s, t in pairs], np.int64
    )


def weighted(docs: DataFrame, gains: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of each row of ``docs`` (doc_id, text)."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros((3, batch.num_rows), np.int64)
            for i, text in enumerate(batch.column(1)):
                if not text.is_valid:
                    continue
                total = 0
                for words, found in feature_buckets(text.as_py().encode(), len(gains)):
                    out[0, i] += words
                    out[1, i] += len(found)
                    total += int(gains[found].sum())
                if out[1, i]:
                    out[2, i] = total // int(out[1, i])
            names = ["doc_id", "n_words", "n_features", "weight"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, out)], names)

    schema = "doc_id long, n_words long, n_features long, weight long"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(weigh, schema)


def noise(doc_id: Column, seed: int) -> Column:
    """Floored thousandfold Gumbel noise from a keyed hash of the id."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def _digits(rows: DataFrame, key: str, bits: int) -> list[Column]:
    """The digits of a long column that differ between rows, least significant first; NULLs are last."""
    low, high, nulls = rows.agg(F.min(key), F.max(key), F.count_if(F.col(key).isNull())).first()
    out = []
    if low is not None:
        span = high - low
        # differences over half of the number range do not fit, so there the sign bit is turned instead
        whole = F.col(key) - F.lit(low) if span < 1 << 63 else F.col(key).bitwiseXOR(F.lit(-(1 << 63)))
        width = span.bit_length() if span < 1 << 63 else 64
        mask = F.lit((1 << bits) - 1)
        for shift in range(0, max(width, 1), bits):
            out.append(F.coalesce(F.shiftrightunsigned(whole, shift).bitwiseAND(mask), F.lit(0)))
    if nulls or not out:
        out.append(F.col(key).isNull().cast("long"))
    return out


def _counting_pass(rows: DataFrame, digit: Column, block_bits: int) -> DataFrame:
    """``rows`` (..., at) with ``at`` set to the place in the stable order by ``digit``."""
    dealt = rows.withColumn("_digit", digit).withColumn("_block", F.shiftright("at", block_bits))
    counts = dealt.groupBy("_digit", "_block").agg(F.count("*").alias("_n"))
    earlier = Window.rowsBetween(Window.unboundedPreceding, -1)
    blocks = Window.partitionBy("_digit").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    inside = counts.withColumn("_inside", F.coalesce(F.sum("_n").over(blocks), F.lit(0)))
    # at most one row per value of a digit
    digits = counts.groupBy("_digit").agg(F.sum("_n").alias("_all"))
    starts = digits.select("_digit", F.coalesce(F.sum("_all").over(earlier.orderBy("_digit")), F.lit(0)).alias("_start"))
    offsets = inside.join(starts, "_digit").select("_digit", "_block", (F.col("_start") + F.col("_inside")).alias("_offset"))
    within = F.row_number().over(Window.partitionBy("_digit", "_block").orderBy("at")) - 1
    placed = dealt.withColumn("_within", within).join(offsets, ["_digit", "_block"])
    return placed.withColumn("at", F.col("_offset") + F.col("_within")).drop(
        "_digit", "_block", "_within", "_offset"
    )


def radix_ranked(
    rows: DataFrame, keys: Sequence[str], digit_bits: int = DIGIT_BITS, block_bits: int = BLOCK_BITS
) -> DataFrame:
    """``rows`` with ``rank`` (from 1) in ascending order of the long columns ``keys``, NULLs last."""
    rows = stored(rows.withColumn("at", F.monotonically_increasing_id()), "resample-keys")
    for key in reversed(keys):
        for digit in _digits(rows, key, digit_bits):
            rows = stored(_counting_pass(rows, digit, block_bits), "resample-pass")
    return rows.withColumn("rank", F.col("at") + 1).drop("at")


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 25,
    least_words: int = 20,
    seed: int = 7,
    buckets: int = BUCKETS,
    digit_bits: int = DIGIT_BITS,
    block_bits: int = BLOCK_BITS,
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of each row of ``docs`` (doc_id, text); undrawn rows have no rank.

    ``percent`` of the documents with ``least_words`` are drawn, towards ``target`` (text).
    """
    gains = bucket_gains(bucket_counts(docs, buckets), bucket_counts(target, buckets))
    scored = weighted(docs, gains)
    scored = stored(scored.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "resample-scored")
    eligible = F.col("n_words") >= least_words
    columns = ["doc_id", "n_features", "weight", "score"]
    ranked = radix_ranked(
        scored.where(eligible).select(*columns, (-F.col("score")).alias("_falling")),
        ["_falling", "doc_id"],
        digit_bits,
        block_bits,
    )
    drawn = percent * scored.where(eligible).count() // 100
    rank = F.when(F.col("rank") <= drawn, F.col("rank")).cast("long")
    others = scored.where(~eligible).select(*columns, F.lit(None).cast("long").alias("rank"))
    return ranked.select(*columns, rank.alias("rank")).unionByName(others)

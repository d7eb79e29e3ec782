from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import pytest

from eventloom.llm import resample

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = WORDS.findall(lower)
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def plain(docs, target, percent, least, seed, buckets):
    """(doc_id, n_features, weight, score, rank) by the definition."""

    def counts(texts):
        out = [0] * buckets
        for text in texts:
            for f in features(text)[1]:
                out[zlib.crc32(f.encode()) % buckets] += 1
        return out

    s, t = counts(text for _, text in docs), counts(target)
    gains = [
        math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t)
    ]
    rows = []
    for doc_id, text in docs:
        words, found = features(text)
        weight = sum(gains[zlib.crc32(f.encode()) % buckets] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((len(words), doc_id, len(found), weight, score))
    eligible = sorted((r for r in rows if r[0] >= least), key=lambda r: (-r[4], r[1] is None, r[1] or 0))
    drawn = {id(r): k + 1 for k, r in enumerate(eligible[: percent * len(eligible) // 100])}
    return [(*r[1:], drawn.get(id(r))) for r in rows]


def found(spark, docs, target, **options):
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' AS score", "1 AS at")
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    return [tuple(r) for r in resample.resample(frame, wanted, **options).collect()]


def test_against_the_definition(spark, monkeypatch):
    monkeypatch.setattr(resample, "PIECE", 40)  # so texts are cut
    rng = random.Random(5)
    vocabulary = ["alpha", "Beta", "GAMMA", "übung", "Ärger", "x1", "9", "漢字", "e"]
    docs = []
    for i in range(300):
        text = "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n", "-", "", "\x00"]) for _ in range(rng.randrange(60)))
        docs.append((rng.choice([i, i, -i * 10**12, 2**62 + i]), text))
    docs += [(5000, None), (5001, ""), (5002, "..."), (None, "alpha " * 30), (5003, "beta " * 30), (5003, "beta " * 30)]
    target = ["alpha beta alpha", None, "", "Beta x1 9"]
    want = plain(docs, target, 30, 8, 3, 64)
    options = {"percent": 30, "least_words": 8, "seed": 3, "buckets": 64, "digit_bits": 5, "block_bits": 3}
    got = found(spark, docs, target, **options)
    assert sorted(got, key=str) == sorted(want, key=str)
    assert sorted(r[4] for r in got if r[4]) == list(range(1, len([r for r in want if r[4]]) + 1))


@pytest.mark.parametrize("docs", [[], [(1, None)], [(1, "one two")]])
def test_small_tables(spark, docs):
    assert found(spark, docs, []) == plain(docs, [], 25, 20, 7, resample.BUCKETS)


def test_ranks_of_extreme_keys(spark):
    keys = [(2**63 - 1,), (-(2**63),), (0,), (None,), (-1,), (None,)]
    rows = spark.createDataFrame(keys, "k long").repartition(3)
    ranked = resample.radix_ranked(rows, ["k"], 12, 1).collect()
    assert [r.k for r in sorted(ranked, key=lambda r: r["rank"])] == [-(2**63), -1, 0, 2**63 - 1, None, None]
    assert sorted(r["rank"] for r in ranked) == list(range(1, 7))

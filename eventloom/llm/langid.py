"""Language identification: known words first, then ever shorter character n-grams.

Training counts words, and character n-grams of them, per language over a bounded
sample of labelled rows: about ``sample_docs`` rows of each language, chosen by a
hash of their id, or all if there are fewer. Each language gives its most frequent
words and n-grams, an equal share of ``max_words`` and ``max_grams``, so a language with
little text has as many as any other; the model's size is bounded and it may be broadcast.

Scoring adds up a vector of log frequencies per word of the whole text. A word of
the model has its own; another one has the mean over its longest n-grams that the
model knows, from ``LONGEST`` characters down to one; a word without any adds
nothing. The score is the posterior of the best language under equal priors.

Defined cases: null text or text without a letter is ``und`` with score 0, as is
every text when nothing could be learned; equal scores go to the smaller name;
rows with null language or text teach nothing; repeated rows are judged, and
count, each. Columns other than the named ones are kept, never looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.common import fresh, hold, rest

UNKNOWN = "und"
LONGEST = 5
MAX_LANGUAGES = 1000
#: Words that a Python worker keeps scored, in bytes of their vectors and as a number.
CACHE_BYTES, CACHE_WORDS = 64 << 20, 400_000
WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Model:
    languages: list[str]
    tokens: dict[str, int]  # words as they are, n-grams behind a tab
    scores: np.ndarray  # token by language: log frequency, less the row's mean


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+"), 0)


def _grams(word: Column) -> Column:
    """N-grams of a word, those of two characters or more between marks of its start and end."""

    def of_length(text: Column, n: int) -> Column:
        starts = F.sequence(F.lit(1), F.length(text) - n + 1)
        return F.when(F.length(text) >= n, F.transform(starts, lambda i: F.substring(text, i, F.lit(n))))

    marked = F.concat(F.lit("^"), word, F.lit("$"))
    longer = [of_length(marked, n) for n in range(2, LONGEST + 1)]
    return F.flatten(F.array_compact(F.array(of_length(word, 1), *longer)))


def train(
    labelled: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    sample_docs: int = 1500,
    max_words: int = 40_000,
    max_grams: int = 80_000,
) -> Model:
    """Model of the languages named in ``labelled``; see the module's text."""
    rows = labelled.select(
        F.col(id_col).cast("string").alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang")
    ).where("text is not null and lang is not null")
    counts = {r.lang: r["count"] for r in rows.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()}
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages = sorted(counts)
    if not languages:
        return Model([], {}, np.zeros((0, 0), np.float32))
    share = F.create_map(*[F.lit(x) for name in languages for x in (name, min(1.0, sample_docs / counts[name]))])
    drawn = F.pmod(F.xxhash64("key"), F.lit(1 << 20)) < F.element_at(share, F.col("lang")) * (1 << 20)
    words = (
        rows.where(F.coalesce(drawn, F.lit(False)))
        .select("lang", F.explode(_words(F.col("text"))).alias("token"))
        .groupBy("lang", "token")
        .agg(F.count("*").alias("n"))
    )
    grams = words.select("lang", F.explode(_grams(F.col("token"))).alias("token"), "n")

    def most_frequent(counted: DataFrame, most: int) -> list:
        """Tokens among the ``most / languages`` most frequent ones of some language, with their counts in all."""
        counted = counted.groupBy("token", "lang").agg(F.sum("n").alias("n"))
        rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "token"))
        chosen = counted.withColumn("rank", rank).where(F.col("rank") <= max(1, most // len(languages)))
        kept = counted.join(chosen.select("token").distinct(), "token", "left_semi").groupBy("token")
        return kept.agg(F.collect_list(F.struct("lang", "n")).alias("by")).orderBy("token").collect()

    place = {name: i for i, name in enumerate(languages)}
    tokens, tables = {}, []
    for prefix, found in (("", most_frequent(words, max_words)), ("\t", most_frequent(grams, max_grams))):
        table = np.full((len(found), len(languages)), 0.5)
        for i, row in enumerate(found):
            tokens[prefix + row.token] = len(tokens)
            for lang_name, n in row["by"]:
                table[i, place[lang_name]] += n
        kinds = np.array([len(r.token) if prefix else 0 for r in found], int)
        for kind in np.unique(kinds):  # frequencies are relative to tokens of the same length
            table[kinds == kind] /= table[kinds == kind].sum(axis=0)
        tables.append(np.log(table))
    scores = np.vstack(tables)
    return Model(languages, tokens, (scores - scores.mean(axis=1, keepdims=True)).astype(np.float32))


class Scorer:
    """Scores texts; keeps a bounded number of words scored."""

    def __init__(self, model: Model):
        self.model = model
        width = max(1, len(model.languages))
        self.most = max(1000, min(CACHE_WORDS, CACHE_BYTES // (4 * width)))
        self.table = np.zeros((self.most, width), np.float32)
        self.seen: dict[str, int] = {}

    def vector(self, word: str) -> np.ndarray | float:
        tokens, scores = self.model.tokens, self.model.scores
        if (i := tokens.get(word)) is not None:
            return scores[i]
        marked = f"^{word}$"
        for n in range(min(LONGEST, len(marked)), 0, -1):
            text = marked if n > 1 else word
            known = [j for k in range(len(text) - n + 1) if (j := tokens.get("\t" + text[k : k + n])) is not None]
            if known:
                return scores[known].mean(axis=0)
        return 0.0

    def total(self, words: list[str]) -> np.ndarray:
        found = list(map(self.seen.get, words))
        if None in found:
            for i, place in enumerate(found):
                if place is None:
                    word = words[i]
                    place = self.seen.get(word)
                    if place is None:
                        if len(self.seen) == self.most:  # start over with what this text has so far
                            done = self.table[found[:i]].sum(axis=0, dtype=np.float64)
                            self.seen.clear()
                            return done + self.total(words[i:])
                        place = self.seen[word] = len(self.seen)
                        self.table[place] = self.vector(word)
                    found[i] = place
        return self.table[found].sum(axis=0, dtype=np.float64)

    def judge(self, text: str | None) -> tuple[str, float]:
        words = WORD.findall(text.lower()) if text else []
        if not self.model.languages or not any(any(map(str.isalpha, w)) for w in words):
            return UNKNOWN, 0.0
        total = np.zeros(len(self.model.languages))
        for low in range(0, len(words), 100_000):
            total += self.total(words[low : low + 100_000])
        best = int(np.argmax(total))
        return self.model.languages[best], float(1 / np.exp(total - total[best]).sum())


def identify(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """Column of (lang, score) for the texts of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64())])

    @F.arrow_udf("struct<lang: string, score: double>")
    def judged(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = _scorer(shared)
        try:
            for batch in texts:
                yield pa.array([dict(zip(("lang", "score"), scorer.judge(t.as_py()), strict=True)) for t in batch], kind)
        finally:
            del scorer
            rest()

    return judged(F.col(text))


_SCORERS: dict[int, Scorer] = {}


def _scorer(shared) -> Scorer:
    """The worker's scorer of a broadcast model; that of an earlier model goes."""
    hold("language scorer", _SCORERS.clear)
    key = id(shared.value)
    if key not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[key] = Scorer(shared.value)
    return _SCORERS[key]


def held_out(doc_id: Column) -> Column:
    """Rows kept out of training: crc32 of the id as text leaves 2 on division by 4 (null: not kept out)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def teachable(docs: DataFrame) -> DataFrame:
    """The rows that are not held out."""
    return docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))


def predict(docs: DataFrame) -> DataFrame:
    """All rows with a column ``language_found`` of (lang, score), learned from the rows not held out.

    An input column of that name is replaced; all others are kept as they are.
    """
    return docs.withColumn("language_found", identify(docs, train(teachable(docs))))


def recognised(docs: DataFrame, margin: float = 1.2) -> DataFrame:
    """The rows with a language: ``margin`` times as likely as any language is without evidence, or more.

    A short text of rare words may score low in its own language, so the margin
    is small: it rejects texts in which nothing is known, and those without letters.
    """
    model = train(teachable(docs))
    least = min(0.999, margin / max(1, len(model.languages)))
    name = fresh("language_found", docs)
    found = docs.withColumn(name, identify(docs, model))
    known = (F.col(f"{name}.lang") != UNKNOWN) & (F.col(f"{name}.score") >= least)
    return found.where(known).select(*docs.columns)

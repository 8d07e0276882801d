"""Language identification by words first, backing off to ever shorter character n-grams."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable
from unicodedata import category

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.common import table

# Labelled documents that the model learns from, about: a classifier's bounded sample.
SAMPLE_DOCS = 4_000
# A word of the sample is known when it was seen so often; others are left to n-grams.
MIN_COUNT = 2
LONGEST = 5
SMOOTH = 0.5
# Unseen words whose scores a worker remembers.
REMEMBERED = 300_000
UNKNOWN = "und"
# Pairs of language and word whose n-grams are counted in one go.
CHUNK = 20_000
LETTERS = re.compile(r"[^\W\d_]+")
# Word characters that are neither digits nor letters: superscripts, fractions, Roman numbers.
NUMBERS = frozenset(c for c in map(chr, range(0x80, 0x110000)) if c.isalnum() and category(c)[0] != "L")
_BLANKS = dict.fromkeys(map(ord, NUMBERS), " ")


def words_of(text: str | None) -> list[str]:
    text = (text or "").lower()
    if not text.isascii() and not NUMBERS.isdisjoint(text):
        text = text.translate(_BLANKS)
    return LETTERS.findall(text)


class Table:
    """Log frequency per language of each key, from chunks of keys, languages and counts."""

    def __init__(self, chunks: Iterable[tuple[list[str], np.ndarray, np.ndarray]], langs: int):
        self.at: dict[str, int] = {}
        counts = np.zeros((1, langs))
        for keys, lang, count in chunks:
            rows = np.fromiter((self.at.setdefault(k, len(self.at)) for k in keys), np.int64, len(keys))
            if len(self.at) > len(counts):
                counts = np.concatenate([counts, np.zeros((max(len(self.at) - len(counts), len(counts)), langs))])
            np.add.at(counts, (rows, lang), count)
        counts = counts[: len(self.at)]
        self.totals = counts.sum(axis=1)
        self.scores = np.log((counts + SMOOTH) / (counts.sum(axis=0) + SMOOTH * (len(self.at) + 1)))


class Model:
    """Log frequencies per language of words, and of n-grams of each length."""

    def __init__(self, langs: list[str], words: list[str], lang: np.ndarray, times: np.ndarray):
        """From pairs of a word and a language (its place in ``langs``) with their counts."""
        self.langs = langs
        known = Table([(words, lang, times)], len(langs))
        self.scores = known.scores
        # A word that was hardly seen is judged like an unseen one.
        often = known.totals >= MIN_COUNT
        self.words = {w: i for w, i in known.at.items() if often[i]}
        self.grams = [Table(self._cuts(words, lang, times, n), len(langs)) for n in range(1, LONGEST + 1)]
        self.remembered: dict[str, np.ndarray] = {}

    @staticmethod
    def _cuts(words, lang, times, n):
        """The n-grams of all words, a chunk of words at a time."""
        for first in range(0, len(words), CHUNK):
            marked = [f" {w} " for w in words[first : first + CHUNK]]
            lengths = np.array([max(len(m) - n + 1, 0) for m in marked])
            grams = [m[k : k + n] for m in marked for k in range(len(m) - n + 1)]
            yield grams, np.repeat(lang[first : first + CHUNK], lengths), np.repeat(times[first : first + CHUNK], lengths)

    def unseen(self, word: str) -> np.ndarray:
        """Mean over the word's n-grams of the greatest length of which any is known."""
        if (score := self.remembered.get(word)) is None:
            marked, score = f" {word} ", np.zeros(len(self.langs))
            for n in range(min(LONGEST, len(marked)), 0, -1):
                at, logs = self.grams[n - 1].at, self.grams[n - 1].scores
                # The blank alone tells nothing.
                found = [at[g] for k in range(len(marked) - n + 1) if (g := marked[k : k + n]) in at and g != " "]
                if found:
                    score = logs[found].mean(axis=0)
                    break
            if len(self.remembered) > REMEMBERED:
                self.remembered.clear()
            self.remembered[word] = score
        return score

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """Language, its probability, and the share of words that are known."""
        counts = Counter(words_of(text))
        if not counts or not self.langs:
            return UNKNOWN, 0.0, 0.0
        rows, times, total, seen = [], [], np.zeros(len(self.langs)), 0
        for word, n in counts.items():
            if (row := self.words.get(word)) is None:
                total = total + n * self.unseen(word)
            else:
                rows.append(row)
                times.append(n)
                seen += n
        if rows:
            total = total + np.array(times) @ self.scores[rows]
        best = int(np.argmax(total))
        return self.langs[best], 1.0 / float(np.exp(np.maximum(total - total[best], -700)).sum()), seen / counts.total()


def held_out(doc_id: str = "doc_id"):
    """Documents that are never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, sample: int = SAMPLE_DOCS) -> Model:
    """Fit on about ``sample`` labelled documents, chosen by a hash of ``doc_id``.

    The bound is on the number of documents; their whole texts count. Rows without text or
    language, or held out, are not learned from.
    """
    usable = docs.filter(~held_out()).filter("lang is not null and text is not null and doc_id is not null")
    share = min(1.0, sample / max(1, usable.select("doc_id").count()))
    chosen = usable.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < math.ceil(share * 1_000_000))

    def count(batches):
        for batch in batches:
            found: Counter = Counter()
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                for word, n in Counter(words_of(text)).items():
                    found[lang, word] += n
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([k[0] for k in found], pa.string()), "word": pa.array([k[1] for k in found], pa.string()),
                "n": pa.array(list(found.values()), pa.int64()),
            })

    counts = chosen.select("lang", "text").mapInArrow(count, "lang string, word string, n long")
    rows = counts.groupBy("lang", "word").agg(F.sum("n").alias("n")).orderBy("lang", "word").toArrow()
    langs = sorted(set(rows.column("lang").unique().to_pylist()))
    lang = pc.index_in(rows.column("lang").combine_chunks(), pa.array(langs, pa.string())).to_numpy(False).astype(np.int64)
    return Model(langs, rows.column("word").to_pylist(), lang, rows.column("n").to_numpy().astype(np.float64))


def identify(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """``lang_pred, score, known`` for every row, next to the columns in ``keep``.

    ``lang_pred`` is a learned language, or ``und`` with score 0 where the text is null or
    has no letter (or nothing was learned); ``score`` is the language's probability under
    the model, ``known`` the share of words it has seen. Only the text is looked at; ties
    go to the language that sorts first. Each row is judged alone.
    """
    keep = keep or ["doc_id"]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample

    def run(batches):
        model = shared.value
        for batch in batches:
            found = [model.predict(t) for t in batch.column("text_").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("kept"), pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64()), pa.array([f[2] for f in found], pa.float64())],
                ["kept", "lang_pred", "score", "known"],
            )

    packed = docs.select(F.struct(*keep).alias("kept"), F.col("text").alias("text_"))
    kind = packed.schema["kept"].dataType.simpleString()
    found = packed.mapInArrow(run, f"kept {kind}, lang_pred string, score double, known double")
    return found.select("kept.*", "lang_pred", "score", "known")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    marked = docs.select("doc_id", "text", held_out().alias("held_out"))
    return identify(marked, train(docs), ["doc_id", "held_out"])

"""Language identification by word-first backoff.

Training counts every word of all labelled texts per language, and from those
counts every character n-gram (with word borders) of ``MAX_GRAM`` down to one
character. A word or n-gram is kept for a language if it makes up at least
``min_share`` of that language's words (n-grams of that length), so a model never
holds more than 1 / min_share entries per language and kind, whatever the corpus
(the share rises with the number of languages, see ``MAX_NUMBERS``).

Scoring takes each word of a text: a known word adds its log frequency in every
language; an unseen word is cut into its longest n-grams, and an unseen n-gram
into its two shorter ones, down to single characters. The language with the
highest sum wins; the score is its share of the posterior, at a temperature that
grows with the number of words (words of a text are not independent).
"""

from __future__ import annotations

import itertools
import functools
import math
import re
import sys
import unicodedata
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship, written

MAX_GRAM = 4
#: Smallest share of a language's words, and of its n-grams of a length, that is
#: kept: at most 50,000 words and 4 x 50,000 n-grams per language.
MIN_SHARE = 2e-5
#: Numbers a model holds at most (a row of one per language for each entry): with
#: more than eight languages the smallest share rises so that it stays below.
MAX_NUMBERS = 20_000_000
#: Words a task counts before it passes its counts on.
COUNT_WORDS = 300_000
#: Unseen words and n-grams a worker keeps worked out; beyond it they start anew.
KEPT = 300_000
UNKNOWN = "und"



_WORD = re.compile(r"[^\W\d_]+")


_BEYOND = re.compile("[\U00010000-\U0010ffff]")


@functools.cache
def _signs() -> tuple[re.Pattern, re.Pattern]:
    """Word characters of Python that are neither letters (Unicode categories L) nor
    decimal digits: fractions, powers, numbers in circles. Those up to U+FFFF are a class
    that is looked up in a table; the others would be gone through one by one, and are a
    class of their own for texts that have characters beyond."""
    found = [c for c in map(chr, range(sys.maxunicode + 1)) if c.isnumeric() and unicodedata.category(c) not in ("Lo", "Nd")]
    near, far = ("".join(c for c in found if (c > "\uffff") == beyond) for beyond in (False, True))
    return re.compile(f"[{re.escape(near)}]"), re.compile(f"[{re.escape(far)}]")


def words_of(text: str) -> list[str]:
    """Runs of letters, in lower case."""
    text = text.lower()
    if not text.isascii():
        near, far = _signs()
        if near.search(text):
            text = near.sub(" ", text)
        if _BEYOND.search(text):
            text = far.sub(" ", text)
    return _WORD.findall(text)


def grams_of(word: str, n: int) -> list[str]:
    """The word's n-grams, its borders marked by a blank; a shorter word is one."""
    w = f" {word} "
    return [w[k:k + n] for k in range(len(w) - n + 1)] or [w]


def word_counts(labelled: DataFrame) -> DataFrame:
    """(lang, word, n) over all texts of ``labelled`` (lang, text): each task adds
    up its own texts before anything is shuffled."""
    def run(batches):
        counts: dict[str, Counter] = {}

        def batch_of():
            rows = [(lang, w, n) for lang, c in counts.items() for w, n in c.items()]
            counts.clear()
            cols = list(zip(*rows)) if rows else [[], [], []]
            return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()),
                                               pa.array(cols[2], pa.int64())], names=["lang", "word", "n"])

        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):
                counts.setdefault(lang.as_py(), Counter()).update(words_of(text.as_py()))
                if sum(map(len, counts.values())) > COUNT_WORDS:
                    yield batch_of()
        yield batch_of()

    parts = labelled.select("lang", "text").mapInArrow(run, "lang string, word string, n bigint")
    return parts.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def frequent(counts: DataFrame, key: list[str], min_share: float) -> DataFrame:
    """Rows whose count is at least ``min_share`` of all with the same ``key``,
    with the total. The totals (a row per key) go to every task."""
    totals = counts.groupBy(*key).agg(F.sum("n").alias("total"))
    return counts.join(F.broadcast(totals), key).where(F.col("n") >= F.lit(min_share) * F.col("total"))


class Rows:
    """Rows of numbers by name: the known ones, and a bounded number of others
    that were worked out from them."""

    def __init__(self, table: dict[str, np.ndarray], width: int):
        self.at = {name: k for k, name in enumerate(table)}
        self.known = len(table)
        self.logs = np.array([*table.values()], float).reshape(len(table), width)

    def add(self, names: list[str], rows: np.ndarray) -> int:
        """The first of the new names' rows."""
        at = len(self.at)
        self.at.update(zip(names, range(at, at + len(names))))
        if at + len(names) > len(self.logs):
            self.logs = np.concatenate((self.logs, np.empty((1000 + at // 2 + len(names), self.logs.shape[1]))))
        self.logs[at:at + len(names)] = rows
        return at

    def trim(self, most: int) -> None:
        if len(self.at) - self.known > most:
            for name in list(itertools.islice(self.at, self.known, None)):
                del self.at[name]


class Model:
    """Log frequencies of words and n-grams, a row of numbers over the languages."""

    def __init__(self, rows: list[tuple[str, int, str, int, int]]):
        """Rows (lang, length, gram, n, total); length 0: whole words."""
        self.langs = sorted({r[0] for r in rows})
        of = {lang: k for k, lang in enumerate(self.langs)}
        totals: dict[int, dict[int, int]] = {}
        for lang, length, _, _, total in rows:
            totals.setdefault(length, {})[of[lang]] = total
        # What a language gives for an entry only others have: half an occurrence.
        least = {length: np.array([math.log(0.5 / t.get(k, 1)) for k in range(len(self.langs))])
                 for length, t in totals.items()}
        rows_of: tuple[dict[str, np.ndarray], ...] = ({}, {})  # words; n-grams of all lengths
        for lang, length, gram, n, total in rows:
            table = rows_of[length > 0]
            entry = table.get(gram)
            if entry is None:
                entry = table[gram] = least[length].copy()
            entry[of[lang]] = math.log(n / total)
        self.words, self.grams = (Rows(table, len(self.langs)) for table in rows_of)
        self.known = self.words.known

    def row(self, text: str) -> np.ndarray:
        at = self.gram(text)  # may enlarge the rows
        return self.grams.logs[at]

    def gram(self, text: str) -> int:
        """The row of an n-gram; of an unseen one the mean of its shorter ones."""
        at = self.grams.at.get(text)
        if at is None:
            at = self.grams.add([text], np.zeros(len(self.langs)) if len(text) <= 1 else
                                (self.row(text[:-1]) + self.row(text[1:])) / 2)
        return at

    def unseen(self, words: list[str]) -> None:
        """Give unseen words rows of their own, the mean over their n-grams."""
        self.grams.trim(KEPT)
        cut = [grams_of(w, MAX_GRAM) for w in words]
        seen = self.grams.at
        at = [seen[g] if g in seen else self.gram(g) for grams in cut for g in grams]
        n = np.fromiter(map(len, cut), np.int64, len(cut))
        self.words.add(words, np.add.reduceat(self.grams.logs[at], np.cumsum(n) - n) / n[:, None])

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, share of the posterior); und and 0 without letters."""
        counts = Counter(words_of(text or ""))
        if not counts or not self.langs:
            return UNKNOWN, 0.0
        self.words.trim(KEPT)
        row = self.words.at
        if new := [w for w in counts if w not in row]:
            self.unseen(new)
        at = np.fromiter(map(row.__getitem__, counts), np.int64, len(counts))
        n = np.fromiter(counts.values(), np.float64, len(counts))
        total = n @ self.words.logs[at]
        total /= math.sqrt(n.sum())
        p = np.exp(total - total.max())
        best = int(np.argmax(total))  # ties: the first in alphabetical order
        return self.langs[best], float(1 / p.sum())


def fit(labelled: DataFrame, min_share: float = MIN_SHARE) -> Model:
    """A model of all rows of ``labelled`` (lang, text) with neither null."""
    ship(labelled.sparkSession)
    rows = labelled.where("lang IS NOT NULL AND text IS NOT NULL")
    counts = written(word_counts(rows), "word-counts")
    langs = counts.select("lang").distinct().count()
    # Words by their borders and letters, as grams_of cuts them.
    padded = F.concat(F.lit(" "), F.col("word"), F.lit(" "))
    length = F.char_length(padded)

    def grams(n: int) -> Column:
        return F.transform(F.sequence(F.lit(1), F.greatest(length - n + 1, F.lit(1))), lambda k: F.struct(
            F.lit(n).alias("length"), F.substring(padded, k, F.lit(n)).alias("gram")))

    cut = (counts.select("lang", "n", F.explode(F.concat(*map(grams, range(1, MAX_GRAM + 1)))).alias("g"))
           .groupBy("lang", "g.length", "g.gram").agg(F.sum("n").alias("n")))
    words = counts.select("lang", F.lit(0).alias("length"), F.col("word").alias("gram"), "n")
    share = max(min_share, (MAX_GRAM + 1) * langs**2 / MAX_NUMBERS)
    kept = frequent(words.unionByName(cut), ["lang", "length"], share)
    # At most MAX_NUMBERS / langs rows.
    return Model([tuple(r) for r in kept.select("lang", "length", "gram", "n", "total").collect()])


def learns_from(id_col: Column, folds: int = 4, held: int = 2) -> Column:
    """Rows that training may use: crc32(id as text) mod ``folds`` is not ``held``.
    Rows without an id are used for nothing but prediction."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % folds != held, F.lit(False))


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` without the text, with lang_pred and score (0 to 1) of each whole
    text. ``und`` and 0 where the text is null or has no letter. Row-wise."""
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(model)
    src = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != text_col], F.col(f"`{text_col}`").cast("string"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1]]
                       + ["lang_pred string", "score double"])

    def run(batches):
        for batch in batches:
            found = [sent.value.predict(t.as_py()) for t in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64())],
                names=[*batch.schema.names[:-1], "lang_pred", "score"])

    return src.mapInArrow(run, schema)


def accepted(docs: DataFrame, model: Model, text_col: str = "text", min_lift: float = 1.2) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text is in a learned
    language: it has letters, and the best language's score is at least
    ``min_lift`` times chance (with one language: any score). A model without a
    language (no row was labelled) can reject nothing."""
    if not model.langs:
        return docs
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)
    least = min_lift / len(model.langs) if len(model.langs) > 1 else 0.0

    def run(batches):
        for batch in batches:
            found = [sent.value.predict(t.as_py()) for t in batch.column(at)]
            yield batch.filter(pa.array([lang != UNKNOWN and score >= least for lang, score in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)

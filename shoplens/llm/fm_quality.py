"""Quality classifier: a factorisation machine over a document's words, structure
and metadata.

Features: every distinct word, hashed into ``buckets`` (weight: log(1 + count),
all words of a text scaled to unit length); statistics of the text's structure
(shares of kinds of characters, word and line lengths, repetition), each as the
bucket of a value in its range; metadata columns, by the logarithm of a number or
the hash of a string. The score of a document is

    w0 + sum_i w_i x_i + 1/2 sum_f [ (sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2 ]

through the logistic function: all pairwise interactions of rank ``rank`` in time
linear in the features.

Fit on a bounded sample of the labelled rows (at most ``MAX_FIT_ROWS``, those
with the smallest hash of their id; of each sampled text only the features are
kept): this bound is a parameter of the classifier, and the model's size is fixed
by ``buckets`` and ``rank``. Every row is scored on its whole text.
"""

from __future__ import annotations

import itertools
import math
import operator
import string
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

BUCKETS = 1 << 14
RANK = 8
#: Labelled rows a model is fitted on, at most.
MAX_FIT_ROWS = 20_000
#: Passes over the sample; step size; penalties; the fit's seed.
EPOCHS, STEP, SEED = 12, 0.05, 7
L2 = 1e-5
#: Buckets of one structure statistic or metadata number.
LEVELS = 24

_MARKS = string.punctuation.encode()
_DIGITS = string.digits.encode()


def statistics(text: str, words: list[str], counts: Counter) -> list[float]:
    """Structure of a text, each value from 0 to 1."""
    data = text.encode()
    n, m = max(len(data), 1), max(len(words), 1)
    lines = [line for line in text.split("\n") if line.strip()] or [""]
    marks, digits = (len(data) - len(data.translate(None, kind)) for kind in (_MARKS, _DIGITS))
    upper = sum(k for w, k in counts.items() if w.isupper())
    title = sum(k for w, k in counts.items() if w.istitle())
    same = sum(map(operator.eq, words, itertools.islice(words, 1, None)))
    return [marks / n, min(1.0, 4 * digits / n), upper / m, title / m, len(counts) / m,
            max(counts.values(), default=0) / m, same / m, min(1.0, len(data) / m / 20), min(1.0, math.log1p(m) / 12),
            min(1.0, math.log1p(n) / 14), min(1.0, n / len(lines) / 1000), len(set(lines)) / len(lines),
            min(1.0, math.log1p(len(lines)) / 8), sum(x.rstrip().endswith((".", "!", "?")) for x in lines) / len(lines)]


N_STATISTICS = 14


class Features:
    """Turns a text and its metadata into (feature numbers, values)."""

    def __init__(self, buckets: int, n_metadata: int):
        self.buckets, self.n_metadata = buckets, n_metadata
        self.size = buckets + (N_STATISTICS + n_metadata) * (LEVELS + 1)
        self.cache: dict[str, int] = {}

    def __getstate__(self):
        return self.__dict__ | {"cache": {}}

    def word(self, w: str) -> int:
        return zlib.crc32(w.encode()) % self.buckets

    def __call__(self, text: str | None, metadata: tuple = ()) -> tuple[np.ndarray, np.ndarray]:
        text = text or ""
        words = text.split()
        counts = Counter(words)
        lower: dict[str, int] = {}
        for w, k in counts.items():
            w = w.lower()
            lower[w] = lower.get(w, 0) + k
        cache = self.cache
        if len(cache) > 300_000:
            cache.clear()
        cache.update((w, self.word(w)) for w in lower if w not in cache)
        at = list(map(cache.__getitem__, lower))
        value = np.log1p(np.fromiter(lower.values(), np.float64, len(lower)))
        norm = math.sqrt(float(value @ value)) or 1.0
        extra, base = [], self.buckets
        for x in statistics(text, words, counts):
            extra.append(base + min(LEVELS - 1, int(x * LEVELS)))
            base += LEVELS + 1
        for x in metadata:  # a missing value has a level of its own
            if x is None or x != x:
                level = LEVELS
            elif isinstance(x, str):
                level = zlib.crc32(x.encode()) % LEVELS
            else:
                level = min(LEVELS - 1, int(1.5 * math.log1p(abs(float(x)))))
            extra.append(base + level)
            base += LEVELS + 1
        return (np.array(at + extra, np.int64),
                np.concatenate((value / norm, np.full(len(extra), 1 / math.sqrt(len(extra))))))


class Machine:
    """The factorisation machine's numbers."""

    def __init__(self, features: Features, rank: int, seed: int):
        self.features = features
        self.w0 = 0.0
        self.w = np.zeros(features.size)
        self.v = np.random.default_rng(seed).normal(0, 0.05, (features.size, rank))

    def raw(self, at: np.ndarray, x: np.ndarray) -> float:
        xv = x[:, None] * self.v[at]
        s = xv.sum(axis=0)
        return self.w0 + float(self.w[at] @ x) + 0.5 * float(s @ s - (xv * xv).sum())

    def score(self, text: str | None, metadata: tuple = ()) -> float:
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, self.raw(*self.features(text, metadata))))))

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int, step: float, l2: float,
            seed: int) -> None:
        """Adaptive gradient steps (AdaGrad) on the logistic loss, rows in seeded
        order."""
        n1 = labels.sum()
        if not 0 < n1 < len(labels):  # one label only: its share
            self.w0 = math.log((n1 + 1) / (len(labels) - n1 + 1))
            self.v[:] = 0
            return
        rng = np.random.default_rng(seed)
        gw0, gw, gv = 1e-8, np.full(len(self.w), 1e-8), np.full(self.v.shape, 1e-8)
        for _ in range(epochs):
            for k in rng.permutation(len(rows)).tolist():
                at, x = rows[k]
                va, wa = self.v[at], self.w[at]
                xv = x[:, None] * va
                s = xv.sum(axis=0)
                raw = self.w0 + float(wa @ x) + 0.5 * float(s @ s - (xv * xv).sum())
                g = 1 / (1 + math.exp(-max(-500.0, min(500.0, raw)))) - labels[k]
                gw0 += g * g
                self.w0 -= step * g / math.sqrt(gw0)
                dw = g * x + l2 * wa
                gw[at] += dw * dw
                self.w[at] = wa - step * dw / np.sqrt(gw[at])
                dv = g * (x[:, None] * s - x[:, None] * xv) + l2 * va
                gv[at] += dv * dv
                self.v[at] = va - step * dv / np.sqrt(gv[at])


def fit(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id",
        label_col: str = "quality", metadata: tuple[str, ...] = (), buckets: int = BUCKETS, rank: int = RANK,
        max_rows: int = MAX_FIT_ROWS, epochs: int = EPOCHS, seed: int = SEED) -> Machine:
    """A machine fitted on the rows of ``labels`` (0 or 1; others and nulls are
    left out) whose ids ``docs`` has. A repeated id takes its smallest label, and
    each of its rows is an example."""
    spark = docs.sparkSession
    ship(spark)
    known = (labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).cast("bigint").alias("id")).agg(F.min(label_col).cast("int").alias("label")))
    chosen = known.orderBy(F.xxhash64(F.lit(seed), "id"), "id").limit(max_rows)
    extra = [F.col(f"`{c}`") for c in metadata]
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").alias("text"),
                       F.struct(F.lit(0), *extra).alias("more")).join(F.broadcast(chosen), "id")
    features = Features(buckets, len(metadata))

    def run(batches):
        for batch in batches:
            found = [features(t.as_py(), tuple(m.as_py().values())[1:])
                     for t, m in zip(batch.column(1), batch.column(2))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(3), pa.array([a.astype(np.int32).tobytes() for a, _ in found], pa.binary()),
                 pa.array([x.astype(np.float32).tobytes() for _, x in found], pa.binary())],
                names=["id", "label", "at", "x"])

    seen = (rows.select("id", "text", "more", "label").mapInArrow(run, "id bigint, label int, at binary, x binary")
            .orderBy(F.xxhash64(F.lit(seed), "id"), "id", "at", "x").limit(max_rows))

    def train(batches):
        rows, label = [], []
        for batch in batches:
            label += batch.column(1).to_pylist()
            rows += [(np.frombuffer(a.as_py(), np.int32).astype(np.int64),
                      np.frombuffer(x.as_py(), np.float32).astype(np.float64))
                     for a, x in zip(batch.column(2), batch.column(3))]
        if rows:
            machine = Machine(features, rank, seed)
            machine.fit(rows, np.array(label), epochs, STEP, L2, seed)
            yield pa.RecordBatch.from_arrays([pa.array([machine.w.tobytes()]), pa.array([machine.v.tobytes()]),
                                              pa.array([machine.w0])], names=["w", "v", "w0"])

    machine = Machine(features, rank, seed)
    got = seen.repartition(1).mapInArrow(train, "w binary, v binary, w0 double").collect()
    if got:
        machine.w, machine.w0 = np.frombuffer(got[0]["w"]), got[0]["w0"]
        machine.v = np.frombuffer(got[0]["v"]).reshape(features.size, rank)
    else:
        machine.v = np.zeros_like(machine.v)
    return machine


def score(docs: DataFrame, machine: Machine, text_col: str = "text", metadata: tuple[str, ...] = (),
          threshold: float = 0.7) -> DataFrame:
    """``docs`` without text and metadata columns, with score (0 to 1) and
    predicted (1 from ``threshold`` on) of each whole text. Null texts are empty
    texts; an empty text is scored by its structure and metadata. Row-wise."""
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(machine)
    left = [c for c in docs.columns if c not in (text_col, *metadata)]
    src = docs.select(*[F.col(f"`{c}`") for c in left], F.col(f"`{text_col}`").cast("string").alias(text_col),
                      F.struct(F.lit(0), *[F.col(f"`{c}`") for c in metadata]).alias("_more"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:len(left)]]
                       + ["score double", "predicted int"])

    def run(batches):
        for batch in batches:
            p = [sent.value.score(t.as_py(), tuple(m.as_py().values())[1:])
                 for t, m in zip(batch.column(len(left)), batch.column(len(left) + 1))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(left)], pa.array(p, pa.float64()),
                 pa.array([int(x >= threshold) for x in p], pa.int32())],
                names=[*left, "score", "predicted"])

    return src.mapInArrow(run, schema)

"""Benchmark decontamination by greedy string tiling.

Seeds: every run of ``min_match`` words of a benchmark item, by its Karp-Rabin
hash. The documents are joined with the seeds while they are read: a block of
seeds (its size is bounded, see ``BLOCK_WORDS``) is broadcast, and a benchmark of
any size is taken in as many blocks as it needs. For a document and each item it
shares seeds with, where the shared seeds could cover enough of the item at all,
tiles are placed: from the longest match down, every maximal match that doesn't
overlap a tile is marked on both sides, then the search length is lowered and the
unmarked parts are hashed again, until ``min_match``. Tiles may come in any order,
so reordered passages are found as well as whole ones. A pair is a hit when its
tiles cover ``threshold`` of the item's words.

An item of fewer than ``min_match`` words has one seed, all its words, and is a hit
where they stand together in a document.

Words are runs without white space and ASCII punctuation, in lower case; in scripts
that are written without blanks every character is a word.
"""

from __future__ import annotations

import re
import string

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, table

MIN_MATCH = 5
THRESHOLD = 0.6
#: Benchmark words of one broadcast block: about 30 MB as Python objects.
BLOCK_WORDS = 200_000

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_TO_BLANK = str.maketrans({c: " " for c in string.punctuation})
#: Scripts without blanks: Thai, Lao, Tibetan, Myanmar, Khmer, kana, Han.
_NO_BLANKS = re.compile("[\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff"
                        "\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")


def words_of(text: str | None) -> list[str]:
    text = (text or "").lower().translate(_TO_BLANK)
    if not text.isascii() and _NO_BLANKS.search(text):
        text = _NO_BLANKS.sub(r" \g<0> ", text)
    return text.split()


def hashes(ids: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hash (modulo 2^64) of every run of ``length`` ids. Running sums with the
    base's inverse make it as cheap for long runs as for short ones."""
    n = len(ids) - length + 1
    if n <= 0 or length == 0:
        return np.zeros(max(n, 0), np.uint64)
    with np.errstate(over="ignore"):
        up = np.cumprod(np.full(len(ids), _BASE))
        down = np.concatenate(([np.uint64(1)], np.cumprod(np.full(len(ids) - 1, _INVERSE))))
        sums = np.concatenate(([np.uint64(0)], np.cumsum(ids.astype(np.uint64) * down, dtype=np.uint64)))
        scale = np.concatenate(([np.uint64(1)], up))[length - 1:length - 1 + n]
        return (sums[length:] - sums[:n]) * scale


def tile(item: np.ndarray, doc: np.ndarray, min_match: int) -> list[tuple[int, int, int]]:
    """Tiles (start in item, start in doc, length), longest first, not overlapping
    on either side. Ids of zero match nothing."""
    out, free_item, free_doc = [], np.ones(len(item), bool), doc != 0
    top = longest_match(item, doc, free_item, free_doc, min_match)
    while top >= min_match:
        mark(item, doc, free_item, free_doc, top, out)
        top = min(top, longest_match(item, doc, free_item, free_doc, min_match))
    return out


def _equal_hashes(item, doc, free_item, free_doc, length: int):
    """Unmarked runs of ``length`` of the item whose hash the document has too: their
    starts, and for each the first and last place in the document's starts, which are
    sorted by hash and then place. Nothing is listed pair by pair."""
    at_item, at_doc = (np.flatnonzero(runs(free, length)) for free in (free_item, free_doc))
    h_item, h_doc = hashes(item, length)[at_item], hashes(doc, length)[at_doc]
    order = np.argsort(h_doc, kind="stable")
    h_doc, at_doc = h_doc[order], at_doc[order]
    lo, hi = np.searchsorted(h_doc, h_item, "left"), np.searchsorted(h_doc, h_item, "right")
    some = hi > lo
    return at_item[some], lo[some], hi[some], at_doc


def mark(item, doc, free_item, free_doc, length: int, out: list) -> None:
    """Mark matches of ``length`` in item order, each at the first place of the document
    that is still free. Places passed over because they are taken are never looked at again."""
    at_item, lo, hi, at_doc = _equal_hashes(item, doc, free_item, free_doc, length)
    next_place: dict[int, int] = {}  # by the start of the places of a hash
    for i, a, b in zip(at_item.tolist(), lo.tolist(), hi.tolist()):
        if not free_item[i:i + length].all():
            continue
        k = next_place.get(a, a)
        while k < b and not free_doc[at_doc[k]:at_doc[k] + length].all():
            k += 1
        next_place[a] = k
        while k < b:
            d = int(at_doc[k])
            if free_doc[d:d + length].all() and (item[i:i + length] == doc[d:d + length]).all():
                out.append((i, d, length))
                free_item[i:i + length] = False
                free_doc[d:d + length] = False
                break
            k += 1  # other words of the same hash


def any_match(item, doc, free_item, free_doc, length: int) -> bool:
    """Whether an unmarked run of ``length`` stands in both."""
    at_item, lo, hi, at_doc = _equal_hashes(item, doc, free_item, free_doc, length)
    return any((item[i:i + length] == doc[d:d + length]).all()
               for i, a, b in zip(at_item.tolist(), lo.tolist(), hi.tolist()) for d in at_doc[a:b])


def runs(free: np.ndarray, length: int) -> np.ndarray:
    """Where a run of ``length`` free places starts."""
    total = np.concatenate(([0], np.cumsum(free)))
    return total[length:] - total[:-length] == length if len(free) >= length else np.zeros(0, bool)


def longest_match(item, doc, free_item, free_doc, min_match: int) -> int:
    """Length of the longest unmarked match, by halving: if a length matches, so
    does every shorter one. Below ``min_match``: 0."""
    lo, hi = min_match - 1, min(len(item), len(doc))
    while lo < hi:
        middle = (lo + hi + 1) // 2
        if any_match(item, doc, free_item, free_doc, middle):
            lo = middle
        else:
            hi = middle - 1
    return lo if lo >= min_match else 0


class Seeds:
    """A block of benchmark items and their seeds."""

    def __init__(self, items: list[tuple[int, list[str]]], min_match: int, threshold: float):
        self.min_match, self.threshold = min_match, threshold
        self.word = {}
        for _, words in items:
            for w in words:
                self.word.setdefault(w, len(self.word) + 1)
        self.items = [(i, self.ids(words)) for i, words in items]
        # By length: the seeds' hashes, and in which item and where in it they are.
        self.seeds: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        length = [min(min_match, len(ids)) for _, ids in self.items]
        for m in sorted(set(length) - {0}):
            of = [k for k, n in enumerate(length) if n == m]
            h = [hashes(self.items[k][1], m) for k in of]
            every = np.concatenate(h)
            order = np.argsort(every, kind="stable")
            self.seeds[m] = (every[order], np.repeat(of, [len(x) for x in h])[order],
                             np.concatenate([np.arange(len(x)) for x in h])[order])

    def ids(self, words: list[str]) -> np.ndarray:
        """Word numbers; 0 for words that no item has."""
        get = self.word.get
        return np.fromiter((get(w, 0) for w in words), np.uint64, len(words))

    def find(self, text: str | None) -> list[tuple[int, float, int, int, list]]:
        """(item, covered share, words in tiles, longest tile, tiles) of the hits."""
        doc = self.ids(words_of(text))
        return [hit for m in self.seeds for hit in self.find_seeds(doc, m)]

    def find_seeds(self, doc: np.ndarray, m: int) -> list[tuple[int, float, int, int, list]]:
        """The hits among the items with seeds of ``m`` words."""
        if len(doc) < m:
            return []
        seed_hash, seed_of, seed_at = self.seeds[m]
        start = np.flatnonzero(runs(doc != 0, m))
        if not len(start):
            return []
        h = hashes(doc, m)[start]
        lo = np.searchsorted(seed_hash, h, "left")
        seen = seed_hash[np.minimum(lo, len(seed_hash) - 1)] == h
        if not seen.any():
            return []
        start = start[seen]
        # Where in which item the document's seeds lie, each seed once however often the
        # document has it.
        distinct = np.unique(h[seen])
        lo = np.searchsorted(seed_hash, distinct, "left")
        count = np.searchsorted(seed_hash, distinct, "right") - lo
        k = np.repeat(lo, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        of, at = seed_of[k], seed_at[k]
        near = np.zeros(len(doc), bool)
        for j in range(m):
            near[start + j] = True
        # Only the seeded stretches are tiled, each with a non-word behind it.
        place = np.flatnonzero(near | np.concatenate(([False], near[:-1])))
        seeded = np.where(near, doc, 0)[place]
        share = self.threshold if m == self.min_match else 1.0
        out = []
        for item in np.unique(of):
            number, ids = self.items[item]
            covered = np.zeros(len(ids), bool)
            for j in range(m):
                covered[at[of == item] + j] = True
            if covered.sum() < share * len(ids):
                continue  # tiles are made of seeds: they can't cover more
            tiles = [(i, int(place[d]), n) for i, d, n in tile(ids, seeded, m)]
            total = sum(n for _, _, n in tiles)
            if total >= share * len(ids):
                out.append((number, total / len(ids), total, max(n for _, _, n in tiles), tiles))
        return out


def seed_blocks(benchmark: DataFrame, id_col: str, text_col: str, min_match: int, threshold: float,
                block_words: int = BLOCK_WORDS):
    """The benchmark as blocks of seeds, streamed to the driver one partition at a
    time; a block holds at most ``block_words`` words or a single item."""
    rows = benchmark.select(F.col(f"`{id_col}`").cast("bigint"), F.col(f"`{text_col}`").cast("string"))
    block, size = [], 0
    for number, text in rows.toLocalIterator():
        words = words_of(text)
        if not words:
            continue
        if block and size + len(words) > block_words:
            yield Seeds(block, min_match, threshold)
            block, size = [], 0
        block.append((number, words))
        size += len(words)
    if block:
        yield Seeds(block, min_match, threshold)


def contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                 item_col: str = "item_id", item_text_col: str = "text", min_match: int = MIN_MATCH,
                 threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs`` and benchmark item it holds: doc_id, item_id,
    coverage (share of the item's words in tiles), n_tiles, tile_words,
    longest_tile, tiles (start in item, start in document, length; in words).

    Null and empty texts hit nothing. Items of fewer than ``min_match`` words
    are hit only whole. Repeated rows give repeated hits.
    """
    spark = docs.sparkSession
    ship(spark)
    src = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
                      F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = ("doc_id bigint, item_id bigint, coverage double, n_tiles int, tile_words int, longest_tile int, "
              "tiles array<struct<item_at:int,doc_at:int,words:int>>")
    kind = pa.list_(pa.struct([("item_at", pa.int32()), ("doc_at", pa.int32()), ("words", pa.int32())]))
    out = None
    for seeds in seed_blocks(benchmark, item_col, item_text_col, min_match, threshold):
        sent = spark.sparkContext.broadcast(seeds)

        def run(batches, sent=sent):
            seeds = sent.value
            for batch in batches:
                rows = [(d.as_py(), *hit) for d, t in zip(batch.column(0), batch.column(1))
                        for hit in seeds.find(t.as_py())]
                cols = list(zip(*rows)) if rows else [[]] * 6
                yield pa.RecordBatch.from_arrays([
                    pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.float64()),
                    pa.array([len(t) for t in cols[5]], pa.int32()), pa.array(cols[3], pa.int32()),
                    pa.array(cols[4], pa.int32()),
                    pa.array([[dict(zip(("item_at", "doc_at", "words"), x)) for x in t] for t in cols[5]], kind)],
                    names=["doc_id", "item_id", "coverage", "n_tiles", "tile_words", "longest_tile", "tiles"])

        part = src.mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], schema)


def clean_documents(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                    item_text_col: str = "text", min_match: int = MIN_MATCH,
                    threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with all their columns."""
    spark = docs.sparkSession
    ship(spark)
    at = docs.columns.index(text_col)
    for seeds in seed_blocks(benchmark, item_col, item_text_col, min_match, threshold):
        sent = spark.sparkContext.broadcast(seeds)

        def run(batches, sent=sent):
            seeds = sent.value
            for batch in batches:
                yield batch.filter(pa.array([not seeds.find(t.as_py()) for t in batch.column(at)], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def benchmark_table(spark, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark", "item_id", "text")

"""Removal of passages that stand elsewhere too, by level-wise doubling of windows.

A window is a run of words of one document. On the first level, all windows of a short
length are looked up for others with the same words. Only windows that are repeated are
extended to twice the length (on the last level to the length asked for, where the two
halves overlap); the extended ones are looked up again, until the length is reached or no
candidate survives. A window can't be repeated unless both halves and all between them
are, so a level keeps nothing but runs of words, long enough for the length asked for, in
which every window of the level is repeated.

Documents are packed into blocks of words as numbers. A level sends each block's distinct
window fingerprints, sorted, to the parts that fingerprints are dealt to; a part finds those
that another block has too and returns one bit for each. What a part reads grows with the
number of blocks a fingerprint stands in, not with its occurrences, so a window that a third
of all documents hold is one number a block. Parts are as many as keep each at about
``PART_KEYS`` numbers.

Fingerprints are put together as the windows are: that of twice the length is mixed from
those of the two halves. Levels before the last send ``FILTER_BITS`` bits beside the part
number, and may let a window through by chance; the last one compares 128 bits. At 10^13
windows, the chance that any two different ones share all of them is below 10^-12.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, written
from .ppm import pack, unpack
from .word_blocks import (BLOCK_BYTES, cut_into_blocks, numbered, one_row, only_used, pack_words, rows_of,
                          unpack_words)

WINDOW = 35
#: Words of the windows of the first level.
FIRST = 9
PART_KEYS = 1 << 21
FILTER_BITS = 28

_STATE = {"block": pa.int64(), "starts": pa.binary(), "counts": pa.binary(), "words": pa.binary(),
          "letters": pa.binary(), "lengths": pa.binary(), "n_words": pa.int64()}
_STATE_SQL = ("block bigint, starts binary, counts binary, words binary, letters binary, lengths binary, "
              "n_words bigint")
_LANES = ((0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 31), (0xC2B2AE3D27D4EB4F, 0xA0761D6478BD642F, 23))


def lengths_of(window: int, first: int) -> list[int]:
    """Window lengths by level: twice the one before, the last as asked for."""
    out = [min(first, window)]
    while out[-1] < window:
        out.append(min(2 * out[-1], window))
    return out


# ----- fingerprints ----------------------------------------------------------------------------

def mixed(left: np.ndarray, right: np.ndarray, lane: int) -> np.ndarray:
    """Fingerprints of left followed by right."""
    one, two, turn = _LANES[lane]
    with np.errstate(over="ignore"):
        h = left * np.uint64(one) + (right << np.uint64(turn) | right >> np.uint64(64 - turn))
        h ^= h >> np.uint64(32)
        h *= np.uint64(two)
        h ^= h >> np.uint64(29)
    return h


def fingerprints(numbers: np.ndarray, words: list[bytes], length: int, lanes: int) -> list[np.ndarray]:
    """Of the run of ``length`` words from each place on, by lane (64 bits each)."""
    digests = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), "<u8").reshape(-1, 2)
    out = []
    for lane in range(lanes):
        h = digests[:, lane][numbers]
        size = 1
        while size < length:
            step = min(size, length - size)  # the last step overlaps
            h = mixed(h[:len(h) - step], h[step:], lane) if len(h) > step else h[:0]
            size += step
        out.append(h)
    return out


class Windows:
    """The windows of one length in a block's runs: their places, their distinct keys in the
    order they are dealt out (part by part), and which key each has."""

    def __init__(self, row: dict, length: int, parts: int, last: bool):
        self.length = length
        self.starts, self.counts = unpack(row["starts"], "<u4").astype(np.int64), unpack(row["counts"], "<u4").astype(np.int64)
        self.numbers = unpack(row["words"], "<u4").astype(np.int64)
        self.words = unpack_words(row["letters"], row["lengths"])
        self.ends = np.cumsum(self.counts)
        fits = np.maximum(self.counts - length + 1, 0)
        self.place = np.arange(int(fits.sum())) - np.repeat(np.cumsum(fits) - fits - (self.ends - self.counts), fits)
        lanes = [h[self.place] for h in fingerprints(self.numbers, self.words, length, 2 if last else 1)]
        part = ((lanes[0] >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
        if not last:
            lanes = [lanes[0] & np.uint64((1 << FILTER_BITS) - 1)]
        order = np.lexsort((*lanes[::-1], part))
        new = np.ones(len(order), bool)
        if len(order):
            new[1:] = np.any([c[order][1:] != c[order][:-1] for c in (part, *lanes)], axis=0)
        key = np.cumsum(new) - 1
        self.key = np.empty(len(order), np.int64)
        self.key[order] = key
        self.often = np.bincount(key) > 1
        self.part, self.lanes = part[order][new].astype(np.int64), [c[order][new] for c in lanes]

    def survivors(self, elsewhere: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of the runs of words that repeated windows cover without a gap in
        their starts; ``elsewhere``: the keys other blocks have."""
        place = self.place[(self.often | elsewhere)[self.key]]
        if not len(place):
            return place, place
        run = np.searchsorted(self.ends, place, side="right")
        cut = np.flatnonzero((np.diff(place) > 1) | (np.diff(run) > 0))
        return place[np.concatenate(([0], cut + 1))], place[np.append(cut, len(place) - 1)] + self.length


# ----- blocks and levels -----------------------------------------------------------------------

def pack_documents(docs: DataFrame, text_col: str, id_col: str, block_bytes: int) -> DataFrame:
    """Blocks of documents: ids, and their words as runs."""
    types = {"ids": pa.list_(pa.int64())} | {k: t for k, t in _STATE.items() if k != "block"}

    def block(rows: pa.Table):
        counts, numbers, words = numbered(rows["text"].combine_chunks())
        letters, lengths = pack_words(words)
        yield one_row(types, ids=rows["id"].to_pylist(), starts=pack((np.cumsum(counts) - counts).astype(np.uint32)),
                      counts=pack(counts.astype(np.uint32)), words=pack(numbers), letters=letters, lengths=lengths,
                      n_words=len(numbers))

    def run(batches):
        return cut_into_blocks(batches, "text", block_bytes, block)

    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return (rows.mapInArrow(run, "ids array<bigint>, " + _STATE_SQL.replace("block bigint, ", ""))
            .withColumn("block", F.monotonically_increasing_id()))


def dealt_keys(state: DataFrame, length: int, parts: int, last: bool) -> DataFrame:
    """(part, block, keys): each block's distinct window keys."""
    types = {"part": pa.int64(), "block": pa.int64(), "keys": pa.list_(pa.binary())}

    def run(batches):
        for row in rows_of(batches):
            w = Windows(row, length, parts, last)
            cut = np.flatnonzero(np.diff(w.part)) + 1
            for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(w.part)]):
                if b > a:
                    yield one_row(types, part=int(w.part[a]), block=row["block"],
                                  keys=[pack(c[a:b], k == 0) for k, c in enumerate(w.lanes)])

    return state.select(*_STATE).mapInArrow(run, "part bigint, block bigint, keys array<binary>")


def seen_elsewhere(dealt: DataFrame) -> DataFrame:
    """(block, part, bits): for each key a block sent, whether another block has it."""
    def look(table: pa.Table) -> pa.Table:
        blobs = table["keys"].to_pylist()
        each = [[unpack(x, "<u8", k == 0) for k, x in enumerate(b)] for b in blobs]
        lanes = [np.concatenate(c) for c in zip(*each)]
        sizes = [len(c[0]) for c in each]
        order = np.lexsort(lanes[::-1])
        same = np.all([c[order][1:] == c[order][:-1] for c in lanes], axis=0)
        hit = np.zeros(len(order), bool)
        hit[order[1:]] |= same
        hit[order[:-1]] |= same
        ends = np.cumsum(sizes)
        return pa.table({"block": table["block"], "part": table["part"],
                         "bits": pa.array([np.packbits(hit[e - n:e]).tobytes() for e, n in zip(ends, sizes)], pa.binary()),
                         "n": pa.array(sizes, pa.int64())})

    return dealt.groupBy("part").applyInArrow(look, "block bigint, part bigint, bits binary, n bigint")


def _with_bits(state: DataFrame, bits: DataFrame) -> DataFrame:
    by_block = bits.groupBy(F.col("block").alias("of")).agg(
        F.sort_array(F.collect_list(F.struct("part", "bits", "n"))).alias("answers"))  # of one block's own keys
    return state.join(by_block, F.col("block") == F.col("of"), "left").drop("of")


def survive(state: DataFrame, bits: DataFrame, length: int, parts: int, last: bool, window: int) -> DataFrame:
    """The runs of words that the level keeps, in the form of ``state``; on the last level
    these are the passages to remove."""
    def run(batches):
        for row in rows_of(batches):
            w = Windows(row, length, parts, last)
            answers = [np.unpackbits(np.frombuffer(a["bits"], np.uint8), count=a["n"]) for a in row["answers"] or []]
            begin, end = w.survivors(np.concatenate(answers).astype(bool) if answers else np.zeros(len(w.part), bool))
            keep = end - begin >= window
            begin, size = begin[keep], (end - begin)[keep]
            if len(begin):
                place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size - begin, size)
                numbers, words = only_used(w.numbers[place], w.words)
                first = w.ends - w.counts
                inside = np.searchsorted(w.ends, begin, side="right")
                letters, lengths = pack_words(words)
                yield one_row(_STATE, block=row["block"], counts=pack(size.astype(np.uint32)), words=pack(numbers),
                              starts=pack((w.starts[inside] + begin - first[inside]).astype(np.uint32)),
                              letters=letters, lengths=lengths, n_words=len(numbers))

    return _with_bits(state.select(*_STATE), bits).mapInArrow(run, _STATE_SQL)


def repeated_passages(blocks: DataFrame, window: int = WINDOW, first: int = FIRST,
                      part_keys: int = PART_KEYS) -> DataFrame | None:
    """(block, starts, counts, ...): the runs of words of each block that repeated windows
    cover; None if there are none."""
    state, last = blocks, False
    for length in lengths_of(window, first):
        last = length == window
        total = state.agg(F.sum("n_words")).first()[0] or 0
        if not total:
            return None
        parts = -(-total // part_keys)
        bits = written(seen_elsewhere(dealt_keys(state, length, parts, last)), f"repeat-bits-{length}")
        state = written(survive(state, bits, length, parts, last, window), f"repeat-runs-{length}")
    return state


def without_repeats(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", window: int = WINDOW,
                    first: int = FIRST, block_bytes: int = BLOCK_BYTES, part_keys: int = PART_KEYS) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 (of the kept words
    joined by a space), text (those words) and passages (start and end of each run of
    removed words, counted from 0).

    A word goes if a window of ``window`` words around it has the same words as a window
    that starts anywhere else, in the same document too; windows are those of the input.
    Words are runs of bytes other than ASCII white space, compared as they are. Null and
    empty texts have no words and keep none. Documents shorter than a window stay whole.
    Rows that repeat, also with equal or null ids, are documents of their own and so remove
    each other's passages. An empty table gives no rows.
    """
    ship(docs.sparkSession)
    blocks = written(pack_documents(docs, text_col, id_col, block_bytes), "repeat-blocks")
    found = repeated_passages(blocks, window, first, part_keys)
    gone = (found.select(F.col("block").alias("of"), F.col("starts").alias("gone"), F.col("counts").alias("sizes"))
            if found is not None else None)
    rows = blocks.join(gone, F.col("block") == F.col("of"), "left") if gone is not None else blocks.withColumns(
        {"gone": F.lit(None).cast("binary"), "sizes": F.lit(None).cast("binary")})
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for row in rows_of(batches):
            counts, numbers = unpack(row["counts"], "<u4").astype(np.int64), unpack(row["words"], "<u4").astype(np.int64)
            words = np.array([*unpack_words(row["letters"], row["lengths"]), b""], object)[:-1]
            stay, spans = np.ones(len(numbers), bool), [[] for _ in counts]
            ends = np.cumsum(counts)
            if row["gone"] is not None:
                begin = unpack(row["gone"], "<u4").astype(np.int64)
                size = unpack(row["sizes"], "<u4").astype(np.int64)
                stay[np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size - begin, size)] = False
                for d, a, n in zip(np.searchsorted(ends, begin, side="right").tolist(), begin.tolist(), size.tolist()):
                    at = a - int(ends[d] - counts[d])
                    if spans[d] and spans[d][-1]["end"] >= at:
                        spans[d][-1]["end"] = max(spans[d][-1]["end"], at + n)
                    else:
                        spans[d].append({"start": at, "end": at + n})
            before = np.concatenate(([0], np.cumsum(stay)))
            kept_words = words[numbers[stay]].tolist()
            kept = np.diff(before[np.concatenate(([0], ends))])
            last = np.cumsum(kept)
            texts = [b" ".join(kept_words[b - n:b]) for b, n in zip(last.tolist(), kept.tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["ids"], pa.int64()), pa.array(counts, pa.int64()), pa.array(counts - kept, pa.int64()),
                 pa.array([hashlib.sha256(t).hexdigest() for t in texts]), pa.array(texts, pa.binary()).cast(pa.string()),
                 pa.array(spans, span)],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "text", "passages"])

    return rows.select("ids", "counts", "words", "letters", "lengths", "gone", "sizes").mapInArrow(
        run, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, text string, "
             "passages array<struct<start:bigint,end:bigint>>")

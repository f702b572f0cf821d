"""Vector compression by codebooks of vector parts, fitted with a dual-tree Lloyd.

A vector's components become integers and the vector is cut into equal parts; each
part position has a codebook of integer entries, and a vector's code is the index of
the nearest entry at each position. Lloyd's rounds assign every part to its nearest
entry and move the entries to the means of their parts.

Assigning goes over two trees. Blocks of vectors hold, for each position, a balanced
tree of its parts, built and written once: every node caches its bounding box, the sum
of its parts and their number. The entries of a codebook are in a tree of boxes that is
built anew each round (a few dozen entries). A round walks pairs of nodes from the two
roots down, a whole level of pairs at a time. For a pair, the boxes bound the distance
of any part to any entry; an entry node that is farther from all of a part node than
another is at most is pruned, and so is an entry that a linear bound on the difference
of two distances puts behind another over the whole box. A part node with one entry left
takes it as a whole: its cached sum and count are added to the entry, no part is looked
at. Leaves that keep several entries compare the integers one by one.

All arithmetic is on integers: 64-bit where the components are small enough for exact
squares, Python's unbounded ones where they aren't. Sums leave a task as pairs of
decimals, so no table size overflows them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, written

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
#: Vectors of one block and of one leaf of its trees.
BLOCK = 32_768
LEAF = 8
#: Components up to this many can be subtracted, squared and added up in 64 bits.
SAFE = 1 << 27
#: Sums of parts are sent as high * LIMB + low.
LIMB = 10**18


def part_bounds(dim: int, parts: int) -> list[tuple[int, int]]:
    """Consecutive parts, equal if ``parts`` divides ``dim``, else the first ones one longer."""
    short, longer = divmod(dim, parts)
    ends = np.cumsum([short + (k < longer) for k in range(parts)]).tolist()
    return list(zip([0, *ends[:-1]], ends))


# ----- trees: nodes of a depth are runs of the tree's order of points ------------------------

class Level(NamedTuple):
    """Nodes of one depth: [start, end) of the order, first child in the next depth and
    number of children (2 where the node is halved, 1 where it is small enough)."""
    start: np.ndarray
    end: np.ndarray
    child: np.ndarray
    kids: np.ndarray


class Boxes(NamedTuple):
    """Bounding boxes and sums of a depth's nodes."""
    low: np.ndarray
    high: np.ndarray
    total: np.ndarray


def shape_of(n: int, leaf: int) -> list[Level]:
    """The nodes of a balanced tree over ``n`` points: those of more than ``leaf`` points
    are halved, so the shape depends on the two numbers alone."""
    levels, start = [], np.zeros(1, np.int64)
    while True:
        end = np.append(start[1:], n)
        kids = np.where(end - start > leaf, 2, 1)
        levels.append(Level(start, end, np.cumsum(kids) - kids, kids))
        if not n or (kids == 1).all():
            return levels
        below = np.repeat(start, kids)
        second = levels[-1].child[kids == 2] + 1
        below[second] = ((start + end) // 2)[kids == 2]
        start = below


def tree_order(points: np.ndarray, shape: list[Level]) -> np.ndarray:
    """The points' order in the tree: each node is sorted along its widest dimension
    before it is halved."""
    points = points.astype(np.float64)  # where a node is halved need not be exact
    n, order = len(points), np.arange(len(points))
    for level in shape[:-1]:
        here = points[order]
        node = np.repeat(np.arange(len(level.start)), level.end - level.start)
        spread = np.maximum.reduceat(here, level.start) - np.minimum.reduceat(here, level.start)
        value = here[np.arange(n), np.argmax(spread, axis=1)[node]]
        order = order[np.lexsort((value, node))]
    return order


def boxes_of(points: np.ndarray, shape: list[Level]) -> list[Boxes]:
    """Boxes and sums from the leaves up; ``points`` in the tree's order."""
    start = shape[-1].start
    out = [Boxes(np.minimum.reduceat(points, start), np.maximum.reduceat(points, start),
                 np.add.reduceat(points, start))]
    for level in shape[-2::-1]:
        b = out[-1]
        out.append(Boxes(np.minimum.reduceat(b.low, level.child), np.maximum.reduceat(b.high, level.child),
                         np.add.reduceat(b.total, level.child)))
    return out[::-1]


def _square(x: np.ndarray) -> np.ndarray:
    return (x * x).sum(axis=-1)


def _spans(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[k], start[k] + 1, ..., size[k] numbers each, one after the other."""
    return np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size - start, size)


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of each run of equal values."""
    start = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    return start, np.diff(np.append(start, len(values)))


def _lowest(values: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each run: its lowest value, repeated over the run, and where that is first."""
    low = np.repeat(np.minimum.reduceat(values, start), size)
    hit = np.flatnonzero((values == low).astype(bool))
    run = np.repeat(np.arange(len(start)), size)[hit]
    return low, hit[np.concatenate(([True], run[1:] != run[:-1]))]


class Assigned(NamedTuple):
    """Whole nodes as (depth, nodes, entries); single parts as places in the tree's order
    and entries; how many node pairs were bounded and single distances computed."""
    whole: list[tuple[int, np.ndarray, np.ndarray]]
    place: np.ndarray
    entry: np.ndarray
    bounded: int
    compared: int


def assign(points: np.ndarray, shape: list[Level], boxes: list[Boxes], entries: np.ndarray) -> Assigned:
    """The nearest entry of every part, the lower index where distances are equal.
    ``points``: the parts in their tree's order."""
    none = np.zeros(0, np.int64)
    if not len(points):
        return Assigned([], none, none, 0, 0)
    firsts: dict[tuple, int] = {}
    for k, e in enumerate(entries.tolist()):
        firsts.setdefault(tuple(e), k)  # of equal entries only the first can win
    if len(firsts) == 1:
        return Assigned([(0, np.zeros(1, np.int64), np.zeros(1, np.int64))], none, none, 0, 0)
    index = np.array(list(firsts.values()))
    book_shape = shape_of(len(index), 1)
    index = index[tree_order(entries[index], book_shape)]
    books = boxes_of(entries[index], book_shape)
    node, book = np.zeros(1, np.int64), np.zeros(1, np.int64)
    depth = at = bounded = compared = 0
    deep, low_book = len(shape) - 1, len(book_shape) - 1
    whole, place, entry = [], none, none
    while True:
        mine, theirs = boxes[depth], books[at]
        low, high, e_low, e_high = mine.low[node], mine.high[node], theirs.low[book], theirs.high[book]
        bounded += len(node)
        start, size = _runs(node)
        far = _square(np.maximum(high - e_low, e_high - low))
        reach, best = _lowest(far, start, size)
        stay = _square(np.maximum(np.maximum(low - e_high, e_low - high), 0)) <= reach
        if at == low_book:
            # distance to the entry less that to a rival is linear over the box: if it is
            # above zero at its lowest corner, the rival is nearer everywhere
            rival = np.repeat(e_low[best], size, axis=0)
            turn = 2 * (rival - e_low)
            lowest = np.where(turn > 0, turn * low, turn * high).sum(axis=-1) + _square(e_low) - _square(rival)
            stay &= lowest <= 0
        node, book = node[stay], book[stay]
        if at == low_book:
            start, size = _runs(node)
            one = np.repeat(size == 1, size)
            if one.any():
                whole.append((depth, node[one], index[book[one]]))
                node, book = node[~one], book[~one]
            if not len(node):
                break
            if depth == deep:
                place, entry, compared = _leaves(points, shape[-1], node, index[book], entries)
                break
        if at < low_book:
            level = book_shape[at]
            node, book = np.repeat(node, level.kids[book]), _spans(level.child[book], level.kids[book])
            at += 1
        if depth < deep:
            level = shape[depth]
            node, book = _spans(level.child[node], level.kids[node]), np.repeat(book, level.kids[node])
            by_node = np.argsort(node, kind="stable")
            node, book = node[by_node], book[by_node]
            depth += 1
    return Assigned(whole, place, entry, bounded, compared)


def _leaves(points, leaves: Level, node, entry, entries) -> tuple[np.ndarray, np.ndarray, int]:
    """Compare the parts of leaves with the entries that are left, on integers."""
    by = np.lexsort((entry, node))
    node, entry = node[by], entry[by]
    size = leaves.end[node] - leaves.start[node]
    place, choice = _spans(leaves.start[node], size), np.repeat(entry, size)
    by = np.argsort(place, kind="stable")
    place, choice = place[by], choice[by]
    start, size = _runs(place)
    _, best = _lowest(_square(points[place] - entries[choice]), start, size)
    return place[best], choice[best], len(place)


# ----- blocks of vectors ---------------------------------------------------------------------

class Codebooks(NamedTuple):
    """Entries by part (rows of Python integers), and the length of the vectors."""
    dim: int
    entries: list[list[list[int]]]

    @property
    def sha256(self) -> str:
        """Digest of all entries' decimal components by part, entry and position."""
        return hashlib.sha256(",".join(str(x) for part in self.entries for e in part for x in e).encode()).hexdigest()


def quantised(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) of doubles, as 64-bit integers if all are small enough to be
    squared and added up, else as Python integers."""
    with np.errstate(over="ignore"):
        scaled = np.floor(values * scale)
    if not values.size or np.abs(scaled).max() <= SAFE:
        return scaled.astype(np.int64)
    flat = [int(x) * scale if abs(x) >= 2**53 else int(y) for x, y in zip(values.ravel().tolist(), scaled.ravel().tolist())]
    out = np.empty(len(flat), object)
    out[:] = flat
    return out.reshape(values.shape)


def _exact(entries: list[list[int]], width: int, like: np.ndarray) -> np.ndarray:
    big = like.dtype == object or any(abs(x) > SAFE for e in entries for x in e)
    out = np.empty((len(entries), width), object if big else np.int64)
    for k, e in enumerate(entries):
        out[k, :] = e
    return out


def pack_blocks(rows: DataFrame, dim: int, parts: int, scale: int, block: int, leaf: int) -> DataFrame:
    """Rows (vec_id, label, v) of ``dim`` components as blocks: ids, labels, the vectors,
    and for each part the order of the vectors in its tree."""
    cuts = part_bounds(dim, parts)
    label_type = rows.schema["label"].dataType.simpleString()

    def packed(batch: pa.Table) -> pa.RecordBatch:
        n = batch.num_rows
        values = batch["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(n, dim)
        ints, shape = quantised(values, scale), shape_of(n, leaf)
        orders = [tree_order(ints[:, a:b], shape) if b > a else np.arange(n) for a, b in cuts]
        whole = lambda a: pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), a.combine_chunks())
        return pa.RecordBatch.from_arrays(
            [whole(batch["vec_id"]), whole(batch["label"]), pa.array([values.tobytes()], pa.binary()),
             pa.array([np.concatenate(orders).astype("<u4").tobytes()], pa.binary())],
            names=["ids", "labels", "vectors", "orders"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            waiting.append(batch)
            while sum(b.num_rows for b in waiting) >= block:
                every = pa.Table.from_batches(waiting)
                yield packed(every.slice(0, block))
                waiting = every.slice(block).to_batches()
        if sum(b.num_rows for b in waiting):
            yield packed(pa.Table.from_batches(waiting))

    return rows.select("vec_id", "label", "v").mapInArrow(
        run, f"ids array<bigint>, labels array<{label_type}>, vectors binary, orders binary")


def _trees(row: dict, cuts, scale: int, leaf: int):
    """For each part of a block: its parts in tree order, shape, boxes and the order."""
    n = len(row["ids"])
    dim = cuts[-1][1]
    ints, shape = quantised(np.frombuffer(row["vectors"]).reshape(n, dim), scale), shape_of(n, leaf)
    orders = np.frombuffer(row["orders"], "<u4").reshape(len(cuts), n)
    for (a, b), order in zip(cuts, orders):
        points = ints[:, a:b][order]
        yield points, shape, boxes_of(points, shape), order


def _block_rows(batches):
    for batch in batches:
        for k in range(batch.num_rows):
            yield {n: (batch.column(i)[k] if n == "labels" else batch.column(i)[k].as_py())
                   for i, n in enumerate(batch.schema.names)}


def _sums(blocks: DataFrame, books: Codebooks, scale: int, leaf: int) -> DataFrame:
    """One Lloyd assignment: (part, entry, place, n, high, low), the sum of a component
    being high * LIMB + low. A task adds its blocks up first."""
    cuts = part_bounds(books.dim, len(books.entries))
    entries, exact, limb = books.entries, pa.decimal128(38, 0), LIMB

    def run(batches):
        counts = [[0] * len(e) for e in entries]
        sums = [np.zeros((len(e), b - a), object) for e, (a, b) in zip(entries, cuts)]
        for row in _block_rows(batches):
            for p, (points, shape, boxes, _) in enumerate(_trees(row, cuts, scale, leaf)):
                got = assign(points, shape, boxes, _exact(entries[p], points.shape[1], points))
                for depth, node, entry in got.whole:
                    size = shape[depth].end[node] - shape[depth].start[node]
                    _add(sums[p], counts[p], entry, boxes[depth].total[node], size)
                _add(sums[p], counts[p], got.entry, points[got.place], np.ones(len(got.place), np.int64))
        out = [(p, e, at, counts[p][e], *divmod(int(x), limb))
               for p in range(len(entries)) for e in range(len(entries[p])) if counts[p][e]
               for at, x in enumerate(sums[p][e].tolist())]
        if out:
            part, entry, place, n, high, low = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(place, pa.int32()),
                 pa.array(n, pa.int64()), pa.array([_decimal(x) for x in high], exact),
                 pa.array([_decimal(x) for x in low], exact)], names=["part", "entry", "place", "n", "high", "low"])

    return blocks.select("ids", "vectors", "orders").mapInArrow(
        run, "part int, entry int, place int, n bigint, high decimal(38,0), low decimal(38,0)")


def _decimal(x: int):
    from decimal import Decimal

    return Decimal(x)


def _add(sums, counts, entry, totals, size) -> None:
    """Add sums and numbers of parts to their entries."""
    if not len(entry):
        return
    by = np.argsort(entry, kind="stable")
    start, _ = _runs(entry[by])
    for e, total, n in zip(entry[by][start].tolist(), np.add.reduceat(totals[by], start).tolist(),
                           np.add.reduceat(size[by], start).tolist()):
        sums[e] += np.array(total, object)
        counts[e] += n


def _moved(books: Codebooks, sums: DataFrame) -> Codebooks:
    """Entries at the floor of their parts' means; unused ones stay. What comes to the
    driver has the size of the codebooks."""
    entries = [[list(e) for e in part] for part in books.entries]
    for r in (sums.groupBy("part", "entry", "place")
              .agg(F.sum("n").alias("n"), F.sum("high").alias("high"), F.sum("low").alias("low")).collect()):
        entries[r.part][r.entry][r.place] = (int(r.high) * LIMB + int(r.low)) // r.n
    return Codebooks(books.dim, entries)


def _coded(blocks: DataFrame, books: Codebooks, scale: int, leaf: int) -> DataFrame:
    """(vec_id, label, code, error) of every vector in the blocks."""
    cuts, entries = part_bounds(books.dim, len(books.entries)), books.entries
    label_type = blocks.schema["labels"].dataType.elementType.simpleString()

    def run(batches):
        for row in _block_rows(batches):
            n = len(row["ids"])
            codes, error = np.zeros((n, len(cuts)), np.uint8), 0
            for p, (points, shape, boxes, order) in enumerate(_trees(row, cuts, scale, leaf)):
                book = _exact(entries[p], points.shape[1], points)
                got = assign(points, shape, boxes, book)
                winner = np.zeros(n, np.int64)
                winner[got.place] = got.entry
                for depth, node, entry in got.whole:
                    size = shape[depth].end[node] - shape[depth].start[node]
                    winner[_spans(shape[depth].start[node], size)] = np.repeat(entry, size)
                back = np.empty(n, np.int64)
                back[order] = np.arange(n)
                codes[:, p] = winner[back]
                error = error + _square(points - book[winner])[back]
            text, wide = codes.tobytes().hex(), 2 * len(cuts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["ids"], pa.int64()), row["labels"].values,
                 pa.array([text[k * wide:(k + 1) * wide] for k in range(n)]),
                 pa.array([x if x < 1 << 63 else None for x in np.broadcast_to(error, (n,)).tolist()], pa.int64())],
                names=["vec_id", "label", "code", "error"])

    return blocks.mapInArrow(run, f"vec_id bigint, label {label_type}, code string, error bigint")


def kept_vectors(vectors: DataFrame, vector_col: str, id_col: str, label_col: str) -> DataFrame:
    """(vec_id, label, v) of the rows whose vector has numbers only."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    finite = F.forall(v, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    return vectors.where(v.isNotNull() & finite).select(
        F.col(f"`{id_col}`").cast("bigint").alias("vec_id"), F.col(f"`{label_col}`").alias("label"), v.alias("v"))


def compress(vectors: DataFrame, vector_col: str = "embedding", id_col: str = "vec_id", label_col: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
             block: int = BLOCK, leaf: int = LEAF) -> tuple[DataFrame, Codebooks]:
    """The code of every vector, and the codebooks.

    Rows: vec_id, label, code (two hex digits a part), error (squared distance to the
    coded vector), label_error (sum of error over equal labels, nulls together).

    Rows whose vector is null or holds a null, NaN or infinite component are dropped.
    Vectors have the length most rows have (the longer of equally common ones); a row of
    another length stays with null code and error. A length that ``parts`` doesn't divide
    makes the first parts one component longer. The codebooks start as the parts of the
    ``entries`` (at most 256) rows with the smallest ids, of equal ids those with the
    smaller vector first; rows without an id are coded but never an entry at the start.
    With fewer rows the codebooks are smaller; with none that has an id, codes are null.
    Repeated rows count as often as they stand there. An error or sum that doesn't fit 64
    bits is null. An empty table gives no rows.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits a part: 1 to 256 entries")
    ship(vectors.sparkSession)
    kept = kept_vectors(vectors, vector_col, id_col, label_col)
    common = kept.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    dim = common.dim if common else 0
    usual = kept.where(F.size("v") == dim)
    seeds = usual.where("vec_id IS NOT NULL").orderBy("vec_id", "v").limit(entries).select("v").collect()
    first = [[int(x) for x in quantised(np.array([r.v], float).reshape(1, dim), scale)[0]] for r in seeds]
    books = Codebooks(dim, [[e[a:b] for e in first] for a, b in part_bounds(dim, parts)])
    other = kept.where(F.size("v") != dim) if seeds else kept
    uncoded = other.select("vec_id", "label", F.lit(None).cast("string").alias("code"),
                           F.lit(None).cast("bigint").alias("error"))
    coded = uncoded
    if seeds:
        blocks = written(pack_blocks(usual, dim, parts, scale, block, leaf), "vector-blocks")
        for _ in range(rounds):
            books = _moved(books, _sums(blocks, books, scale, leaf))
        coded = _coded(blocks, books, scale, leaf).unionByName(uncoded)
    coded = written(coded, "vector-codes")
    by_label = coded.groupBy(F.col("label").alias("of")).agg(F.try_sum("error").alias("label_error"))
    return (coded.join(by_label, F.col("label").eqNullSafe(F.col("of")))
            .select("vec_id", "label", "code", "error", "label_error")), books

"""Vector codes against a brute-force version: every part compared with every entry."""

import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoplens.llm import vector_codes as V

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, parts, entries, rounds):
    """rows: (vec_id, vector, label) with vectors of one length; exact integers."""
    vectors = [[math.floor(256 * float(x)) if abs(x) < 2**40 else 256 * int(x) for x in v] for _, v, _ in rows]
    cuts = V.part_bounds(len(vectors[0]), parts)
    seeds = sorted((k for k in range(len(rows)) if rows[k][0] is not None), key=lambda k: (rows[k][0], rows[k][1]))
    books = [[vectors[k][a:b] for k in seeds[:entries]] for a, b in cuts]

    def nearest(part, book):
        return min((sum((x - y) ** 2 for x, y in zip(part, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p, (a, b) in enumerate(cuts):
            got = defaultdict(list)
            for v in vectors:
                got[nearest(v[a:b], books[p])[1]].append(v[a:b])
            books[p] = [[sum(c) // len(got[k]) for c in zip(*got[k])] if k in got else e
                        for k, e in enumerate(books[p])]
    best = [[nearest(v[a:b], books[p]) for p, (a, b) in enumerate(cuts)] for v in vectors]
    fits = lambda x: x if x < 2**63 else None
    error = [fits(sum(d for d, _ in x)) for x in best]
    by_label = defaultdict(int)
    for (_, _, label), e in zip(rows, error):
        by_label[label] += e or 0
    return sorted(((i, "".join(f"{k:02x}" for _, k in x), e, by_label[label])
                   for (i, _, label), x, e in zip(rows, best, error)), key=repr), books


def compressed(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got, books = V.compress(df, **options)
    return sorted((tuple(r) for r in got.select("vec_id", "code", "error", "label_error").collect()), key=repr), books


def some_rows(n, dim, seed=0, spread=0.4):
    rng = np.random.default_rng(seed)
    v = (rng.normal(size=(n, dim)) * spread).astype(np.float32).tolist()
    return [(k, v[k], [None, 1, 2][k % 3]) for k in range(n)]


@pytest.mark.parametrize("n, dim, parts, entries, block", [
    (300, 8, 4, 16, 64), (40, 6, 4, 64, 1000), (7, 3, 5, 4, 2), (500, 4, 2, 3, 100)])
def test_equals_brute_force(spark, n, dim, parts, entries, block):
    rows = some_rows(n, dim)
    want, books = brute(rows, parts, entries, 2)
    got, mine = compressed(spark, rows, parts=parts, entries=entries, block=block, leaf=4)
    assert got == want
    assert [[list(e) for e in p] for p in mine.entries] == books
    text = ",".join(str(x) for p in books for e in p for x in e)
    assert mine.sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_ties_repeats_and_hot_vectors(spark):
    grid = [[x / 256, y / 256] for x in range(-3, 4) for y in range(-3, 4)]
    rows = [(k % 60, grid[(k * 5) % 49] if k % 3 else grid[0], 1) for k in range(200)]
    want, _ = brute(rows, 1, 16, 2)
    got, _ = compressed(spark, rows, parts=1, entries=16, block=50, leaf=2)
    assert got == want


def test_rows_without_numbers_ids_or_usual_length(spark):
    good = some_rows(20, 4)
    odd = [(100, None, 1), (101, [1.0, None, 1.0, 1.0], 1), (102, [1.0, float("nan"), 0.0, 0.0], 1),
           (103, [1.0, float("inf"), 0.0, 0.0], 1)]
    short = [(104, [1.0], 7), (105, [], None)]
    nameless = [(None, [0.5, 0.5, 0.5, 0.5], 2)]
    want, _ = brute(good + nameless, 2, 4, 2)
    got, _ = compressed(spark, good + odd + short + nameless, parts=2, entries=4, block=6, leaf=2)
    assert [r for r in got if r[0] not in (104, 105)] == want
    assert {r[:3] for r in got if r[0] in (104, 105)} == {(104, None, None), (105, None, None)}
    only_nameless, _ = compressed(spark, nameless, parts=2, entries=4)
    assert only_nameless == [(None, None, None, None)]
    assert compressed(spark, odd)[0] == []
    assert V.compress(spark.createDataFrame([], SCHEMA))[0].count() == 0


def test_components_beyond_64_bits(spark):
    rows = [(k, [float(x) for x in v], 1) for k, v in enumerate(
        [(1e30, -1e30), (2e30, 1.0), (0.0, 0.25), (-3e38, 3e38), (1e30, -1e30), (0.5, 0.0)])]
    rows = [(k, np.float32(v).astype(float).tolist(), label) for k, v, label in rows]
    want, books = brute(rows, 2, 3, 2)
    got, mine = compressed(spark, rows, parts=2, entries=3, block=2, leaf=1)
    assert [[list(e) for e in p] for p in mine.entries] == books
    assert [r[:3] for r in got] == [r[:3] for r in want]


def test_own_columns_do_not_clash(spark):
    rows = spark.createDataFrame(some_rows(30, 4), SCHEMA).withColumns(
        {c: F.lit("own") for c in ("v", "code", "error", "label_error", "ids", "of", "part")})
    got, _ = V.compress(rows, parts=2, entries=4)
    assert got.columns == ["vec_id", "label", "code", "error", "label_error"]
    assert got.count() == 30


def test_trees_prune(spark):
    """Far fewer distances than parts x entries, and whole nodes take their cached sums."""
    rng = np.random.default_rng(3)
    middle = rng.normal(size=(32, 4)) * 200
    points = (middle[rng.integers(0, 32, 4096)] + rng.normal(size=(4096, 4)) * 5).astype(np.int64)
    entries = middle.astype(np.int64)
    shape = V.shape_of(len(points), V.LEAF)
    points = points[V.tree_order(points, shape)]
    boxes = V.boxes_of(points, shape)
    got = V.assign(points, shape, boxes, entries)
    whole = sum(int((shape[d].end[n] - shape[d].start[n]).sum()) for d, n, _ in got.whole)
    assert whole + len(got.place) == len(points) and whole > len(points) // 2
    assert got.bounded + got.compared < len(points) * len(entries) // 10
    for d, nodes, winners in got.whole:
        for k, e in zip(nodes.tolist(), winners.tolist()):
            here = points[shape[d].start[k]:shape[d].end[k]]
            assert (((here[:, None] - entries[None]) ** 2).sum(-1).argmin(1) == e).all()
            assert (boxes[d].total[k] == here.sum(0)).all()

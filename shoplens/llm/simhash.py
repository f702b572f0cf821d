"""SimHash near-duplicate detection with BK-trees.

A text's fingerprint has 64 bits: bit b is set if more than half of the hashes of
its word shingles (repeats included) have it set. Fingerprints link at Hamming
distance ``radius`` or less, and components are what links reach.

Search. Two fingerprints within ``radius`` agree on at least ``blocks - radius``
of ``blocks`` bit blocks, so every choice of that many blocks is a key, and
linked fingerprints share a key. The distinct fingerprints of a key form a shard;
a shard is cut into trees of at most ``tree_rows`` fingerprints, and each tree is
sent to all fingerprints of its shard (in units of one tree and one query block),
so a hot shard is many tasks and no group is unbounded. Trees are BK-trees:
children are keyed by their integer distance to the parent, and a query at
distance d from a node follows only the edges from d - radius to d + radius. A
unit yields a spanning forest of the links it finds (at most one row per
fingerprint), which joins the same fingerprints as all its pairs would.

Components come from alternating star contraction on the forest's edges, in
Spark, each round written to the shared folder.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, written

#: Fingerprints of one tree, and of one block of queries sent to it.
TREE_ROWS = 4096
#: Random fingerprints a shard should have at most; more blocks are taken beyond.
SHARD_ROWS = 64
#: Shingles hashed at a time, which bounds memory for very long texts.
CHUNK = 1 << 16


def words_of(text: str | None) -> list[bytes]:
    """Words in lower case (A-Z only), split at ASCII white space."""
    return (text or "").encode().lower().split()


def fingerprint(text: str | None, size: int = 4, seed: int = 42) -> int:
    """The 64-bit SimHash of the whole text; 0 if it has no word."""
    words = words_of(text)
    if not words:
        return 0
    n = max(1, len(words) - size + 1)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:n - 1]))
    stops = ends[min(size, len(words)) - 1:] - 1
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for lo in range(0, n, CHUNK):
        hashes = np.array([digest(joined[a:b], seed) for a, b in
                           zip(starts[lo:lo + CHUNK].tolist(), stops[lo:lo + CHUNK].tolist())], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text_col: str, size: int, seed: int) -> DataFrame:
    """``docs`` with the column fp (the fingerprint as a signed long) in place of
    the text."""
    src = docs.select(*[c for c in docs.columns if c != text_col], text_col)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1]] + ["fp bigint"])

    def run(batches):
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            fp = np.array([fingerprint(t.as_py(), size, seed) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(fp)],
                                             names=[*batch.schema.names[:-1], "fp"])

    return src.mapInArrow(run, schema)


class BkTree:
    """A BK-tree over distinct 64-bit values, held level by level: every node is a
    value, and a node's children are sorted by their distance to it."""

    def __init__(self, values: np.ndarray):
        self.value = values.copy()  # breadth first, node k
        n = len(values)
        order = np.arange(n)
        self.first = np.zeros(n + 1, np.int64)  # children of node k: first[k] .. first[k + 1]
        self.edge = np.zeros(n, np.uint8)  # distance of node k to its parent
        self.node = np.zeros(n, np.int64)  # which of the given values node k is
        # A level's subtrees are runs of ``order``; the head of each is its node.
        heads, ends, made = np.array([0][:n]), np.array([n][:n]), 0
        children = []
        while len(heads):
            level = np.arange(made, made + len(heads))
            self.node[level] = order[heads]
            counts = ends - heads - 1
            if not counts.sum():
                children.append(np.zeros(len(heads), np.int64))
                break
            owner = np.repeat(np.arange(len(heads)), counts)
            within = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
            rest = order[heads[owner] + 1 + within]
            far = np.bitwise_count(values[rest] ^ values[order[heads[owner]]])
            sort = np.lexsort((rest, far, owner))
            owner, far, rest = owner[sort], far[sort], rest[sort]
            new = np.flatnonzero(np.concatenate(([True], (owner[1:] != owner[:-1]) | (far[1:] != far[:-1]))))
            made += len(heads)
            self.edge[made:made + len(new)] = far[new]
            children.append(np.bincount(owner[new], minlength=len(heads)))
            order, heads, ends = rest, new, np.append(new[1:], len(rest))
        self.first[1:] = 1 + np.cumsum(np.concatenate(children)) if n else 0
        self.first[0] = 1
        self.value = values[self.node] if n else self.value

    def within(self, queries: np.ndarray, radius: int):
        """Blocks of (query position, position of the value found)."""
        if not len(self.value):
            return
        for lo in range(0, len(queries), 512):
            query = np.arange(lo, min(lo + 512, len(queries)))
            node = np.zeros(len(query), np.int64)
            while len(query):
                far = np.bitwise_count(queries[query] ^ self.value[node]).astype(np.int16)
                hit = far <= radius
                if hit.any():
                    yield query[hit], self.node[node[hit]]
                counts = self.first[node + 1] - self.first[node]
                owner = np.repeat(np.arange(len(query)), counts)
                child = (np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
                         + self.first[node[owner]])
                follow = np.abs(self.edge[child].astype(np.int16) - far[owner]) <= radius
                query, node = query[owner[follow]], child[follow]


def spanning(n: int, pairs) -> np.ndarray:
    """For each of n items the smallest item it is joined with by the pairs."""
    root = np.arange(n)
    for a, b in pairs:
        while True:
            ra, rb = root[a], root[b]
            apart = ra != rb
            if not apart.any():
                break
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
            while (root[root] != root).any():
                root = root[root]
    return root


def forest(values: np.ndarray, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (value, value) that join whatever links tree values and queries."""
    everything, back = np.unique(np.concatenate((values, queries)), return_inverse=True)
    at_value, at_query = back[:len(values)], back[len(values):]
    tree = BkTree(values)
    root = spanning(len(everything), ((at_query[q], at_value[v]) for q, v in tree.within(queries, radius)))
    child = np.flatnonzero(root != np.arange(len(root)))
    return everything[child], everything[root[child]]


def block_count(n: int, radius: int) -> int:
    """Bit blocks such that a shard of n random fingerprints stays small. The
    choice changes the work, never the links: every choice finds all of them."""
    blocks = radius + 1
    while blocks < 2 * radius and n / SHARD_ROWS > 1 << ((64 // blocks) * (blocks - radius)):
        blocks += 1
    return blocks


def links(distinct: DataFrame, radius: int, blocks: int, tree_rows: int = TREE_ROWS) -> DataFrame:
    """Edges (a, b), b < a, between distinct fingerprints (column fp): a spanning
    forest of the links of each search unit."""
    cuts = [(64 * k // blocks, 64 * (k + 1) // blocks) for k in range(blocks)]
    masks = []
    for chosen in combinations(cuts, blocks - radius):
        m = sum((1 << hi) - (1 << lo) for lo, hi in chosen)
        masks.append(m - (1 << 64) if m >= 1 << 63 else m)
    keys = F.array(*[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("bits"))
                     for i, m in enumerate(masks)])
    keyed = distinct.select("fp", F.explode(keys).alias("k")).select("fp", "k.t", "k.bits")
    # Shards of two and more, and in how many trees each is cut.
    shards = (keyed.groupBy("t", "bits").agg(F.count("*").alias("n")).where("n > 1")
              .select("t", "bits", F.ceil(F.col("n") / tree_rows).cast("int").alias("trees")))
    own = F.pmod(F.xxhash64("fp"), F.col("trees")).cast("int")
    sent = (keyed.join(shards, ["t", "bits"]).withColumn("own", own)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("trees") - 1)))
            .select("fp", F.xxhash64("t", "bits", F.least("own", "other"), F.greatest("own", "other")).alias("unit"),
                    (F.col("own") > F.col("other")).alias("asks")))
    # Small units are searched together: a bucket is one call, its units one array
    # each. Units are at most two trees, buckets a few units.
    buckets = sent.sparkSession.conf.get("spark.sql.shuffle.partitions")
    dealt = sent.repartition(int(buckets), "unit").sortWithinPartitions("unit", "asks", "fp")

    def run(batches):
        pending: list[np.ndarray] = []

        def search(unit_rows):
            fps, asks = unit_rows
            values = fps[~asks]
            queries = fps[asks] if asks.any() else values
            return forest(values, queries, radius)

        def done(unit, fps, asks):
            starts = np.flatnonzero(np.concatenate(([True], unit[1:] != unit[:-1])))
            stops = np.append(starts[1:], len(unit))
            a, b = [], []
            for lo, hi in zip(starts.tolist(), stops.tolist()):
                if hi - lo == 2:  # one pair needs no tree
                    x, y = fps[lo], fps[lo + 1]
                    if int(x ^ y).bit_count() <= radius:
                        a.append(np.array([max(x, y)]))
                        b.append(np.array([min(x, y)]))
                    continue
                x, y = search((fps[lo:hi], asks[lo:hi]))
                a.append(x)
                b.append(y)
            if not a:
                return None
            a, b = np.concatenate(a), np.concatenate(b)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        rest = None
        for batch in batches:
            cols = [batch.column(1).to_numpy(), batch.column(0).to_numpy().view(np.uint64),
                    batch.column(2).to_numpy(zero_copy_only=False)]
            if rest is not None:
                cols = [np.concatenate((r, c)) for r, c in zip(rest, cols)]
            if not len(cols[0]):
                continue
            cut = int(np.searchsorted(cols[0], cols[0][-1]))  # the last unit may go on
            rest = [c[cut:] for c in cols]
            if cut:
                out = done(*[c[:cut] for c in cols])
                if out is not None:
                    yield out
        if rest is not None and len(rest[0]):
            out = done(*rest)
            if out is not None:
                yield out

    return dealt.mapInArrow(run, "a bigint, b bigint").where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b): the smallest value its
    component holds. Each round hangs every node's larger neighbours, then its
    smaller ones, on its smallest neighbour, until nothing moves."""
    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else e
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        joined = both.join(low, "a")
        if large:
            out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = (joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
                   .unionByName(low.select("a", F.col("m").alias("b"))))
        return out.where("a <> b").distinct()

    def down(e: DataFrame) -> DataFrame:
        return e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))

    now = written(down(edges), "links")
    before = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
        now = written(star(down(star(now, True)), False), "links")


def simhash_dedup(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", rid_col: str | None = None,
                  size: int = 4, radius: int = 4, seed: int = 42, tree_rows: int = TREE_ROWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits),
    component_id (smallest doc_id reachable over links, its own included), kept
    (one row of each component: the smallest id, then the first rid), and rid.

    Texts of fewer than ``size`` words are one shingle; null, empty and blank
    texts have fingerprint zero and link like any other. Rows without an id come
    last; component_id is null only if no row of the component has one.
    """
    ship(docs.sparkSession)
    rid = F.col(f"`{rid_col}`") if rid_col else F.monotonically_increasing_id()
    src = docs.select(rid.cast("bigint").alias("rid"), F.col(f"`{id_col}`").cast("bigint").alias("id"),
                      F.col(f"`{text_col}`").cast("string").alias("text"))
    rows = written(fingerprints(src, "text", size, seed), "fingerprints")
    groups = written(rows.groupBy("fp").agg(
        F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "rid")).alias("w")), "fp-groups")
    edges = links(groups.select("fp"), radius, block_count(groups.count(), radius), tree_rows)
    roots = components(edges)
    joined = groups.join(roots, groups["fp"] == roots["node"], "left").select(
        "fp", "w", F.coalesce("root", "fp").alias("root"))
    joined = written(joined, "fp-roots")
    best = joined.groupBy("root").agg(F.min("w").alias("best"))
    kept = joined.join(best, "root").select("fp", "best")
    return rows.join(kept, "fp").select(
        "rid", F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("best.id").alias("component_id"), (F.col("rid") == F.col("best.rid")).alias("kept"))

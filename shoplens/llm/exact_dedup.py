"""Exact deduplication against a minimal perfect hash of historical digests.

The history's distinct digests are dealt into partitions of about ``slots``
digests. Each partition gets a minimal perfect hash of its digests, built level
by level: on a level every digest not yet placed hashes to one bit of an array
twice as long as there are digests left; those alone on their bit are placed, the
others go one level deeper. A digest's slot is its level's start plus the number
of set bits before its own. A slot holds the full digest and the locator of the
row that won, so a lookup compares all bytes: a member is a repeat of history, a
nonmember is grouped with its own kind among the new rows.

Both sides are first reduced to one row per digest (combined before the
shuffle), so a text that a third of all rows hold is one row in every lookup.
The verdicts go back to the rows by an equi-join on the digest, whose hot
partitions Spark splits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship, written

#: Digests of one index partition: about 5 MB of slots.
SLOTS = 100_000
#: Bits per digest left on a level of the hash.
GAMMA = 2

_MIX = np.uint64(0x9E3779B97F4A7C15)


def normal_text(text: Column) -> Column:
    """Runs of ASCII white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _spots(digests: np.ndarray, level: int, size: int) -> np.ndarray:
    """Each digest's bit on a level: words of the digest, mixed with the level."""
    words = digests.view("<u8").reshape(-1, 4)
    with np.errstate(over="ignore"):
        h = (words[:, level % 4] + _MIX * np.uint64(level + 1)) * (words[:, (level + 1) % 4] | np.uint64(1))
        h ^= h >> np.uint64(31)
    return (h % np.uint64(size)).astype(np.int64)


def build_hash(digests: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Level sizes, the levels' bits one after the other, and each digest's slot.
    ``digests``: distinct, n x 32 bytes."""
    left = np.arange(len(digests))
    sizes, bits, slot, taken = [], [], np.zeros(len(digests), np.int64), 0
    while len(left):
        size = GAMMA * len(left) + 1
        spot = _spots(digests[left], len(sizes), size)
        alone = np.bincount(spot, minlength=size) == 1
        rank = np.cumsum(alone) - 1
        hit = alone[spot]
        slot[left[hit]] = taken + rank[spot[hit]]
        taken += int(alone.sum())
        sizes.append(size)
        bits.append(alone)
        left = left[~hit]
    return sizes, np.concatenate(bits) if bits else np.zeros(0, bool), slot


def look_up(digests: np.ndarray, sizes: list[int], bits: np.ndarray) -> np.ndarray:
    """The slot each digest would have, -1 for those that fall through."""
    out = np.full(len(digests), -1, np.int64)
    rank = np.cumsum(bits) - 1
    left, base = np.arange(len(digests)), 0
    for level, size in enumerate(sizes):
        spot = base + _spots(digests[left], level, size)
        hit = bits[spot]
        out[left[hit]] = rank[spot[hit]]
        left = left[~hit]
        base += size
    return out


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint8).reshape(-1, 32)


#: A locator: rows without an id come last, then the smaller id, then the row.
_WINNER = "struct<no_id:boolean,id:bigint,rid:bigint>"
INDEX_SCHEMA = ("part bigint, sizes array<bigint>, bits binary, n_bits bigint, digests binary, "
                "ids array<bigint>, rids array<bigint>, counts array<bigint>")


def parted(groups: DataFrame, parts: int) -> DataFrame:
    return groups.withColumn("part", F.pmod(F.xxhash64("digest"), F.lit(parts)))


def build_index(groups: DataFrame, parts: int) -> DataFrame:
    """One row per partition: its minimal perfect hash and its slots. ``groups``:
    one row per distinct digest (digest binary, id, rid, n)."""
    def build(rows: pa.Table) -> pa.Table:
        digests = _matrix(rows["digest"].to_pylist())
        sizes, bits, slot = build_hash(digests)
        order = np.argsort(slot)
        in_slots = rows.take(pa.array(order))
        whole = lambda c: pa.array([in_slots[c].to_pylist()], pa.list_(pa.int64()))  # noqa: E731  ids stay exact
        return pa.table({
            "part": rows["part"].slice(0, 1), "sizes": pa.array([sizes], pa.list_(pa.int64())),
            "bits": pa.array([np.packbits(bits).tobytes()], pa.binary()), "n_bits": pa.array([len(bits)], pa.int64()),
            "digests": pa.array([digests[order].tobytes()], pa.binary()),
            "ids": whole("id"), "rids": whole("rid"), "counts": whole("n")})

    return parted(groups, parts).groupBy("part").applyInArrow(build, INDEX_SCHEMA)


def resolve(new_groups: DataFrame, index: DataFrame, parts: int) -> DataFrame:
    """One row per distinct digest of history and new rows: digest, id and rid of
    the row that stays, n rows of both. Members of the history take its winner."""
    def look(new: pa.Table, old: pa.Table) -> pa.Table:
        digest, ids, rids, n = (new[c].to_pylist() for c in ("digest", "id", "rid", "n"))
        if old.num_rows:
            (at,) = old.to_pylist()
            slots = _matrix([at["digests"]])
            counts, alone = np.array(at["counts"], np.int64), np.ones(len(digest), bool)
            if digest:
                bits = np.unpackbits(np.frombuffer(at["bits"], np.uint8), count=at["n_bits"]).astype(bool)
                mine = _matrix(digest)
                slot = look_up(mine, at["sizes"], bits)
                member = slot >= 0
                member[member] = (slots[slot[member]] == mine[member]).all(axis=1)
                counts[slot[member]] += np.array(n, np.int64)[member]
                alone = ~member
            keep = np.flatnonzero(alone).tolist()
            digest = [digest[k] for k in keep] + [x.tobytes() for x in slots]
            ids = [ids[k] for k in keep] + at["ids"]
            rids = [rids[k] for k in keep] + at["rids"]
            n = [n[k] for k in keep] + counts.tolist()
        return pa.table({"digest": pa.array(digest, pa.binary()), "keep_id": pa.array(ids, pa.int64()),
                         "keep_rid": pa.array(rids, pa.int64()), "n": pa.array(n, pa.int64())})

    left = parted(new_groups, parts).groupBy("part")
    return left.cogroup(index.groupBy("part")).applyInArrow(
        look, "digest binary, keep_id bigint, keep_rid bigint, n bigint")


def exact_dedup(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", rid_col: str | None = None,
                slots: int = SLOTS) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id (id of the row that stays),
    group_size, kept, text_sha256, and rid.

    Rows with equal normalised texts are one group; its row with the smallest id
    stays. Rows without an id come after all others, and of rows that also share
    the id the first ``rid`` (a unique row id; made here if none is named) stays,
    so each group keeps exactly one row; ``keep_id`` is null only if no row of the
    group has an id. Null texts are empty texts, and one group with them.

    The history is the rows up to the middle of the id range, the new rows are
    all others: every winner in the history comes before every new row.
    """
    spark = docs.sparkSession
    ship(spark)
    rid = F.col(f"`{rid_col}`") if rid_col else F.monotonically_increasing_id()
    rows = written(docs.select(
        rid.cast("bigint").alias("rid"), F.col(f"`{id_col}`").cast("bigint").alias("id"),
        F.unhex(F.sha2(F.encode(normal_text(F.col(f"`{text_col}`")), "utf-8"), 256)).alias("digest")), "digests")
    low, high = rows.agg(F.min("id"), F.max("id")).first()
    middle = (low + high) // 2 if low is not None else 0
    old = F.coalesce(F.col("id") <= F.lit(middle), F.lit(False))
    groups = written(
        rows.groupBy("digest", old.alias("old")).agg(
            F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "rid")).alias("w"), F.count("*").alias("n"))
        .select("digest", "old", "w.id", "w.rid", "n"), "digest-groups")
    parts = max(1, -(-groups.count() // slots))
    index = written(build_index(groups.where("old"), parts), "digest-index")
    kept = resolve(groups.where("NOT old"), index, parts)
    return (rows.join(kept, "digest")
            .select("rid", F.col("id").alias("doc_id"), "keep_id", F.col("n").alias("group_size"),
                    (F.col("rid") == F.col("keep_rid")).alias("kept"),
                    F.lower(F.hex("digest")).alias("text_sha256")))

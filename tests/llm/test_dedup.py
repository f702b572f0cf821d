"""Exact and near deduplication against brute force."""
import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from shoplens.llm import exact_dedup as E
from shoplens.llm import simhash as S
from shoplens.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def groups_of(rows):
    """By brute force: (doc_id, text) -> keep_id, size, digest."""
    of = defaultdict(list)
    for i, t in rows:
        digest = hashlib.sha256(re.sub(r"[\x20\x09-\x0d]+", " ", t or "").encode()).hexdigest()
        of[digest].append(i)
    return {d: (min((i for i in ids if i is not None), default=None), len(ids), ids) for d, ids in of.items()}


def check_exact(found, rows):
    want = groups_of(rows)
    assert len(found) == len(rows)
    for digest, (keep, size, ids) in want.items():
        mine = [r for r in found if r.text_sha256 == digest]
        assert sorted(map(str, ids)) == sorted(str(r.doc_id) for r in mine)
        assert {(r.keep_id, r.group_size) for r in mine} == {(keep, size)}
        kept = [r for r in mine if r.kept]
        assert len(kept) == 1 and kept[0].doc_id == keep


def test_exact_query(spark, some):
    check_exact(QUERIES["op5_exact_dedup"](spark, SF).collect(), [(r.doc_id, r.text) for r in some[1]])


def test_exact_odd_rows(odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    check_exact(E.exact_dedup(odd).collect(), rows)
    check_exact(E.exact_dedup(odd, slots=2).collect(), rows)
    assert E.exact_dedup(none).collect() == []


def test_hash_is_minimal_and_perfect():
    rng = np.random.default_rng(1)
    for n in (1, 2, 7, 1000):
        digests = rng.integers(0, 256, (n, 32), dtype=np.uint8)
        sizes, bits, slot = E.build_hash(digests)
        assert sorted(slot) == list(range(n))
        assert (E.look_up(digests, sizes, bits) == slot).all()
        strange = E.look_up(rng.integers(0, 256, (50, 32), dtype=np.uint8), sizes, bits)
        assert ((strange >= -1) & (strange < n)).all()


def slow_fingerprint(text, size=4):
    words = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())
    if not words:
        return 0
    shingles = [b" ".join(words[k:k + size]) for k in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def slow_components(fps, radius=4):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(fps)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= radius:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [find(x) for x in range(len(fps))]


def check_near(found, rows, fps):
    assert len(found) == len(rows)
    root = slow_components(fps)
    least = defaultdict(list)
    for (i, _), r in zip(rows, root):
        least[r].append(i)
    want = sorted((str(i), format(fp, "016x"), str(min((x for x in least[r] if x is not None), default=None)))
                  for (i, _), fp, r in zip(rows, fps, root))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in found) == want
    if found and "kept" in found[0]:
        assert sum(r.kept for r in found) == len(least)


def test_near_query(spark, some):
    rows = [(r.doc_id, r.text) for r in some[1]]
    check_near(QUERIES["op3_simhash"](spark, SF).collect(), rows, [slow_fingerprint(t) for _, t in rows])


def test_near_odd_rows(odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    check_near(S.simhash_dedup(odd).collect(), rows, [S.fingerprint(t) for _, t in rows])
    assert S.simhash_dedup(none).collect() == []


@pytest.mark.parametrize("text", ["", " \n", "one", "One two", "a b c d", "a b c d e A B", "é ß É " * 40, "x " * 500])
def test_fingerprint(text):
    assert S.fingerprint(text) == slow_fingerprint(text)


def near_values(n, seed):
    rng = random.Random(seed)
    base = [rng.getrandbits(64) for _ in range(max(1, n // 8))]
    out = set()
    while len(out) < n:
        v = rng.choice(base)
        for _ in range(rng.randint(0, 3)):
            v ^= 1 << rng.randrange(64)
        out.add(v)
    return sorted(out)


@pytest.mark.parametrize("n", [1, 2, 3, 40, 300])
def test_tree_finds_all_links(n):
    values = np.array(near_values(n, n), np.uint64)
    found = set()
    for a, b in S.BkTree(values).within(values, 4):
        found |= set(zip(a.tolist(), b.tolist()))
    assert found == {(a, b) for a in range(n) for b in range(n) if int(values[a] ^ values[b]).bit_count() <= 4}


@pytest.mark.parametrize("blocks,tree_rows", [(5, 4096), (5, 16), (6, 16), (8, 4096)])
def test_links_join_what_all_pairs_join(spark, blocks, tree_rows):
    """Any number of blocks, and shards cut into many trees."""
    values = near_values(200, 5) + [v ^ 1 << b for b in range(60) for v in near_values(1, 9)]
    values = sorted(set(values))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    nodes = {r.node: r.root for r in S.components(S.links(df, 4, blocks, tree_rows)).collect()}
    got, want = defaultdict(set), defaultdict(set)
    for v, s, r in zip(values, signed, slow_components(values)):
        got[nodes.get(s, s)].add(v)
        want[r].add(v)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(k + 1, k) for k in range(300)], "a bigint, b bigint")
    assert {r.root for r in S.components(edges).collect()} == {0}


def test_more_blocks_for_more_fingerprints():
    assert [S.block_count(n, 4) for n in (0, 10**5, 10**7, 10**9, 10**12)] == [5, 5, 6, 7, 8]


def test_large_ids_beside_a_null_id_stay_exact(spark):
    rows = [(1, "a"), (2**53 + 1, "b"), (2**53 + 3, "b"), (None, "b"), (None, "c"), (2**53 + 5, "c"), (2**62 + 1, "d"), (2**62 + 3, "d")]
    got = E.exact_dedup(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    first = {"a": 1, "b": 2**53 + 1, "c": 2**53 + 5, "d": 2**62 + 1}
    want = sorted(((i, first[t], sum(x == t for _, x in rows), i == first[t]) for i, t in rows), key=repr)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in got), key=repr) == want

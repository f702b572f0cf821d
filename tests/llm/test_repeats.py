"""Passages removed against a brute-force version, and the levels on their own."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from shoplens.llm import repeats as R
from shoplens.llm import word_blocks as W


def brute(rows, window):
    """rows: (doc_id, text) -> sorted (doc_id, n_words, n_removed, kept_sha256)."""
    docs = [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode()) for _, t in rows]
    seen = Counter(tuple(d[i:i + window]) for d in docs for i in range(len(d) - window + 1))
    out = []
    for (doc_id, _), d in zip(rows, docs):
        gone = {i + k for i in range(len(d) - window + 1) if seen[tuple(d[i:i + window])] > 1 for k in range(window)}
        kept = b" ".join(w for i, w in enumerate(d) if i not in gone)
        out.append((doc_id, len(d), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def removed(spark, rows, parts=3, **options):
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(parts)
    got = R.without_repeats(df, **options)
    return sorted((tuple(r) for r in got.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=repr)


def random_rows(seed, n=60, vocabulary=4, longest=60):
    rng = random.Random(seed)
    passages = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 25))) for _ in range(6)]
    rows = []
    for k in range(n):
        words = [rng.choice("wxyzéß"[:vocabulary + 2]) + str(rng.randint(0, 40)) for _ in range(rng.randint(0, longest))]
        for _ in range(rng.randint(0, 2)):
            words.insert(rng.randint(0, len(words)), rng.choice(passages))
        rows.append((k, rng.choice([" ", "  ", "\t", "\r\n "]).join(words)))
    return rows


@pytest.mark.parametrize("window, first", [(7, 2), (7, 9), (5, 5), (12, 3), (1, 1), (2, 1)])
def test_equals_brute_force(spark, window, first):
    rows = random_rows(window * 10 + first)
    for size in (64, 1 << 20):
        assert removed(spark, rows, window=window, first=first, block_bytes=size, part_keys=50) == brute(rows, window)


def test_given_documents(spark, some):
    docs, rows = some
    got = R.without_repeats(docs)
    mine = sorted((tuple(r) for r in got.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=repr)
    assert mine == brute([(r.doc_id, r.text) for r in rows], 35)
    assert sum(r[2] for r in mine) > 0


def test_odd_documents(spark, odd, none):
    want = brute([(r.doc_id, r.text) for r in odd.collect()], 35)
    got = R.without_repeats(odd, block_bytes=1000)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept_sha256", "text", "passages"]
    assert sorted((tuple(r)[:4] for r in got.collect()), key=repr) == want
    assert R.without_repeats(none).count() == 0
    blank = spark.createDataFrame([(1, None), (2, " \n")], "doc_id bigint, text string")
    assert [(r.n_words, r.text, r.passages) for r in R.without_repeats(blank).collect()] == [(0, "", [])] * 2


def test_passages_and_text(spark):
    common = " ".join(f"c{k}" for k in range(10))
    rows = [(1, f"one {common} two"), (2, f"{common} three {common}"), (3, "four five")]
    got = {r.doc_id: r for r in R.without_repeats(spark.createDataFrame(rows, "doc_id int, text string"), window=10, first=3).collect()}
    assert [tuple(p) for p in got[1].passages] == [(1, 11)] and got[1].text == "one two"
    assert [tuple(p) for p in got[2].passages] == [(0, 10), (11, 21)] and got[2].text == "three"
    assert got[3].passages == [] and got[3].text == "four five"


def test_levels(spark):
    assert R.lengths_of(35, 9) == [9, 18, 35]
    assert R.lengths_of(8, 1) == [1, 2, 4, 8]
    assert R.lengths_of(3, 9) == [3]
    # short repeats survive the first level only: nothing is left to extend, no passage is found
    rows = [(k, " ".join(f"{k}-{j}" for j in range(20)) + " same short run") for k in range(10)]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    blocks = R.pack_documents(df, "text", "doc_id", 100)
    assert R.repeated_passages(blocks, 12, 3) is None
    # a run must be as long as the window asked for to reach the next level
    copies = df.union(spark.createDataFrame([(99, rows[0][1])], df.schema))
    state = R.repeated_passages(R.pack_documents(copies, "text", "doc_id", 100), 12, 3)
    assert sorted(c for r in state.collect() for c in R.unpack(r["counts"], "<u4").tolist()) == [23, 23]


def test_fingerprints_depend_on_all_words():
    rng = np.random.default_rng(0)
    words = [str(k).encode() for k in range(50)]
    numbers = rng.integers(0, 50, 5000)
    for length in (1, 2, 5, 9, 35):
        a, b = R.fingerprints(numbers, words, length, 2)
        seen = {}
        for k in range(len(a)):
            assert seen.setdefault((a[k], b[k]), tuple(numbers[k:k + length])) == tuple(numbers[k:k + length])
        assert len(seen) == len({tuple(numbers[k:k + length]) for k in range(len(a))})


def test_hot_passage_is_one_key_a_block(spark):
    """A passage in every document sends one number of each block, however often it is there."""
    same = " ".join(f"h{k}" for k in range(40))
    rows = [(k, same + f" {k}") for k in range(400)]
    df = spark.createDataFrame(rows, "doc_id int, text string").coalesce(1)
    blocks = R.pack_documents(df, "text", "doc_id", 1 << 20)
    dealt = R.dealt_keys(blocks, 35, 4, True)
    keys = sum(len(R.unpack(r["keys"][0], "<u8")) for r in dealt.collect())
    assert keys <= 6 + 400  # the passage's 6 windows and those that end in a document's own word
    assert removed(spark, rows, window=35) == brute(rows, 35)


def test_words_are_those_between_ascii_white_space():
    import pyarrow as pa

    counts, numbers, words = W.numbered(pa.array([" a \x0b b\x1cc\x85d\xa0e ", None, "", "\n", "b b"]))
    assert counts.tolist() == [2, 0, 0, 0, 2]
    assert [words[k] for k in numbers] == [b"a", "b\x1cc\x85d\xa0e".encode(), b"b", b"b"]
    packed = W.pack_words([b"", b"x", "é".encode()])
    assert W.unpack_words(*packed) == [b"", b"x", "é".encode()]

"""Collocations against a brute-force count, and the stripes on their own."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoplens.llm import phrases as P

SCHEMA = "text string, lang string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(rows, longest):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, longest + 1):
                f[lang].update(tuple(words[i:i + m]) for i in range(len(words) - m + 1))
    return f, n


def brute(rows, longest=5, least=100, top=2000, held=100):
    f, n = counted(rows, longest)
    out = []
    for lang, f in f.items():
        big = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        most = Counter()
        for p, a in big.items():
            for i in range(len(p)):
                for j in range(i + 1, len(p) + 1):
                    if j - i < len(p):
                        most[p[i:j]] = max(most[p[i:j]], a)
        rows = []
        for p, a in big.items():
            if 100 * most[p] >= held * a:
                continue
            score, k = min(((1000 * a * n[lang]) // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def found(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return sorted(tuple(r) for r in P.collocations(df, **options).collect())


def random_rows(seed, n=150):
    rng = random.Random(seed)
    words = ["a", "B", "cé", "d", "e-f", "日本", "g", "h\x1ci", "Z"]
    idioms = [[rng.choice(words) for _ in range(rng.randint(2, 7))] for _ in range(5)]
    rows = []
    for _ in range(n):
        out = []
        for _ in range(rng.randint(0, 12)):
            out += rng.choice(idioms) if rng.random() < 0.5 else [rng.choice(words)]
            if rng.random() < 0.2:
                out.append(rng.choice([".", ", ", " ;:", "\n", "!?", "\x0b"]))
        rows.append((rng.choice([" ", "  ", "\t "]).join(out), rng.choice(["en", "en", "en", "de", None, "und", ""])))
    return rows


@pytest.mark.parametrize("longest, least, top, held", [
    (5, 4, 2000, 100), (5, 10, 7, 100), (3, 3, 50, 60), (2, 2, 20, 100), (7, 5, 100, 100)])
def test_equals_brute_force(spark, longest, least, top, held):
    rows = random_rows(longest * 100 + least)
    want = brute(rows, longest, least, top, held)
    for size in (300, 1 << 20):
        got = found(spark, rows, longest=longest, least=least, top=top, held=held, block_bytes=size, part_keys=40)
        assert got == want
    assert want


def test_given_documents(spark, some):
    docs, rows = some
    got = sorted(tuple(r) for r in P.collocations(docs, least=20).collect())
    assert got == brute([(r.text, r.lang) for r in rows], least=20) and got


def test_odd_documents(spark, odd, none):
    rows = [(r.text, r.lang) for r in odd.collect()]
    got = P.collocations(odd, least=2)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, least=2)
    assert P.collocations(none).collect() == []
    assert found(spark, [(None, None), ("", "en"), (" \n..", "en")], least=1) == []
    assert found(spark, [("one two", "en")], least=100) == []


def test_overlapping_and_piece_ends(spark):
    rows = [("la " * 50, "x"), ("la. la, la\nla", "x"), ("LA\tLa", "x")]
    assert found(spark, rows, least=5) == brute(rows, least=5)


def test_scores_beyond_64_bits(spark):
    phrases = spark.createDataFrame(
        [("x", "p q r", 7 * 10**13, [10**14, 9 * 10**13], [8 * 10**13, 7 * 10**13 + 1])],
        "lang string, phrase string, a bigint, firsts array<bigint>, lasts array<bigint>")
    n = spark.createDataFrame([("x", 10**16)], "lang string, n bigint")
    top = 1000 * 7 * 10**13 * 10**16
    want = min((top // (10**14 * (7 * 10**13 + 1)), 1), (top // (9 * 10**13 * 8 * 10**13), 2))
    got = P.scored(phrases, n).first()
    assert (got.score, got.l) == (want[0], [10**14, 9 * 10**13][want[1] - 1])


def test_ties_take_the_first_cut(spark):
    phrases = spark.createDataFrame([("x", "p q r", 5, [10, 20], [10, 20])],
                                    "lang string, phrase string, a bigint, firsts array<bigint>, lasts array<bigint>")
    got = P.scored(phrases, spark.createDataFrame([("x", 100)], "lang string, n bigint")).first()
    assert (got.l, got.r, got.score) == (10, 20, 2500)


def test_stripes_merge_element_by_element(spark):
    """Totals of merged stripes are the phrases' own counts, whatever block they are in."""
    rows = random_rows(5)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    tables, n_words = P.phrase_counts(df, least=3, block_bytes=200, part_keys=20)
    f, n = counted(rows, 5)
    assert {r.lang: r.n for r in n_words.collect() if r.n} == {k: v for k, v in n.items() if v}
    seen = 0
    for m, t in enumerate(tables, 2):
        for r in t.collect():
            words = tuple(r.phrase.split(" "))
            assert len(words) == m and r.a == f[r.lang][words]
            assert r.firsts == [f[r.lang][words[:k]] for k in range(1, m)]
            assert r.lasts == [f[r.lang][words[-k:]] for k in range(1, m)]
            if m < 5:
                assert r.total == r.a
            seen += 1
    assert seen == sum(a >= 3 and len(p) > 1 for c in f.values() for p, a in c.items())


def test_a_stripe_is_spread_over_parts():
    """A prefix that many words follow isn't one part's."""
    names = np.arange(1, 5002, dtype=np.uint64)
    places = np.ravel(np.column_stack((np.ones(5000, np.int64), np.arange(2, 5002))))
    row = {"places": P.pack(places.astype(np.uint32)), "names": P.pack(names), "block": 0}
    s = P.Stripes(row, (8, 8))
    hot = s.part[s.prefix == names[0]]
    assert len(set(hot.tolist())) == 8 and np.bincount(hot).max() < 5000 / 8 * 1.5

"""Language ID, quality, language-model scores, BPE."""
import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shoplens.llm import bpe, fm_quality, lang_id, ppm
from shoplens.llm.queries import QUERIES

SF, SF_MORE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
VOCAB = public_tokenizers.path("byte_bpe_50k.json")


def held_out(i, folds, rest):
    return zlib.crc32(str(i).encode()) % folds == rest


# Language ID

def test_language_query(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF_MORE}/documents.parquet").collect()}
    found = QUERIES["op8_language_id"](spark, SF_MORE).collect()
    assert sorted(r.doc_id for r in found) == sorted(docs)
    assert all(r.held_out == held_out(r.doc_id, 4, 2) and 0 <= r.score <= 1 for r in found)
    right = [r.lang_pred == docs[r.doc_id].lang for r in found if r.held_out]
    assert sum(right) / len(right) > 0.97


def test_language_counts_are_whole(spark):
    rows = [("en", "a b a"), ("en", "B"), ("fr", "a " * 5000), ("fr", "c")]
    df = spark.createDataFrame(rows, "lang string, text string")
    got = {(r.lang, r.word): r.n for r in lang_id.word_counts(df).collect()}
    assert got == {("en", "a"): 2, ("en", "b"): 2, ("fr", "a"): 5000, ("fr", "c"): 1}


def test_language_backoff(spark):
    rows = [("en", "the then there")] * 5 + [("de", "der dessen denn")] * 5
    model = lang_id.fit(spark.createDataFrame(rows, "lang string, text string"))
    assert model.predict("THE")[0] == "en" and model.predict("denn")[0] == "de"
    assert model.predict("thenn")[0] == "en"  # unseen: by its n-grams
    assert model.predict("dess")[0] == "de"
    for text in (None, "", " ", "12 34 !?"):
        assert model.predict(text) == ("und", 0.0)
    assert 0.5 <= model.predict("zzz")[1] < 0.6  # only its borders are known: nearly as likely either way


def test_language_odd_rows(odd, none):
    model = lang_id.fit(odd.select("lang", "text"))
    assert set(model.langs) == {"en", "de"}
    found = lang_id.predict(odd.select("doc_id", "text", "n"), model).collect()
    assert len(found) == odd.count() and {r.n for r in found} == {"own n"}
    assert all(r.lang_pred == "und" for r in found if r.doc_id in (5, 6, 7, 8))
    empty = lang_id.fit(none.select("lang", "text"))
    assert empty.langs == [] and lang_id.predict(none, empty).collect() == []
    assert lang_id.accepted(odd, empty).count() == odd.count()
    kept = lang_id.accepted(odd, model)
    assert kept.columns == odd.columns and {5, 6, 7, 8}.isdisjoint(r.doc_id for r in kept.collect())


def test_language_entries_are_bounded(spark):
    text = " ".join(f"w{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(400))
    df = spark.createDataFrame([("en", text)], "lang string, text string")
    assert lang_id.fit(df, min_share=1 / 300).known == 0
    assert lang_id.fit(df, min_share=1 / 400).known == 400


# Quality

def test_quality_query(spark):
    found = QUERIES["op7_quality"](spark, SF_MORE).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_MORE}/labels.parquet").collect()}
    assert len(found) == spark.read.parquet(f"{SF_MORE}/documents.parquet").count()
    assert all(r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for r in found)
    rest = [r for r in found if r.held_out and r.doc_id in labels]
    assert all(r.held_out == held_out(r.doc_id, 4, 2) for r in found)
    assert sum(r.predicted == labels[r.doc_id] for r in rest) / len(rest) > 0.93


def test_machine_sums_all_pairs():
    features = fm_quality.Features(64, 0)
    machine = fm_quality.Machine(features, 3, 1)
    rng = np.random.default_rng(2)
    machine.w[:] = rng.normal(size=features.size)
    at, x = features("Some words, and some MORE words.\nLine two")
    pairs = sum(x[a] * x[b] * float(machine.v[at[a]] @ machine.v[at[b]]) for a in range(len(at)) for b in range(a))
    assert math.isclose(machine.raw(at, x), float(machine.w[at] @ x) + pairs, rel_tol=1e-9)


def test_quality_odd_rows(odd, none, spark):
    labels = spark.createDataFrame([(1, 1), (2, 1), (8, 0), (8, None), (9, 5), (None, 1), (77, 0)],
                                   "doc_id bigint, quality int")
    machine = fm_quality.fit(odd, labels, metadata=("n_chars", "source"), epochs=2)
    found = fm_quality.score(odd.select("doc_id", "text", "n_chars", "source", "rid"), machine,
                             metadata=("n_chars", "source")).collect()
    assert len(found) == odd.count() and all(0 <= r.score <= 1 for r in found)
    machine = fm_quality.fit(none, labels)
    assert fm_quality.score(none.select("doc_id", "text"), machine).collect() == []
    assert {r.score for r in fm_quality.score(odd.select("doc_id", "text"), machine).collect()} == {0.5}


def test_quality_fit_is_bounded_and_repeatable(spark):
    docs = spark.createDataFrame([(k, ("good text. " if k % 2 else "bad ### ") * 5) for k in range(60)],
                                 "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)], "doc_id bigint, quality int")
    a, b = (fm_quality.fit(docs, labels, max_rows=20, epochs=2) for _ in range(2))
    assert (a.w == b.w).all() and (a.v == b.v).all()
    assert a.score("good text. " * 3) > a.score("bad ### " * 3)


# Language-model scores

def slow_ppm(rows, order):
    """{doc_id: log10 probability} by counters and sets."""
    seen = [defaultdict(Counter) for _ in range(order + 1)]
    texts = {i: b"\n" * order + ppm.normal(t) + b"\n" for i, t, _ in rows}
    for i, _, train in rows:
        s = texts[i]
        for k in range(order, len(s) if train else 0):
            for j in range(order + 1):
                seen[j][s[k - j:k]][s[k]] += 1
    out = {}
    for i, s in texts.items():
        total = 0.0
        for k in range(order, len(s)):
            excluded = set()
            for j in range(order, -1, -1):
                here = seen[j].get(s[k - j:k])
                if here is None:
                    excluded = set()
                    continue
                left = {b: n for b, n in here.items() if b not in excluded}
                if s[k] in here:
                    total += math.log10((left[s[k]] - ppm.DISCOUNT) / sum(left.values()))
                    break
                if left:
                    total += math.log10(ppm.DISCOUNT * len(left) / sum(left.values()))
                excluded = set(here)
            else:
                total -= math.log10(256 - len(excluded))
        out[i] = total
    return out


def slow_base(rows):
    counts = Counter()
    for _, t, train in rows:
        if train:
            counts.update([*(t or "").encode().lower().split(), b"\n"])
    n, v = sum(counts.values()), len(counts)
    out = {}
    for i, t, _ in rows:
        tokens = [*(t or "").encode().lower().split(), b"\n"]
        out[i] = (len(tokens), sum(counts[w] > 0 for w in tokens), n,
                  sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens))
    return out


def check_ppm(found, rows, order):
    assert len(found) == len(rows)
    score, base = slow_ppm(rows, order), slow_base(rows)
    for r in found:
        assert (r.n_tokens, r.n_known, r.train_tokens) == base[r.doc_id][:3]
        assert math.isclose(r.base_score, base[r.doc_id][3], rel_tol=1e-9)
        assert math.isclose(r.score, score[r.doc_id], rel_tol=1e-5)


@pytest.mark.parametrize("order,block,part", [(6, 8 << 20, 64 << 20), (3, 3000, 9000), (1, 500, 64 << 20)])
def test_ppm_against_brute_force(spark, some, order, block, part):
    rows = [(r.doc_id, r.text[:1500], r.doc_id % 10 != 3) for r in some[1][:60]]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, train boolean")
    check_ppm(ppm.ppm_score(df, "train", order=order, block_bytes=block, part_bytes=part).collect(), rows, order)


def test_ppm_splits_large_parts(spark, some):
    rows = [(r.doc_id, r.text, r.doc_id % 10 != 0) for r in some[1][:40]]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, train boolean")
    check_ppm(ppm.ppm_score(df, "train", order=4, block_bytes=2000, task_bytes=100).collect(), rows, 4)
    counted = spark.createDataFrame([("g", 0, 90), ("g", 0, 60), ("g", 1, 5), ("w", 0, 400)],
                                    "kind string, part int, size bigint")
    model = spark.createDataFrame([("g", 0, 70), ("g", 1, 5), ("w", 0, 50)], "kind string, part int, size bigint")
    assert {tuple(r) for r in ppm.salts(counted, 20).collect()} == {("g", 0, 8, 0), ("g", 1, 1, 8), ("w", 0, 20, 9)}
    assert {tuple(r) for r in ppm.salts(counted, 20, model).collect()} == {
        ("g", 0, 3, 0), ("g", 1, 1, 3), ("w", 0, 8, 4)}
    blocks = spark.range(0, 7, 1, 3).select(F.monotonically_increasing_id().alias("block"))
    assert sorted(r.block for r in ppm.numbered(blocks).collect()) == list(range(7))


def test_ppm_query_beats_the_base(spark):
    found = QUERIES["op6_ppm"](spark, SF_MORE).collect()
    rest = [r for r in found if r.held_out]
    assert all(r.held_out == held_out(r.doc_id, 10, 0) for r in found)
    assert sum(r.score for r in rest) > sum(r.base_score for r in rest)


def test_ppm_probabilities_sum_to_one():
    text = b"abracadabra alakazam"
    keys, counts = ppm.gram_counts([text], [True], 3)
    low = np.bincount((keys & np.uint64(0xFFFF)).astype(np.int64), counts, 65536).astype(np.int64)
    trie = ppm.Trie(keys, counts, low, 3)
    for context in (b"abr", b"zab", b"qqa", b"qqq", b"\n\n\n"):
        grams = np.array([int.from_bytes(context + bytes([b]), "big") for b in range(256)], np.uint64)
        assert math.isclose((10 ** trie.cost(grams)).sum(), 1, rel_tol=1e-9)


def test_ppm_odd_rows(odd, none, spark):
    rows = [(k, r.text, k % 3 > 0) for k, r in enumerate(odd.collect()) if r.doc_id not in (9, 10)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, learn boolean").withColumn("train", F.lit("own"))
    check_ppm(ppm.ppm_score(df, "learn", order=4).collect(), rows, 4)
    found = ppm.ppm_score(odd.withColumn("learn", F.col("doc_id") > 6), "learn", block_bytes=1000).collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(r.doc_id) for r in odd.collect())
    untrained = ppm.ppm_score(odd.withColumn("learn", F.lit(None).cast("boolean")), "learn").collect()
    for r in untrained:
        assert r.train_tokens == r.n_known == 0 and r.held_out and r.base_score == 0
    assert math.isclose(next(r.score for r in untrained if r.doc_id == 5), -math.log10(256), rel_tol=1e-6)
    assert ppm.ppm_score(none.withColumn("learn", F.lit(True)), "learn").collect() == []


def test_ppm_cuts_long_texts_without_loss():
    text = ppm.normal("some words and others " * 50)
    one = ppm.gram_counts([text], [True], 4)
    code, lengths = [], []
    for of, pieces in ppm.chunks([text], 4, 64):
        code.append(ppm.grams(pieces, 4)[0])
        lengths += [len(b) for _, b in pieces]
    assert max(lengths) <= 64 and sum(lengths) == len(text) + 1
    keys, counts = np.unique(np.concatenate(code), return_counts=True)
    assert (keys == one[0]).all() and (counts == one[1]).all()
    assert [w for part in ppm.words_in(text, 30) for w in part] == text.split()


def test_finder_and_packing():
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(0, 2**63, 5000, dtype=np.uint64))
    wanted = rng.choice(keys, 20000)
    assert (keys[ppm.Finder(keys)(wanted)] == wanted).all()
    assert (ppm.unpack(ppm.pack(keys, True), "<u8", True) == keys).all()
    assert len(ppm.unpack(ppm.pack(keys[:0], True), "<u8", True)) == 0


# BPE

@pytest.fixture(scope="module")
def coders():
    return bpe.TrieEncoder(VOCAB), Tokenizer.from_file(VOCAB)


def agrees(coders, text):
    ours, theirs = coders
    code = ours.encode([text])[0]
    assert np.frombuffer(code, "<u4").tolist() == theirs.encode(text, add_special_tokens=False).ids, repr(text)
    assert ours.decode(code) == text.encode()


@pytest.mark.parametrize("text", [
    "", " ", "a", "  a", "Hello world", "don't we'll I'm it's 'S 's", "a\n\nb", "x  \t y", "12345 6", "é ß ñ Ÿ",
    "日本語 テキスト", "😀👍🏽 ok", "<|endoftext|>", "a<|endoftext|>b <|endoftext|", " \u0085 x", "İ ǅ",
    "\x00\x1c\x1f", "é", "٣½", "�", "-" * 300, "=" * 100 + "a" * 100, "ab" * 2000, " " * 500 + "x"])
def test_bpe_cases(coders, text):
    agrees(coders, text)


def test_bpe_random_texts(coders):
    rng = random.Random(3)
    letters = list("abcdeé ß\n\t'’sStTmM0123½   日本😀à.,!?-_<|>") + ["'ll", "  ", "----", "and", "tion"]
    for _ in range(3000):
        agrees(coders, "".join(rng.choice(letters) for _ in range(rng.randint(0, 30))))
    for _ in range(2000):
        text = "".join(chr(rng.choice([rng.randint(0, 0x2FF), rng.randint(0, 0xD7FF), rng.randint(0x10000, 0x1FFFF)]))
                       for _ in range(rng.randint(0, 12)))
        agrees(coders, text)


def test_bpe_documents(coders, some):
    for r in some[1]:
        agrees(coders, r.text)


def test_bpe_cache_is_bounded(coders, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 10)
    monkeypatch.setattr(bpe, "CACHE_PAIRS", 10)
    for text in ("one two three four five six seven eight nine ten eleven twelve", "one thirteen", "x" * 200, "x" * 200):
        agrees(coders, text)
    assert "x" * 200 not in coders[0].cache


def test_bpe_query(spark, some):
    tok = Tokenizer.from_file(VOCAB)
    found = {r.doc_id: r for r in QUERIES["op9_bpe"](spark, SF).collect()}
    assert len(found) == len(some[1])
    for r in some[1]:
        ids = np.array(tok.encode(r.text, add_special_tokens=False).ids, "<u4")
        mine = found[r.doc_id]
        assert (mine.n_tokens, mine.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert mine.decoded_sha256 == hashlib.sha256(r.text.encode()).hexdigest()


def test_bpe_odd_rows(odd, none):
    tok = Tokenizer.from_file(VOCAB)
    found = bpe.encode_documents(odd, VOCAB, keep=("doc_id", "n")).collect()
    assert len(found) == odd.count() and {r.n for r in found} == {"own n"}
    rows = sorted(((str(r.doc_id), r.text or "") for r in odd.collect()))
    got = sorted(((str(r.doc_id), tok.decode(r.ids, skip_special_tokens=False)) for r in found))
    assert got == rows
    assert all(len(r.ids) == r.n_tokens for r in found)
    assert bpe.encode_documents(none, VOCAB, keep=("doc_id",)).collect() == []


def test_signs_and_numbers_are_no_letters(spark):
    assert lang_id.words_of("½ ² ① Ⅷ ٣ 7 _ — !") == []
    assert lang_id.words_of("x² Äb½c 日本 ①d") == ["x", "äb", "c", "日本", "d"]
    model = lang_id.fit(spark.createDataFrame([("en", "the cat"), ("de", "die katze")], "lang string, text string"))
    got = lang_id.predict(spark.createDataFrame([(1, "½ ²"), (2, "the ²")], "doc_id int, text string"), model).collect()
    assert {r.doc_id: (r.lang_pred, r.score > 0) for r in got} == {1: ("und", False), 2: ("en", True)}


def test_more_than_200_languages(spark):
    rows = [(f"l{k:03}", f"w{'abcdefghij'[k % 10]}{'klmnopqrst'[k // 10 % 10]}{'uvwxyz'[k // 100]} common") for k in range(230)]
    model = lang_id.fit(spark.createDataFrame(rows, "lang string, text string"))
    assert len(model.langs) == 230
    assert model.predict(rows[137][1])[0] == "l137"

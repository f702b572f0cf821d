"""Decontamination, sharding and the pipeline."""
import random
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shoplens.llm import decontam, sharding
from shoplens.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


# Decontamination

def slow_tiles(item, doc, least):
    """Greedy string tiling as defined: the longest unmarked matches first."""
    marked_item, marked_doc, tiles = set(), set(), []
    while True:
        longest, found = least - 1, []
        for i in range(len(item)):
            for d in range(len(doc)):
                n = 0
                while (i + n < len(item) and d + n < len(doc) and item[i + n] == doc[d + n]
                       and i + n not in marked_item and d + n not in marked_doc):
                    n += 1
                if n > longest:
                    longest, found = n, []
                if n == longest and n >= least:
                    found.append((i, d))
        if not found:
            return tiles
        for i, d in found:
            if not any(i + k in marked_item or d + k in marked_doc for k in range(longest)):
                tiles.append((i, d, longest))
                marked_item.update(range(i, i + longest))
                marked_doc.update(range(d, d + longest))


def test_tiles_against_brute_force():
    rng = random.Random(4)
    for _ in range(150):
        item = [rng.choice("abcd") for _ in range(rng.randint(3, 25))]
        doc = [rng.choice("abcde") for _ in range(rng.randint(0, 15))]
        for _ in range(rng.randint(0, 3)):
            a = rng.randrange(len(item))
            doc[len(doc):] = item[a:a + rng.randint(1, 9)]
        number = {w: k for k, w in enumerate("abcd", 1)}
        ids = [np.array([number.get(w, 0) for w in x], np.uint64) for x in (item, doc)]
        assert decontam.tile(*ids, 3) == slow_tiles(item, doc, 3), (item, doc)


def test_query_against_brute_force(spark):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    found = {(r.doc_id, r.item_id): r.coverage for r in QUERIES["op1_decontamination"](spark, SF).collect()}
    want = {}
    for b in bench:
        item = decontam.words_of(b.text)
        seeds = {tuple(item[k:k + 5]) for k in range(len(item) - 4)}
        for d in docs:
            doc = decontam.words_of(d.text)
            if any(tuple(doc[k:k + 5]) in seeds for k in range(len(doc) - 4)):
                share = sum(n for _, _, n in slow_tiles(item, doc, 5)) / len(item)
                if share >= 0.6:
                    want[d.doc_id, b.item_id] = share
    assert found == pytest.approx(want) and want


WORDS = [f"w{k}" for k in range(400)]


def hits(spark, docs, items, **more):
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    b = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontam.contaminated(d, b, **more)
    clean = decontam.clean_documents(d.withColumn("item_id", F.lit("own")), b, **{k: v for k, v in more.items()})
    return found.collect(), clean.collect()


def test_reordered_edited_and_clean_passages(spark):
    item = WORDS[:30]
    docs = [(1, " ".join(WORDS[100:150] + item + WORDS[150:200])),
            (2, " ".join(WORDS[100:110] + item[15:] + WORDS[110:150] + item[:15])),  # two halves, the other way
            (3, " ".join(item[:12] + ["new"] + item[13:])), (4, ", ".join(w.upper() for w in item) + "!"),
            (5, " ".join(item[:9] + WORDS[200:300])),  # 30 % of it
            (6, " ".join(w for pair in zip(item, WORDS[300:]) for w in pair)),  # its words, no run
            (7, " ".join(item[:14] * 3))]  # half of it, often
    found, clean = hits(spark, docs, [(8, " ".join(item)), (9, "too few words"), (None, None), (10, "")])
    assert {r.doc_id: (r.item_id, round(r.coverage, 3), r.n_tiles) for r in found} == {
        1: (8, 1.0, 1), 2: (8, 1.0, 2), 3: (8, 0.967, 2), 4: (8, 1.0, 1)}
    assert [(t.item_at, t.doc_at, t.words) for r in found if r.doc_id == 2 for t in r.tiles] == [(0, 65, 15), (15, 10, 15)]
    assert sorted(r.doc_id for r in clean) == [5, 6, 7] and {r.item_id for r in clean} == {"own"}


def test_blocks_of_seeds_change_nothing(spark, monkeypatch):
    rng = random.Random(2)
    items = [(k, " ".join(rng.choices(WORDS, k=20))) for k in range(30)]
    docs = [(k, " ".join(rng.choices(WORDS, k=50)) + " " + items[k % 30][1]) for k in range(40)]
    key = lambda rows: sorted((r.doc_id, r.item_id, r.coverage) for r in rows)
    whole = hits(spark, docs, items)
    monkeypatch.setattr(decontam.seed_blocks, "__defaults__", (100,))
    cut = hits(spark, docs, items)
    assert key(whole[0]) == key(cut[0]) and len(whole[0]) >= 40 and whole[1] == cut[1] == []


def test_decontamination_odd_rows(spark, odd, none):
    bench = spark.createDataFrame([(1, "this is a plain text of some words"), (2, "tälk wörd tälk wörd tälk wörd")],
                                  "item_id bigint, text string")
    found = decontam.contaminated(odd, bench).collect()
    assert sorted((str(r.doc_id), r.item_id) for r in found) == [
        ("1", 1), ("10", 2), ("2", 1), ("2", 1), ("9", 2), ("None", 1)]
    clean = decontam.clean_documents(odd, bench)
    assert clean.columns == odd.columns and clean.count() == odd.count() - 6
    assert decontam.contaminated(none, bench).collect() == []
    assert decontam.clean_documents(odd, bench.limit(0)).count() == odd.count()
    assert decontam.contaminated(odd, bench.limit(0)).collect() == []


def test_short_items_and_scripts_without_blanks(spark):
    han = "春眠不覺曉處處聞啼鳥"
    docs = [(1, "So, to be or not it is."), (2, "to be not or"), (3, "is it to be, Or not"), (4, f"他說：{han}夜來風雨聲"),
            (5, f"{han[:4]} x {han[7:]}"), (6, "東京都に住む"), (7, "東と京"), (8, None), (9, "Or")]
    items = [(1, "to be or not"), (2, han), (3, "東京"), (4, " ?! "), (5, "Or."), (6, " ".join(WORDS[:20]))]
    found, clean = hits(spark, docs, items)
    assert sorted((r.doc_id, r.item_id, r.coverage) for r in found) == [
        (1, 1, 1.0), (1, 5, 1.0), (2, 5, 1.0), (3, 1, 1.0), (3, 5, 1.0), (4, 2, 1.0), (6, 3, 1.0), (9, 5, 1.0)]
    assert sorted(r.doc_id for r in clean) == [5, 7, 8]


# Sharding

def check_shards(rows, shards, want):
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    sizes = [len(slots.get(s, [])) for s in range(shards)]
    assert sum(sizes) == len(rows) == len(want) and max(sizes) - min(sizes) <= 1
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert set(slots) <= set(range(shards))
    assert Counter(map(str, (r.doc_id for r in rows))) == Counter(map(str, want))


def test_sharding_query(spark, some):
    found = QUERIES["op10_sharding"](spark, SF).collect()
    check_shards(found, 40, [r.doc_id for r in some[1]])
    texts = {r.doc_id: r.text.encode() for r in some[1]}
    for r in found:
        assert (r.size, r.text_crc32) == (len(texts[r.doc_id]) + 16, zlib.crc32(texts[r.doc_id]))
        assert r.law == "rows" and r.grown_shard is None
    order = [r.doc_id for r in sorted(found, key=lambda r: (r.shard, r.slot))]
    assert sum(abs(a - b) == 1 for a, b in zip(order, order[1:])) < 20  # shuffled


def test_sharding_odd_rows(spark, odd, none):
    found = sharding.shuffle_to_shards(odd, sharding.shards_path(spark), shards=4, bucket_bytes=100)
    rows = found.collect()
    check_shards(rows, 4, [r.doc_id for r in odd.collect()])
    assert sorted(map(str, found.select(*odd.columns).collect())) == sorted(map(str, odd.collect()))
    assert sharding.law_holds(found, 4).first() == (True, True, True)
    assert sharding.shuffle_to_shards(none, sharding.shards_path(spark)).collect() == []
    with pytest.raises(ValueError):
        sharding.shuffle_to_shards(odd.withColumn("Slot", F.lit(1)), sharding.shards_path(spark))


def test_hot_rows_are_scattered(spark, monkeypatch):
    """A third of all rows are one row; its copies go to all buckets."""
    monkeypatch.setattr(sharding, "HOT_COPIES", 20)
    df = spark.range(600).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"),
                                 F.when(F.col("id") % 3 > 0, F.concat(F.lit("text "), "id")).alias("text"))
    found = sharding.shuffle_to_shards(df, sharding.shards_path(spark), shards=7, bucket_bytes=1000).collect()
    check_shards(found, 7, [r.doc_id for r in df.collect()])
    per = Counter(r.shard for r in found if r.doc_id is None)
    assert len(per) == 7 and max(per.values()) < 60


def test_another_seed_gives_another_order(spark, some):
    def order(seed):
        found = sharding.shuffle_to_shards(some[0], sharding.shards_path(spark), shards=3, seed=seed).collect()
        return [r.doc_id for r in sorted(found, key=lambda r: (r.shard, r.slot))]
    assert order(1) != order(2)


# Pipeline

def slow_pipeline(spark, docs):
    """Ids that stay, from the operators' own brute force."""
    from test_dedup import groups_of, slow_components
    from shoplens.llm.simhash import fingerprint

    groups = groups_of([(r.doc_id, r.text) for r in docs])
    rows = sorted((r for r in docs if r.doc_id in {keep for keep, _, _ in groups.values()}), key=lambda r: r.doc_id)
    root = slow_components([fingerprint(r.text) for r in rows])
    first = {}
    for k, r in enumerate(root):
        first.setdefault(r, k)
    rows = [rows[k] for k in sorted(first.values())]
    bench = [decontam.words_of(b.text) for b in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    out = []
    for r in rows:
        doc = decontam.words_of(r.text)
        runs = {tuple(doc[k:k + 5]) for k in range(len(doc) - 4)}
        if not any(sum(n for _, _, n in slow_tiles(b, doc, 5)) >= 0.6 * len(b) for b in bench
                   if any(tuple(b[k:k + 5]) in runs for k in range(len(b) - 4))):
            out.append(r.doc_id)
    return out


def test_pipeline(spark, some, monkeypatch):
    monkeypatch.syspath_prepend("tests/llm")
    found = corpus_pipeline.run(spark, SF).collect()
    assert sorted(r.doc_id for r in found) == slow_pipeline(spark, some[1])
    texts = {r.doc_id: r.text for r in some[1]}
    import hashlib
    assert all(r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest() for r in found)


@pytest.mark.parametrize("which", ["odd", "none"])
def test_stages_on_odd_and_empty_tables(spark, request, which):
    docs = request.getfixturevalue(which)
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.written(stage(spark, docs, SF), "test-stage")
        if name != "tokens":
            assert out.columns == docs.columns
        assert out.count() <= before
        docs, before = out, out.count()
    if which == "odd":  # rows with letters, one of each group; the repeated text once
        assert sorted(str(r.doc_id) for r in docs.collect()) == ["1", "11", "12", "12", "9"]


def test_rolling_hashes_are_those_of_the_runs():
    rng = np.random.default_rng(0)
    ids = rng.integers(0, 9, 60).astype(np.uint64)
    for length in (1, 2, 5, 59, 60, 61):
        want = []
        for k in range(len(ids) - length + 1):
            h = 0
            for x in ids[k:k + length].tolist():
                h = (h * int(decontam._BASE) + x) % 2**64
            want.append(h)
        assert decontam.hashes(ids, length).tolist() == want


@pytest.mark.parametrize("item_words, doc_words", [(50, 1_000_000), (20_000, 30_000)])
def test_one_word_over_and_over(item_words, doc_words):
    """The work grows with the words of item and document, not with their pairs."""
    seeds = decontam.Seeds([(7, ["la"] * item_words)], 5, 0.6)
    began = time.process_time()
    (hit,) = seeds.find("la " * doc_words)
    assert hit[:4] == (7, 1.0, item_words, item_words)
    assert time.process_time() - began < 20

"""Collocations: phrases whose words stand together more often than their parts explain,
counted with stripes.

A stripe is a prefix phrase with an associative counter of the words that follow it. Level
m has the stripes of prefixes of m - 1 words. Every block of text makes its stripes, one
counter for each of its prefixes; stripes of equal prefixes are merged element by element.
From the merged stripes alone come the extensions (elements counted at least ``least``
times: the phrases of m words), the prefix totals (the sum over a stripe, which holds one
element for all that is no extension: rare words and the end of a piece) and the maxima that
tell whether an extension occurs as often as the phrase itself (over a prefix's stripe for
words added on the right, over the elements a phrase ends on for words added on the left).

A phrase can only be frequent if the phrases without its first and its last word are, so an
element names the phrase without the first word, and a block only makes elements of two
frequent phrases that overlap. Names are exact: numbers dealt out by the part that merged
the phrase, sent back to the blocks that have it; no phrase is known by a hash. The words
themselves are the stripe of the empty prefix in each language, cut into segments by word.

Stripes are cut into segments: parts are a grid over prefixes and next words, so a prefix
that the whole vocabulary follows is spread over many parts. A block sends one number for an
element however often it stands there, so a phrase in a third of all documents is one number
a block.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, written
from .ppm import pack, unpack
from .word_blocks import cut_into_blocks, numbered, one_row, pack_words, rows_of, unpack_words, word_array

LONGEST = 5
LEAST = 100
TOP = 2000
#: A phrase goes if one that holds it occurs in this many of a hundred of its places.
HELD = 100
#: Bytes of text that are numbered together, and elements of one part.
BLOCK_BYTES = 16 << 20
PART_KEYS = 1 << 21
#: Words of one part.
PART_WORDS = 1 << 18
#: Partial rankings of a language.
SALTS = 64

_ENDS = r"[.,;:!?\x0A-\x0D]+"
_END = b"."  # no word holds it


# ----- words -----------------------------------------------------------------------------------

def pack_texts(docs: DataFrame, text_col: str, lang_col: str, block_bytes: int) -> DataFrame:
    """Blocks of one language each: the words' numbers from 1 on, 0 where a piece ends."""
    types = {"lang": pa.string(), "numbers": pa.binary(), "letters": pa.binary(), "lengths": pa.binary(),
             "n_words": pa.int64(), "n_distinct": pa.int64()}

    def block(rows: pa.Table):
        texts = pc.replace_substring_regex(pc.ascii_lower(rows["text"].combine_chunks()), pattern=_ENDS, replacement=" . ")
        texts = pc.binary_join_element_wise(texts, ".", " ")
        langs = rows["lang"].combine_chunks()
        for lang in langs.unique().to_pylist():
            _, numbers, words = numbered(texts.filter(pc.equal(langs, lang)))
            end = words.index(_END)
            new = np.arange(1, len(words) + 1)
            new[end], new[end + 1:] = 0, new[end + 1:] - 1
            letters, lengths = pack_words(words[:end] + words[end + 1:])
            numbers = new[numbers]
            yield one_row(types, lang=lang, numbers=pack(numbers.astype(np.uint32)), letters=letters, lengths=lengths,
                          n_words=int((numbers > 0).sum()), n_distinct=len(words) - 1)

    def run(batches):
        return cut_into_blocks(batches, "text", block_bytes, block)

    rows = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "lang string, numbers binary, letters binary, lengths binary, n_words bigint, n_distinct bigint").withColumn(
        "block", F.monotonically_increasing_id())


def _word_parts(words: list[bytes], parts: int) -> np.ndarray:
    """The part that merges a word (its segment of the empty prefix's stripe)."""
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    return ((h >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def dealt_words(blocks: DataFrame, parts: int) -> DataFrame:
    """(part, block, lang, letters, lengths, counts): a block's words and how often they
    occur, by part in the order of their numbers."""
    types = {"part": pa.int64(), "block": pa.int64(), "lang": pa.string(), "letters": pa.binary(),
             "lengths": pa.binary(), "counts": pa.binary()}

    def run(batches):
        for row in rows_of(batches):
            words = unpack_words(row["letters"], row["lengths"])
            n = np.bincount(unpack(row["numbers"], "<u4").astype(np.int64), minlength=len(words) + 1)[1:]
            part = _word_parts(words, parts)
            for p in np.unique(part).tolist():
                mine = np.flatnonzero(part == p)
                letters, lengths = pack_words([words[k] for k in mine.tolist()])
                yield one_row(types, part=p, block=row["block"], lang=row["lang"], letters=letters, lengths=lengths,
                              counts=pack(n[mine].astype(np.uint64)))

    return blocks.select("block", "lang", "numbers", "letters", "lengths").mapInArrow(
        run, "part bigint, block bigint, lang string, letters binary, lengths binary, counts binary")


def merged_words(dealt: DataFrame, least: int) -> DataFrame:
    """Counts added up word by word. A row for each part (block null): its frequent words
    (lang, word, times), the k-th named part << 32 | k, k from 1. And a row for each block
    that sent to the part: which of its words are frequent, and their k."""
    schema = pa.schema([("part", pa.int64()), ("block", pa.int64()), ("n", pa.int64()), ("hits", pa.binary()),
                        ("ranks", pa.binary()), ("langs", pa.list_(pa.string())), ("words", pa.list_(pa.string())),
                        ("times", pa.list_(pa.int64()))])

    def merge(table: pa.Table) -> pa.Table:
        by_lang, part = {}, table["part"][0].as_py()
        for row in table.to_pylist():
            by_lang.setdefault(row["lang"], []).append(row)
        langs, found, times, blocks, hits, ranks, sizes = [], [], [], [], [], [], []
        for lang, rows in sorted(by_lang.items()):
            words = pa.concat_arrays([word_array(r["letters"], r["lengths"]) for r in rows]).dictionary_encode()
            which = words.indices.to_numpy()
            counts = [unpack(r["counts"], "<u8").astype(np.int64) for r in rows]
            total = np.zeros(len(words.dictionary), np.int64)
            np.add.at(total, which, np.concatenate(counts))
            frequent = total >= least
            rank = np.where(frequent, len(found) + np.cumsum(frequent), 0)
            found += words.dictionary.filter(pa.array(frequent)).cast(pa.string()).to_pylist()
            langs += [lang] * int(frequent.sum())
            times += total[frequent].tolist()
            end = 0
            for r, c in zip(rows, counts):
                mine = rank[which[end:end + len(c)]]
                end += len(c)
                blocks.append(r["block"])
                sizes.append(len(c))
                hits.append(np.packbits(mine > 0).tobytes())
                ranks.append(pack(mine[mine > 0].astype(np.uint32)))
        n = len(blocks)
        return pa.table([pa.array([part] * (n + 1)), pa.array([*blocks, None], pa.int64()), pa.array([*sizes, len(found)]),
                         pa.array([*hits, None], pa.binary()), pa.array([*ranks, None], pa.binary()),
                         pa.array([None] * n + [langs], pa.list_(pa.string())),
                         pa.array([None] * n + [found], pa.list_(pa.string())),
                         pa.array([None] * n + [times], pa.list_(pa.int64()))], schema=schema)

    return dealt.groupBy("part").applyInArrow(
        merge, "part bigint, block bigint, n bigint, hits binary, ranks binary, langs array<string>, "
               "words array<string>, times array<bigint>")


def _answers(merged: DataFrame) -> DataFrame:
    """What the parts told each block, in the order it had sent to them."""
    return (merged.where("block IS NOT NULL").groupBy(F.col("block").alias("of"))
            .agg(F.sort_array(F.collect_list(F.struct("part", "n", "hits", "ranks"))).alias("answers")))


def _names(answers: list[dict], n: int) -> np.ndarray:
    """Names of what a block had sent, 0 for what isn't frequent."""
    name, begin = np.zeros(n, np.uint64), 0
    for a in answers:
        hit = np.unpackbits(np.frombuffer(a["hits"], np.uint8), count=a["n"]).astype(bool)
        name[begin:begin + a["n"]][hit] = unpack(a["ranks"], "<u4").astype(np.uint64) | np.uint64(a["part"] << 32)
        begin += a["n"]
    return name


_STATE = {"block": pa.int64(), "places": pa.binary(), "names": pa.binary(), "n_at": pa.int64()}
_STATE_SQL = "block bigint, places binary, names binary, n_at bigint"


def _state(block: int, places: np.ndarray, names: np.ndarray) -> pa.RecordBatch:
    """What stands at each place of a block: 0, or the number from 1 on of a name."""
    return one_row(_STATE, block=block, places=pack(places.astype(np.uint32)), names=pack(names.astype(np.uint64)),
                   n_at=int((places > 0).sum()))


def named_words(blocks: DataFrame, merged: DataFrame, parts: int) -> DataFrame:
    """Where the frequent words stand in the blocks."""
    def run(batches):
        for row in rows_of(batches):
            part = _word_parts(unpack_words(row["letters"], row["lengths"]), parts)
            name = np.zeros(len(part) + 1, np.uint64)
            name[1 + np.argsort(part, kind="stable")] = _names(row["answers"], len(part))
            number = np.where(name > 0, np.cumsum(name > 0), 0)
            yield _state(row["block"], number[unpack(row["numbers"], "<u4").astype(np.int64)], name[name > 0])

    return (blocks.select("block", "numbers", "letters", "lengths").join(_answers(merged), F.col("block") == F.col("of"))
            .drop("of").mapInArrow(run, _STATE_SQL))


# ----- stripes ---------------------------------------------------------------------------------

def _spread(names: np.ndarray, over: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (names + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xD6E8FEB86659FD93)
    return ((h >> np.uint64(32)) * np.uint64(over)) >> np.uint64(32)


class Stripes:
    """A block's stripes: elements (prefix, next, count) in the order they are dealt out, and
    which element each place is. The next of whatever is no extension is 0."""

    def __init__(self, row: dict, grid: tuple[int, int]):
        places, names = unpack(row["places"], "<u4").astype(np.int64), unpack(row["names"], "<u8")
        self.length = len(places)
        self.at = np.flatnonzero(places)
        after = np.append(places, 0)[self.at + 1]
        wide = len(names) + 1
        element, which, count = np.unique(places[self.at] * wide + after, return_inverse=True, return_counts=True)
        names = np.concatenate((np.zeros(1, np.uint64), names))
        prefix, follow = names[element // wide], names[element % wide]
        part = (_spread(prefix, grid[0]) * np.uint64(grid[1]) + _spread(follow, grid[1])).astype(np.int64)
        order = np.lexsort((follow, prefix, part))
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        self.which = back[which]
        self.part, self.prefix, self.follow, self.count = part[order], prefix[order], follow[order], count[order]


def dealt_stripes(state: DataFrame, grid: tuple[int, int]) -> DataFrame:
    """(part, block, prefixes, sizes, follows, counts): segments of a block's stripes."""
    types = {"part": pa.int64(), "block": pa.int64(), "prefixes": pa.binary(), "sizes": pa.binary(),
             "follows": pa.binary(), "counts": pa.binary()}

    def run(batches):
        for row in rows_of(batches):
            s = Stripes(row, grid)
            cut = (np.flatnonzero(np.diff(s.part)) + 1).tolist()
            for a, b in zip([0, *cut], [*cut, len(s.part)]):
                if b > a:
                    prefix = s.prefix[a:b]
                    first = np.flatnonzero(np.concatenate(([True], prefix[1:] != prefix[:-1])))
                    yield one_row(types, part=int(s.part[a]), block=row["block"], prefixes=pack(prefix[first], True),
                                  sizes=pack(np.diff(np.append(first, b - a)).astype(np.uint32)),
                                  follows=pack(s.follow[a:b]), counts=pack(s.count[a:b].astype(np.uint64)))

    return state.mapInArrow(run, "part bigint, block bigint, prefixes binary, sizes binary, follows binary, counts binary")


_MERGED = ("part bigint, block bigint, n bigint, hits binary, ranks binary, heads array<bigint>, tails array<bigint>, "
           "times array<bigint>, prefixes array<bigint>, totals array<bigint>, maxima array<bigint>")


def merged_stripes(dealt: DataFrame, least: int) -> DataFrame:
    """Stripes merged element by element. A row for each part (block null): its extensions
    (heads: names of the prefixes, tails: of the phrases without the first word, times) and
    for each prefix the total and the maximum over extensions of its segment here; the k-th
    extension's name is part << 32 | k, k from 1. And a row for each block that sent to the
    part: which of its elements are extensions, and their k."""
    whole = lambda a: pa.array([a.tolist()], pa.list_(pa.int64()))
    schema = pa.schema([("part", pa.int64()), ("block", pa.int64()), ("n", pa.int64()), ("hits", pa.binary()),
                        ("ranks", pa.binary())] + [(c, pa.list_(pa.int64())) for c in (
                            "heads", "tails", "times", "prefixes", "totals", "maxima")])

    def merge(table: pa.Table) -> pa.Table:
        segments, part = table.to_pylist(), table["part"][0].as_py()
        follows = [unpack(s["follows"], "<u8") for s in segments]
        sizes = [len(f) for f in follows]
        prefix = np.concatenate([np.repeat(unpack(s["prefixes"], "<u8", True), unpack(s["sizes"], "<u4").astype(np.int64))
                                 for s in segments])
        follow, count = np.concatenate(follows), np.concatenate([unpack(s["counts"], "<u8") for s in segments]).astype(np.int64)
        order = np.lexsort((follow, prefix))
        p, f = prefix[order], follow[order]
        new = np.concatenate(([True], (p[1:] != p[:-1]) | (f[1:] != f[:-1])))
        start = np.flatnonzero(new)
        times, p, f = np.add.reduceat(count[order], start), p[start], f[start]
        extension = (f > 0) & (times >= least)
        rank = np.where(extension, np.cumsum(extension), 0)
        mine = np.empty(len(order), np.int64)
        mine[order] = rank[np.cumsum(new) - 1]
        stripe = np.flatnonzero(np.concatenate(([True], p[1:] != p[:-1])))
        out = [pa.table([pa.array([part]), pa.array([None], pa.int64()), pa.array([int(extension.sum())]),
                         pa.array([None], pa.binary()), pa.array([None], pa.binary()),
                         *(whole(a.astype(np.int64)) for a in (
                             p[extension], f[extension], times[extension], p[stripe],
                             np.add.reduceat(times, stripe), np.maximum.reduceat(np.where(extension, times, 0), stripe)))],
                        schema=schema)]
        ends = np.cumsum(sizes)
        ranks = [mine[e - n:e] for e, n in zip(ends, sizes)]
        none = pa.nulls(len(segments), pa.list_(pa.int64()))
        out.append(pa.table([table["part"].combine_chunks(), table["block"].combine_chunks(), pa.array(sizes, pa.int64()),
                             pa.array([np.packbits(r > 0).tobytes() for r in ranks], pa.binary()),
                             pa.array([pack(r[r > 0].astype(np.uint32)) for r in ranks], pa.binary()), *[none] * 6],
                            schema=schema))
        return pa.concat_tables(out)

    return dealt.groupBy("part").applyInArrow(merge, _MERGED)


def extended(state: DataFrame, merged: DataFrame, grid: tuple[int, int]) -> DataFrame:
    """Where the phrases one word longer stand in the blocks."""
    def run(batches):
        for row in rows_of(batches):
            s = Stripes(row, grid)
            name = _names(row["answers"], len(s.part))
            if name.any():
                number = np.where(name > 0, np.cumsum(name > 0), 0)
                places = np.zeros(s.length, np.int64)
                places[s.at] = number[s.which]
                yield _state(row["block"], places, name[name > 0])

    return state.join(_answers(merged), F.col("block") == F.col("of")).drop("of").mapInArrow(run, _STATE_SQL)


# ----- phrases ---------------------------------------------------------------------------------

def _known(shorter: DataFrame, merged: DataFrame) -> DataFrame:
    """Phrases with what the stripes one word longer tell: the total of their own stripe,
    and the most any extension on the right or left occurs."""
    rows = merged.where("block IS NULL")
    own = (rows.select(F.explode(F.arrays_zip("prefixes", "totals", "maxima")).alias("x"))
           .groupBy(F.col("x.prefixes").alias("name")).agg(F.sum("x.totals").alias("total"), F.max("x.maxima").alias("right")))
    left = (rows.select(F.explode(F.arrays_zip("tails", "times")).alias("x"))
            .groupBy(F.col("x.tails").alias("name")).agg(F.max("x.times").alias("left")))
    return (shorter.join(own, "name").join(left, "name", "left")
            .withColumn("held", F.greatest("right", F.coalesce("left", F.lit(0)))).drop("right", "left"))


def _longer(merged: DataFrame, known: DataFrame) -> DataFrame:
    """The phrases of the merged stripes, from those one word shorter."""
    grams = (merged.where("block IS NULL")
             .select("part", F.posexplode(F.arrays_zip("heads", "tails", "times")).alias("k", "x"))
             .select((F.shiftleft("part", 32) + F.col("k") + 1).alias("name"), F.col("x.heads").alias("head"),
                     F.col("x.tails").alias("tail"), F.col("x.times").alias("a")))
    heads = known.select(F.col("name").alias("head"), "lang", F.col("phrase").alias("head_phrase"),
                         F.concat("firsts", F.array("total")).alias("firsts"))
    tails = known.select(F.col("name").alias("tail"), "last", F.concat("lasts", F.array("total")).alias("lasts"))
    return (grams.join(heads, "head").join(tails, "tail")
            .select("name", "lang", F.concat_ws(" ", "head_phrase", "last").alias("phrase"), "last", "a", "firsts", "lasts"))


def scored(phrases: DataFrame, n_words: DataFrame) -> DataFrame:
    """Lowest score over all cuts, of equal ones the first. Exact: decimals of 38 digits."""
    big = lambda c: c.cast("decimal(19,0)").cast("decimal(38,0)")
    top = big(F.col("a")) * big(F.col("n")) * F.lit(1000).cast("decimal(38,0)")
    df = phrases.join(n_words, "lang").withColumn("above", top.cast("decimal(38,0)"))
    cuts = F.expr("transform(sequence(1, size(firsts)), k -> struct("
                  "above div (cast(firsts[k - 1] as decimal(19,0)) * cast(lasts[size(firsts) - k] as decimal(19,0))) as score, "
                  "k as k, firsts[k - 1] as l, lasts[size(firsts) - k] as r))")
    return df.withColumn("cut", F.array_min(cuts)).select(
        "lang", "phrase", "a", "cut.l", "cut.r", "n", F.col("cut.score").cast("bigint").alias("score"))


def best_of_each(phrases: DataFrame, top: int) -> DataFrame:
    """The first ``top`` of each language. Salted rankings come first, so that no task sorts
    all phrases of a language."""
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    salted = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).orderBy(*order)
    some = phrases.withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= top)
    return (some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint"))
            .where(F.col("rank") <= top)
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))


def phrase_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", longest: int = LONGEST,
                  least: int = LEAST, block_bytes: int = BLOCK_BYTES, part_keys: int = PART_KEYS,
                  part_words: int = PART_WORDS) -> tuple[list[DataFrame], DataFrame]:
    """Frequent phrases of 2 to ``longest`` words, a table for each length: lang, phrase, a
    (occurrences), held (the most that a phrase one word longer occurs; 0 for the longest),
    firsts and lasts (occurrences of the first and of the last 1, 2, ... words). And the
    number of words (lang, n)."""
    ship(docs.sparkSession)
    blocks = written(pack_texts(docs, text_col, lang_col, block_bytes), "phrase-blocks")
    n_words = blocks.groupBy("lang").agg(F.sum("n_words").alias("n"))
    parts = max(1, -(-(blocks.agg(F.sum("n_distinct")).first()[0] or 0) // part_words))
    merged = written(merged_words(dealt_words(blocks, parts), least), "phrase-words")
    none = F.array().cast("array<bigint>")
    phrases = (merged.where("block IS NULL")
               .select("part", F.posexplode(F.arrays_zip("langs", "words", "times")).alias("k", "x"))
               .select((F.shiftleft("part", 32) + F.col("k") + 1).alias("name"), F.col("x.langs").alias("lang"),
                       F.col("x.words").alias("phrase"), F.col("x.words").alias("last"), F.col("x.times").alias("a"),
                       none.alias("firsts"), none.alias("lasts")))
    state, out = written(named_words(blocks, merged, parts), "phrase-places-1"), []
    for m in range(2, longest + 1):
        elements = state.agg(F.sum("n_at")).first()[0]
        if not elements:
            break
        parts = -(-elements // part_keys)
        rows = math.isqrt(parts - 1) + 1
        grid = (rows, -(-parts // rows))
        merged = written(merged_stripes(dealt_stripes(state, grid), least), f"phrase-stripes-{m}")
        known = written(_known(phrases, merged), f"phrases-{m - 1}")
        if m > 2:
            out.append(known)
        phrases = _longer(merged, known)
        if m < longest:
            state = written(extended(state, merged, grid), f"phrase-places-{m}")
    else:
        if longest > 1:
            out.append(phrases.withColumn("held", F.lit(0).cast("bigint")))
    return out, n_words


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", longest: int = LONGEST,
                 least: int = LEAST, top: int = TOP, held: int = HELD, block_bytes: int = BLOCK_BYTES,
                 part_keys: int = PART_KEYS) -> DataFrame:
    """The ``top`` collocations of each language: lang, rank (from 1), phrase, a
    (occurrences), l and r (occurrences of the two parts of its weakest cut), n (words of the
    language), score (floor of 1000 a n / (l r)).

    Texts are lower-cased (A-Z), cut into pieces at ``. , ; : ! ?`` and line ends, and pieces
    into words at blanks and tabs. Candidates are phrases of 2 to ``longest`` words inside
    pieces, overlapping ones too, that occur ``least`` times or more. One goes if a longer
    candidate that holds it occurs in ``held`` of a hundred of its places. Order: score and a
    from the highest, then phrase by its UTF-8 bytes. Rows without a language are of language
    ``und``, null and empty texts have no words, repeated rows count as often as they stand
    there, and an empty table gives no rows.
    """
    tables, n_words = phrase_counts(docs, text_col, lang_col, longest, least, block_bytes, part_keys)
    if not tables:
        return docs.sparkSession.createDataFrame(
            [], "lang string, rank bigint, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint")
    every = tables[0].select("lang", "phrase", "a", "held", "firsts", "lasts")
    for t in tables[1:]:
        every = every.unionByName(t.select(*every.columns))
    stay = every.where(F.lit(100).cast("decimal(38,0)") * F.col("held") < F.lit(held).cast("decimal(38,0)") * F.col("a"))
    return best_of_each(scored(stay, n_words), top)

"""Language-model scoring by prediction by partial matching (PPM).

The model is a trie of byte contexts up to ``order`` bytes long, each with the
counts of the bytes that followed it in the training texts. A byte is coded in
its longest context: if it was seen there n times of T it takes (n - d) / T;
else an escape of d * D / T (D: distinct bytes seen there; d: the discount that
every seen byte gives up) leads to the context one byte shorter, from whose counts all bytes seen in the longer one are excluded
(symbol exclusion), and so on to the empty context and at last to all remaining
bytes alike. Contexts never seen are skipped without cost. The model is
pretrained: a text's code length doesn't depend on the texts beside it.

A text is its words in lower case (A-Z), each followed by a blank, the last by an
end symbol (byte 10, which no word holds); the context before a text is end
symbols.

How it runs. Texts are packed into blocks of bounded size. A block's work is
reduced to its distinct (order + 1)-grams, whose counts hold those of all shorter
contexts. Grams are dealt into parts by the last two bytes of their context, so
that one part has everything that orders of two and more need; the two lowest
orders are a table of at most 65,536 numbers, sent to every task. Parts merge
their counts into their piece of the trie, then return to each block the cost of
each of its distinct grams, and blocks add up costs for their texts. Words are
counted by the same machinery, keyed by their 64-bit hash. So what moves grows
with the input, nothing is sent whole to a task or to the driver, and a text that
a third of all rows repeat is counted where it lies.

A frequent context (". " alone has some 2 % of all grams) makes a part larger than
others. Such a part's blocks are dealt to several numbered tasks: each merges its
blocks' counts first, and the merged counts meet in the part; for the costs each
has a copy of the part's piece of the trie. As many copies are made as blocks' grams
fill tasks of ``task_bytes``, or of the piece's own size where that is larger, so
the copies never hold more than the grams themselves and one piece a part.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, written

ORDER = 5
#: What a seen byte's count gives up to the escape. Texts that repeat each other
#: make a count of one a better witness than in PPM variant D, whose 1/2 it was.
DISCOUNT = 0.2
#: Text bytes of a block: larger blocks share more grams and words. A task holds
#: one block's text, distinct grams and words.
BLOCK_BYTES = 16 << 20
#: Text bytes held as arrays at a time (about 30 bytes for each).
CHUNK_BYTES = 2 << 20
#: Text bytes for each part of the trie.
PART_BYTES = 64 << 20
#: Packed grams of a part that one task takes.
TASK_BYTES = 32 << 20
#: Counts merged at a time.
MERGE_KEYS = 2_000_000

END = b"\n"
_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)


def normal(text: str | None) -> bytes:
    return b" ".join((text or "").encode().lower().split())


def segments(text: bytes, order: int, limit: int):
    """(context, body) pieces of one text of at most ``limit`` bytes, cut behind
    blanks where there are any."""
    body, before, at = text + END, END * order, 0
    while at < len(body):
        end = at + limit
        if end < len(body):
            end = max(body.rfind(b" ", at, end) + 1, 0) or end
            end = end if end > at else at + limit
        piece = body[at:end]
        yield before, piece
        before = (before + piece[-order:])[-order:]
        at = end


def words_in(text: bytes, limit: int):
    """The text's words, as lists of a bounded number of bytes (or one word)."""
    at = 0
    while at < len(text):
        end = text.find(b" ", at + limit)
        end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


def chunks(texts: list[bytes], order: int, limit: int = CHUNK_BYTES):
    """(text numbers, pieces) of neighbouring pieces within the limit together."""
    of, pieces, size = [], [], 0
    for k, t in enumerate(texts):
        for before, body in segments(t, order, limit):
            if pieces and size + len(body) > limit:
                yield of, pieces
                of, pieces, size = [], [], 0
            of.append(k)
            pieces.append((before, body))
            size += len(body)
    if pieces:
        yield of, pieces


def grams(pieces: list[tuple[bytes, bytes]], order: int) -> tuple[np.ndarray, np.ndarray]:
    """The (order + 1)-gram of every byte, as a number, and where pieces start."""
    data = np.frombuffer(b"".join(b for p in pieces for b in p), np.uint8)
    code = np.zeros(len(data) - order, np.uint64)
    for k in range(order + 1):
        code <<= np.uint64(8)
        code |= data[k:k + len(code)]
    length = np.array([len(body) for _, body in pieces], np.int64)
    start = np.cumsum(length) - length  # of each piece among all bodies
    real = np.ones(len(code), bool)
    head = start + np.arange(len(pieces)) * order  # of each piece in data
    for k in range(order):  # grams that end inside a later piece's context
        at = head[1:] - order + k
        real[at] = False
    return code[real], start


def distinct_counts(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and their summed counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts, first)


def gram_counts(texts: list[bytes], train: list[bool], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams of all texts, and how often training texts have them."""
    keys, counts = [], []
    for of, pieces in chunks(texts, order):
        code, start = grams(pieces, order)
        learn = np.repeat(np.array(train, bool)[of], np.diff(np.append(start, len(code))))
        for some, add in ((code[learn], True), (code[~learn], False)):
            some.sort()
            first = np.flatnonzero(np.concatenate(([True], some[1:] != some[:-1]))) if len(some) else np.zeros(0, int)
            keys.append(some[first])
            counts.append(np.diff(np.append(first, len(some))) if add else np.zeros(len(first), np.int64))
    return distinct_counts(np.concatenate(keys), np.concatenate(counts)) if keys else (
        np.zeros(0, np.uint64), np.zeros(0, np.int64))


def word_counts(texts: list[bytes], train: list[bool]) -> tuple[np.ndarray, np.ndarray]:
    """The same for the words, by their hash."""
    total: dict[bytes, int] = {}
    for t, learn in zip(texts, train):
        for words in words_in(t, CHUNK_BYTES):
            for w in words:
                total[w] = total.get(w, 0) + learn
    return distinct_counts(np.fromiter(map(xxhash.xxh64_intdigest, total), np.uint64, len(total)),
                           np.fromiter(total.values(), np.int64, len(total)))


class Finder:
    """Places of known numbers in an array of distinct ones, by hash tables: each
    table holds the numbers that lost their place in the one before."""

    def __init__(self, keys: np.ndarray):
        self.keys, self.tables = keys, []
        left = np.arange(len(keys), dtype=np.int32)
        while len(left):
            bits = max(4, int(len(left) * 3).bit_length())
            table = np.full(1 << bits, -1, np.int32)
            spot = self._spot(keys[left], len(self.tables), bits)
            table[spot] = left
            self.tables.append((bits, table))
            left = left[table[spot] != left]

    @staticmethod
    def _spot(keys, level, bits):
        odd = _ODD[level % 4] + 2 * level
        return ((keys ^ (keys >> np.uint64(29))) * np.uint64(odd & (2**64 - 1))) >> np.uint64(64 - bits)

    def __call__(self, wanted: np.ndarray) -> np.ndarray:
        out = np.full(len(wanted), -1, np.int32)
        left = np.arange(len(wanted), dtype=np.int64)
        for level, (bits, table) in enumerate(self.tables):
            mine = wanted[left] if level else wanted
            at = table[self._spot(mine, level, bits)]
            hit = (at >= 0) & (self.keys[at] == mine)
            out[left[hit]] = at[hit]
            left = left[~hit]
            if not len(left):
                break
        return out


def gram_part(keys: np.ndarray, parts: int) -> np.ndarray:
    """The part a gram belongs to: by the last two bytes of its context."""
    mixed = ((keys >> np.uint64(8)) & np.uint64(0xFFFF)) * np.uint64(40503) & np.uint64(0xFFFF)
    return (mixed * np.uint64(parts)) >> np.uint64(16)


def word_part(keys: np.ndarray, parts: int) -> np.ndarray:
    return ((keys >> np.uint64(48)) * np.uint64(parts)) >> np.uint64(16)


PART_OF = {"g": gram_part, "w": word_part}


def pack(a: np.ndarray, sorted_keys: bool = False) -> bytes:
    """Numbers as compressed bytes: differences if sorted, byte planes together."""
    if sorted_keys and len(a):
        a = np.concatenate((a[:1], np.diff(a)))
    planes = np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes()
    return len(planes).to_bytes(8, "little") + pa.compress(planes, "zstd", asbytes=True)


def unpack(data: bytes, kind, sorted_keys: bool = False) -> np.ndarray:
    size, width = int.from_bytes(data[:8], "little"), np.dtype(kind).itemsize
    planes = pa.decompress(data[8:], size, "zstd", asbytes=True) if size else b""
    a = np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(width, -1).T).view(kind).reshape(-1)
    return np.cumsum(a, dtype=kind) if sorted_keys else a


class Trie:
    """The contexts of one part, order by order: for each context the occurrences
    of bytes in it (total), the distinct ones (kinds), and what those make up in
    the context one byte shorter (known). Orders 0 and 1 come from ``low``, the
    counts of all byte pairs."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, low: np.ndarray, order: int):
        self.order = order
        seen = np.flatnonzero(counts)
        keys, counts = keys[seen], counts[seen]
        pair = np.flatnonzero(low)
        single = low.reshape(256, 256).sum(axis=0)
        self.edges = {0: (np.flatnonzero(single).astype(np.uint64), single[single > 0])}
        if order >= 1:
            self.edges[1] = (pair.astype(np.uint64), low[pair])
        for j in range(order, 1, -1):
            self.edges[j] = (keys, counts)
            keys, counts = distinct_counts(keys & np.uint64((1 << 8 * j) - 1), counts)
        self.nodes = {}
        for j in range(order + 1):
            keys, counts = self.edges[j]
            context = keys >> np.uint64(8)
            first = np.flatnonzero(np.concatenate(([True], context[1:] != context[:-1]))) if len(keys) else \
                np.zeros(0, np.int64)
            total = np.add.reduceat(counts, first) if len(first) else np.zeros(0, np.int64)
            kinds = np.diff(np.append(first, len(keys)))
            known = np.zeros(len(first), np.int64)
            if j and len(first):
                up, up_counts = self.edges[j - 1]
                at = np.searchsorted(up, keys & np.uint64((1 << 8 * j) - 1))
                known = np.add.reduceat(up_counts[at], first)
            self.nodes[j] = (context[first], total, kinds, known)

    def cost(self, keys: np.ndarray, discount: float = DISCOUNT) -> np.ndarray:
        """log10 of the probability of each gram's last byte behind the others."""
        out, open_ = np.zeros(len(keys)), np.ones(len(keys), bool)
        out_total, out_kinds = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        for j in range(self.order, -1, -1):
            mine = keys & np.uint64((1 << 8 * (j + 1)) - 1)
            at, hit = _find(self.edges[j][0], mine)
            contexts, total, kinds, known = self.nodes[j]
            node, there = _find(contexts, mine >> np.uint64(8))
            if not len(contexts):
                continue
            left, distinct = total[node] - out_total, kinds[node] - out_kinds
            coded = open_ & there & hit
            out[coded] += np.log10((self.edges[j][1][at[coded]] - discount) / left[coded])
            passed = open_ & there & ~hit & (left > 0)
            out[passed] += np.log10(discount * distinct[passed] / left[passed])
            open_ &= ~coded
            out_total = np.where(there & open_, known[node], 0)
            out_kinds = np.where(there & open_, kinds[node], 0)
        out[open_] -= np.log10(256 - out_kinds[open_])
        return out


def _find(sorted_keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.searchsorted(sorted_keys, wanted)
    if not len(sorted_keys):
        return at, np.zeros(len(wanted), bool)
    at = np.minimum(at, len(sorted_keys) - 1)
    return at, sorted_keys[at] == wanted


def pack_blocks(docs: DataFrame, block_bytes: int) -> DataFrame:
    """Rows (id, train, text) packed into rows of about ``block_bytes`` of text."""
    def run(batches):
        ids, train, texts, size = [], [], [], 0

        def block():
            joined = b"".join(texts)
            return pa.RecordBatch.from_arrays(
                [pa.array([ids], pa.list_(pa.int64())), pa.array([train], pa.list_(pa.bool_())),
                 pa.array([list(map(len, texts))], pa.list_(pa.int64())), pa.array([len(joined)], pa.int64()),
                 pa.array([pa.compress(joined, "zstd", asbytes=True)], pa.binary())],
                names=["ids", "train", "lengths", "n_bytes", "data"])

        for batch in batches:
            for i, learn, text in zip(*(batch.column(k) for k in range(3))):
                t = normal(text.as_py())
                if ids and size + len(t) > block_bytes:
                    yield block()
                    ids, train, texts, size = [], [], [], 0
                ids.append(i.as_py())
                train.append(learn.as_py())
                texts.append(t)
                size += len(t) + 1
        if ids:
            yield block()

    schema = "ids array<bigint>, train array<boolean>, lengths array<bigint>, n_bytes bigint, data binary"
    return docs.select("id", "train", "text").mapInArrow(run, schema).withColumn(
        "block", F.monotonically_increasing_id())


def _texts(lengths, n_bytes: int, data: bytes) -> list[bytes]:
    joined = pa.decompress(data, n_bytes, "zstd", asbytes=True) if n_bytes else b""
    ends = np.cumsum(lengths, dtype=np.int64).tolist()
    return [joined[e - n:e] for e, n in zip(ends, lengths)]


def _rows(batches):
    for batch in batches:
        names = batch.schema.names
        for k in range(batch.num_rows):
            yield {n: batch.column(i)[k].as_py() for i, n in enumerate(names)}


def _batch(types: dict, **values):
    return pa.RecordBatch.from_arrays([pa.array([values[n]], t) for n, t in types.items()], names=list(types))


_COUNTED = {"block": pa.int64(), "kind": pa.string(), "part": pa.int32(), "keys": pa.binary(), "counts": pa.binary(),
            "size": pa.int64()}
_COUNTED_SQL = "block bigint, kind string, part int, keys binary, counts binary, size bigint"


def count_blocks(blocks: DataFrame, parts: int, order: int) -> DataFrame:
    """A row for each block, kind (g: grams, w: words) and part."""
    def run(batches):
        for row in _rows(batches):
            texts = _texts(row["lengths"], row["n_bytes"], row["data"])
            for kind, (keys, counts) in (("g", gram_counts(texts, row["train"], order)),
                                         ("w", word_counts(texts, row["train"]))):
                part = PART_OF[kind](keys, parts)
                for p in np.unique(part).tolist():
                    mine = part == p
                    k, c = pack(keys[mine], True), pack(counts[mine].astype(np.uint32))
                    yield _batch(_COUNTED, block=row["block"], kind=kind, part=p, keys=k, counts=c,
                                 size=len(k) + len(c))

    return blocks.select("block", "train", "lengths", "n_bytes", "data").mapInArrow(run, _COUNTED_SQL)


def numbered(blocks: DataFrame) -> DataFrame:
    """The blocks numbered from 0 without gaps: the upper bits of the id of a block
    are those of the task that wrote it, so only a count for each task is added up
    and sent (16 bytes for each split of the input that was read: 13 MB for 100 TB
    in splits of 128 MB); the blocks stay where they are."""
    task = F.shiftright("block", 33)
    counts = blocks.groupBy(task.alias("task")).agg(F.count("*").alias("n"))
    before = counts.select("task", (F.sum("n").over(Window.orderBy("task")) - F.col("n")).alias("before"))
    return blocks.withColumn("task", task).join(F.broadcast(before), "task").withColumn(
        "block", F.col("before") + F.col("block").bitwiseAND((1 << 33) - 1)).drop("task", "before")


def _dealt(df: DataFrame, tasks: int, to: str, *order: str) -> DataFrame:
    """Rows sorted in task ``to``: one group in each, where a hash would put several."""
    return df.repartitionById(tasks, F.col(to).cast("int")).sortWithinPartitions(to, *order)


def salts(counted: DataFrame, task_bytes: int, model: DataFrame | None = None) -> DataFrame:
    """How many tasks share each kind and part, and the number of the first of
    them: a row each, 65,536 at most."""
    sizes = counted.groupBy("kind", "part").agg(F.sum("size").alias("all"))
    room = F.lit(task_bytes)
    if model is not None:
        sizes = sizes.join(model.select("kind", "part", "size"), ["kind", "part"])
        room = F.greatest(room, "size")
    shares = sizes.select("kind", "part", F.ceil(F.col("all") / room).cast("int").alias("salts"))
    return shares.withColumn("first", F.sum("salts").over(Window.orderBy("kind", "part")) - F.col("salts"))


def _salted(counted: DataFrame, shares: DataFrame) -> DataFrame:
    return counted.join(F.broadcast(shares), ["kind", "part"]).withColumn(
        "task", F.col("first") + F.pmod("block", "salts")).drop("salts", "first")


def _groups(shares: DataFrame) -> int:
    return max(1, shares.agg(F.coalesce(F.sum("salts"), F.lit(0))).first()[0])


def merge_parts(counted: DataFrame, tasks: int, width: int) -> DataFrame:
    """One row per task, which is a kind and part or a share of its blocks: its
    keys with training counts (``width`` bytes each as they come), how many there
    are (kinds), their sum (total), and for grams the counts of byte pairs."""
    schema = ("kind string, part int, keys binary, counts binary, kinds bigint, total bigint, "
              "pairs array<bigint>, pair_counts array<bigint>, size bigint")
    out = {"kind": pa.string(), "part": pa.int32(), "keys": pa.binary(), "counts": pa.binary(), "kinds": pa.int64(),
           "total": pa.int64(), "pairs": pa.list_(pa.int64()), "pair_counts": pa.list_(pa.int64()), "size": pa.int64()}

    def run(batches):
        now, keys, counts, size = None, [], [], 0

        def merged():
            k, c = distinct_counts(np.concatenate(keys), np.concatenate(counts))
            return [k], [c]

        def done():
            (k,), (c,) = merged()
            pairs = np.bincount((k & np.uint64(0xFFFF)).astype(np.int64), c, 65536) if now[0] == "g" else np.zeros(0)
            seen = np.flatnonzero(pairs)
            keys_, counts_ = pack(k, True), pack(c)
            return _batch(out, kind=now[0], part=now[1], keys=keys_, counts=counts_, kinds=len(k),
                          total=int(c.sum()), pairs=seen, pair_counts=pairs[seen].astype(np.int64),
                          size=len(keys_) + len(counts_))

        for row in _rows(batches):
            if (row["kind"], row["part"]) != now:
                if now:
                    yield done()
                now, keys, counts, size = (row["kind"], row["part"]), [], [], 0
            k, c = unpack(row["keys"], "<u8", True), unpack(row["counts"], f"<u{width}").astype(np.int64)
            seen = c > 0
            keys.append(k[seen])
            counts.append(c[seen])
            size += len(keys[-1])
            if size > MERGE_KEYS:
                keys, counts = merged()
                size = 0
        if now:
            yield done()

    return _dealt(counted.select("task", "kind", "part", "keys", "counts"), tasks, "task").mapInArrow(run, schema)


def cost_parts(counted: DataFrame, model: DataFrame, low: np.ndarray, order: int, discount: float,
               task_bytes: int) -> DataFrame:
    """For each block, kind and part: the costs of its grams, the counts of its
    words, in the order of its keys."""
    spark = counted.sparkSession
    sent = spark.sparkContext.broadcast(low)
    out = {"block": pa.int64(), "kind": pa.string(), "part": pa.int32(), "costs": pa.binary()}

    def run(batches):
        now, trie, keys, counts = None, None, None, None
        for row in _rows(batches):
            if (row["kind"], row["part"]) != now:
                now = (row["kind"], row["part"])
                keys, counts = unpack(row["keys"], "<u8", True), unpack(row["counts"], "<i8")  # the model's row
                trie = Trie(keys, counts, sent.value, order) if now[0] == "g" else None
                continue
            wanted = unpack(row["keys"], "<u8", True)
            if trie:
                costs = trie.cost(wanted, discount)
            else:
                at, hit = _find(keys, wanted)
                costs = np.zeros(len(wanted), np.int64)
                costs[hit] = counts[at[hit]]
            yield _batch(out, block=row["block"], kind=now[0], part=now[1],
                         costs=pack(costs.astype(np.float32) if trie else costs))

    shares = salts(counted, task_bytes, model)
    copies = model.join(F.broadcast(shares), ["kind", "part"]).withColumn(
        "task", F.explode(F.sequence("first", F.col("first") + F.col("salts") - 1)))
    both = copies.select(F.lit(-1).cast("bigint").alias("block"), "kind", "part", "task", "keys", "counts").unionByName(
        _salted(counted.select("block", "kind", "part", "keys"), shares).withColumn(
            "counts", F.lit(None).cast("binary")))
    return _dealt(both, _groups(shares), "task", "block").mapInArrow(
        run, "block bigint, kind string, part int, costs binary")


def score_blocks(blocks: DataFrame, costs: DataFrame, parts: int, order: int, train_docs: int, train_words: int,
                 known_words: int, tasks: int) -> DataFrame:
    n_all = train_words + train_docs
    n_kinds = known_words + (train_docs > 0)
    scale = math.log10(n_all + 0.1 * (n_kinds + 1))
    schema = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
              "base_score double, score double")
    names = [c.split()[0] for c in schema.split(", ")]

    def finish(row, got):
        texts = _texts(row["lengths"], row["n_bytes"], row["data"])

        def in_order(kind, keys, dtype):
            out, part = np.zeros(len(keys), dtype), PART_OF[kind](keys, parts)
            for p, data in got[kind].items():
                out[part == p] = unpack(data, dtype)
            return out

        score = np.zeros(len(texts))
        keys, _ = gram_counts(texts, [False] * len(texts), order)
        cost, place = in_order("g", keys, "<f4"), Finder(keys)
        for of, pieces in chunks(texts, order):
            code, start = grams(pieces, order)
            np.add.at(score, of, np.add.reduceat(cost[place(code)].astype(np.float64), start))
        total: dict[bytes, int] = {}
        for t in texts:
            for words in words_in(t, CHUNK_BYTES):
                total.update(dict.fromkeys(words, 0))
        hashed = np.fromiter(map(xxhash.xxh64_intdigest, total), np.uint64, len(total))
        keys = np.unique(hashed)
        seen = in_order("w", keys, "<i8")[np.searchsorted(keys, hashed)]
        total = dict(zip(total, range(len(seen))))
        value = np.log10(seen + 0.1) - scale
        tokens, known, base = [], [], []
        for t in texts:
            n, k, b = 1, int(train_docs > 0), math.log10(train_docs + 0.1) - scale
            for words in words_in(t, CHUNK_BYTES):
                at = np.fromiter(map(total.__getitem__, words), np.int64, len(words))
                n, k, b = n + len(words), k + int((seen[at] > 0).sum()), b + float(value[at].sum())
            tokens.append(n)
            known.append(k)
            base.append(b)
        return pa.RecordBatch.from_arrays(
            [pa.array(row["ids"], pa.int64()), pa.array([not t for t in row["train"]], pa.bool_()),
             pa.array(tokens, pa.int64()), pa.array(known, pa.int64()), pa.array([n_all] * len(texts), pa.int64()),
             pa.array(base, pa.float64()), pa.array(score)], names=names)

    def run(batches):
        block, got = None, {}
        for row in _rows(batches):
            if row["kind"] == "b":
                if block:
                    yield finish(block, got)
                block, got = row, {"g": {}, "w": {}}
            else:
                got[row["kind"]][row["part"]] = row["costs"]
        if block:
            yield finish(block, got)

    everything = blocks.withColumns({"kind": F.lit("b"), "part": F.lit(-1), "costs": F.lit(None).cast("binary")})
    everything = everything.unionByName(costs, allowMissingColumns=True)
    return _dealt(everything, tasks, "block", "kind", "part").mapInArrow(run, schema)


def ppm_score(docs: DataFrame, train_col: str, text_col: str = "text", id_col: str = "doc_id", order: int = ORDER,
              block_bytes: int = BLOCK_BYTES, part_bytes: int = PART_BYTES, task_bytes: int = TASK_BYTES,
              discount: float = DISCOUNT) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out (not ``train_col``), n_tokens,
    n_known, train_tokens, base_score, score (log10 probability of the text).

    Tokens are words and one end; base_score adds up log10((c + 0.1) / (N + 0.1 *
    (V + 1))) over them, c a token's training count, N all, V distinct ones. Null
    and blank texts are an end alone. Rows whose ``train_col`` is null or false
    are scored only; without any training row every byte has probability 1/256.
    Costs are added in single precision per byte and in double per text.
    """
    if not 1 <= order <= 7:
        raise ValueError("order must be 1 to 7")
    ship(docs.sparkSession)
    src = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"),
                      F.coalesce(F.col(f"`{train_col}`"), F.lit(False)).alias("train"),
                      F.col(f"`{text_col}`").cast("string").alias("text"))
    blocks = numbered(written(pack_blocks(src, block_bytes), "ppm-blocks"))
    n_blocks, n_bytes, train_docs = blocks.agg(
        F.count("*"), F.coalesce(F.sum("n_bytes"), F.lit(0)),
        F.coalesce(F.sum(F.size(F.filter("train", lambda t: t))), F.lit(0))).first()
    parts = int(min(max(4, -(-n_bytes // part_bytes)), 32768))
    counted = written(count_blocks(blocks, parts, order), "ppm-counts")
    shares = salts(counted, task_bytes)
    merged = merge_parts(_salted(counted, shares), _groups(shares), 4)
    whole = F.col("part") + F.when(F.col("kind") == "w", parts).otherwise(0)
    model = written(merge_parts(merged.withColumn("task", whole), 2 * parts, 8), "ppm-model")
    low = np.zeros(65536, np.int64)
    pairs = (model.where("kind = 'g'").select(F.explode(F.arrays_zip("pairs", "pair_counts")).alias("p"))
             .groupBy("p.pairs").agg(F.sum("p.pair_counts").alias("n")))  # at most 65,536 rows
    for pair, n in pairs.collect():
        low[pair] = n
    known, total = model.where("kind = 'w'").agg(
        F.coalesce(F.sum("kinds"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0))).first()
    costs = cost_parts(counted, model, low, order, discount, task_bytes)
    return score_blocks(blocks, costs, parts, order, train_docs, total, known, max(1, n_blocks))

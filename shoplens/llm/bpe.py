"""Byte-level BPE encoding and decoding by prefix-sharing trie traversal.

The distinct pre-tokens ("words") of a block of texts are put into a trie and
the trie is walked depth first. The state of a node is the *last token* of the
BPE encoding of the bytes on the path to it. BPE has the property that an
encoding is right exactly when every two neighbouring tokens are, so the state
at depth ``i`` is the one token ``t`` that ends there and fits behind the state
at depth ``i - len(t)``. A prefix shared by many words is solved once, and a
word's ids are read by following the states back from its end.

The trie is kept in its sorted form: words in byte order, where the common
prefix of neighbours is the path they share. The walk's stack holds one path.

Empty and null texts give no ids. Texts are encoded whole; the memory used is a
block's distinct words plus a word cache of bounded size.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
import os
import re
import unicodedata
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

#: Texts whose characters all lie below this take the compiled pattern; others
#: are split by the tokenizers library, whose Unicode tables are newer than re's.
LATIN_END = 0x250


def latin_pattern() -> str:
    """The byte-level pre-tokenizer's pattern for characters below LATIN_END:
    clitics, then runs of letters, numbers or others with an optional blank
    before, then white space (its last blank left to a word that follows)."""
    def chars(*kinds: str) -> str:
        return "".join(f"\\u{c:04x}" for c in range(LATIN_END) if unicodedata.category(chr(c)).startswith(kinds))

    letter, number = chars("L"), chars("N")
    space = chars("Z") + "\\t-\\r\\x85"
    return (rf"'(?:[stmd]|re|ve|ll)| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+"
            rf"|[{space}]+(?![^{space}])|[{space}]+")


#: Words a worker keeps encoded; beyond it the cache starts anew.
CACHE_WORDS = 250_000
#: Pairs of tokens whose fit a worker keeps; beyond it they start anew.
CACHE_PAIRS = 300_000
#: Longer words are encoded but not kept.
CACHE_WORD_BYTES = 64
#: Characters of the texts encoded together; a longer text stands alone.
BLOCK_CHARS = 1_000_000


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabularies:
    itself where printable, else the letters from U+0100 on in byte order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


class TrieEncoder:
    """Encodes and decodes with one byte-level BPE vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, letters = spec["model"]["vocab"], byte_letters()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.token: list[bytes] = [b""] * size
        for text, i in vocab.items():
            if text not in self.special:
                self.token[i] = bytes(letters[c] for c in text)
        self.id = {b: i for i, b in enumerate(self.token) if b}
        for text, i in self.special.items():
            self.token[i] = text.encode()
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merge[vocab[a], vocab[b]] = (rank, vocab[a + b])
        #: Every ending of a token, with the token it is itself, else -1.
        self.tails = {b[k:]: -1 for b in self.id for k in range(len(b))} | self.id
        self.latin = re.compile(latin_pattern())
        self.other = re.compile(f"[^\\x00-{chr(LATIN_END - 1)}]")
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.made = {t: (rank, a, b) for (a, b), (rank, t) in self.merge.items()}
        self.right: dict[int, list[tuple[int, int]]] = {}
        self.left: dict[int, list[tuple[int, int]]] = {}
        self.whole: dict[int, bool] = {}
        self.cache: dict[str, bytes] = {}
        self.fits: dict[tuple[int, int], bool] = {}
        self.le = [i.to_bytes(4, "little") for i in range(size)]

    def merged(self, data: bytes) -> list[int]:
        """Plain BPE by rank, for the few bytes of one or two tokens."""
        ids = [self.id[data[k:k + 1]] for k in range(len(data))]
        while len(ids) > 1:
            rank, at = min((self.merge.get(p, (1 << 30, 0))[0], k) for k, p in enumerate(zip(ids, ids[1:])))
            if rank == 1 << 30:
                break
            ids[at:at + 2] = [self.merge[ids[at], ids[at + 1]][1]]
        return ids

    def edge(self, t: int, side: int) -> list[tuple[int, int]]:
        """How the outermost piece of ``t`` on one side grows while its bytes are
        merged: (piece, rank of the merge that takes it up; never: 1 << 30)."""
        out, taken = [], 1 << 30
        while True:
            out.append((t, taken))
            if t not in self.made:
                return out[::-1]
            taken, t = self.made[t][0], self.made[t][side]

    def fit(self, a: int, b: int) -> bool:
        """Whether token ``b`` may follow ``a`` (-1: the word's start): it is the
        encoding of its own bytes, and no merge crosses the border between them
        before the pieces there are taken up on their own sides."""
        if b not in self.whole:
            self.whole[b] = self.merged(self.token[b]) == [b]
            self.left[b] = self.edge(b, 1)
            self.right[b] = self.edge(b, 2)
        return self.whole[b] and (a < 0 or self.apart(self.right[a], self.left[b]))

    def apart(self, right: list[tuple[int, int]], left: list[tuple[int, int]]) -> bool:
        i = j = 0
        while True:
            (x, x_taken), (y, y_taken) = right[i], left[j]
            rank = self.merge.get((x, y), (1 << 30, 0))[0]
            if rank < x_taken and rank <= y_taken and rank < 1 << 30:
                return False  # of equal ranks the leftmost pair merges first
            if x_taken == y_taken == 1 << 30:
                return True
            if x_taken <= y_taken:
                i += 1
            else:
                j += 1

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """The ids (little-endian 32 bits) of each word, by one depth-first walk."""
        out: list[bytes] = [b""] * len(words)
        last: list[int] = [-1]  # last[i]: last token of the path's first i bytes
        path = b""
        if len(self.fits) > CACHE_PAIRS:
            self.fits.clear()
        tails, token, le, fits, fit = self.tails, self.token, self.le, self.fits, self.fit
        for at in sorted(range(len(words)), key=words.__getitem__):
            word = words[at]
            shared = len(os.path.commonprefix((path, word)))
            del last[shared + 1:]
            for end in range(shared + 1, len(word) + 1):
                start = end - 1
                while (t := tails[word[start:end]]) < 0 or not (
                        fits[p] if (p := (last[start], t)) in fits else fits.setdefault(p, fit(*p))):
                    start -= 1
                last.append(t)
            path = word
            back, end = [], len(word)
            while end:
                back.append(le[last[end]])
                end -= len(token[last[end]])
            back.reverse()
            out[at] = b"".join(back)
        return out

    def split(self, text: str) -> list[str]:
        if not self.other.search(text):
            return self.latin.findall(text)
        return [text[a:b] for _, (a, b) in byte_level().pre_tokenize_str(text)]

    def pieces(self, text: str) -> list[str]:
        """The text's words, special tokens standing alone."""
        if self.cut is None or not any(s in text for s in self.special):
            return self.split(text)
        out = []
        for part in self.cut.split(text):
            if part in self.special:
                out.append(part)
            elif part:
                out += self.split(part)
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each whole text as little-endian unsigned 32-bit integers; the
        distinct new words of all of them are encoded in one walk."""
        cut = [self.pieces(t) for t in texts]
        words = set().union(*cut)
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
        cache = self.cache
        new = [w for w in words if w not in cache and w not in self.special]
        cache.update(zip(new, self.encode_words([w.encode() for w in new])))
        cache.update((w, self.le[i]) for w, i in self.special.items())
        out = [b"".join(map(cache.__getitem__, c)) for c in cut]
        for w in new:
            if len(w) > CACHE_WORD_BYTES:
                del cache[w]
        return out

    def decode(self, ids: bytes) -> bytes:
        """The bytes the ids stand for, special tokens as their strings."""
        a = array("I")
        a.frombytes(ids)
        return b"".join(map(self.token.__getitem__, a))


@functools.lru_cache(maxsize=1)
def byte_level():
    from tokenizers import pre_tokenizers

    return pre_tokenizers.ByteLevel(add_prefix_space=False)


def blocks(texts, chars: int):
    """Lists of neighbouring texts of at most ``chars`` characters, or of one text."""
    out, size = [], 0
    for t in texts:
        t = t.as_py() or ""
        if out and size + len(t) > chars:
            yield out
            out, size = [], 0
        out.append(t)
        size += len(t)
    if out:
        yield out


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> TrieEncoder:
    """One encoder per worker and vocabulary."""
    return TrieEncoder(path)


def encode_documents(docs: DataFrame, vocab_path: str, text_col: str = "text", keep: tuple[str, ...] = (),
                     with_ids: bool = True) -> DataFrame:
    """Encode every whole text, and decode the ids again.

    Returns the columns ``keep`` of ``docs`` (repeated rows stay repeated), and
    ``ids`` (array<int>, if ``with_ids``), ``n_tokens``, ``ids_sha256``,
    ``decoded_sha256``. ``vocab_path`` is read on the workers. Row-wise: no
    shuffle. Null texts count as empty: no ids, the digests of nothing.
    """
    ship(docs.sparkSession)
    outputs = (["ids array<int>"] if with_ids else []) + [
        "n_tokens bigint", "ids_sha256 string", "decoded_sha256 string"]
    src = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").cast("string").alias("_text_in"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1])
    schema = ", ".join(([kept] if kept else []) + outputs)

    names = [*keep, *(c.split()[0] for c in outputs)]

    def run(batches):
        enc, sha = encoder(vocab_path), hashlib.sha256
        for batch in batches:
            at = 0
            for block in blocks(batch.column(batch.num_columns - 1), BLOCK_CHARS):
                codes = enc.encode(block)
                cols = [batch.column(k).slice(at, len(block)) for k in range(batch.num_columns - 1)]
                at += len(block)
                n = [len(c) // 4 for c in codes]
                if with_ids:
                    cols.append(pa.ListArray.from_arrays(pa.array([0, *itertools.accumulate(n)], pa.int32()),
                                                         pa.array(np.frombuffer(b"".join(codes), "<i4"))))
                cols += [pa.array(n, pa.int64()), pa.array([sha(c).hexdigest() for c in codes], pa.string()),
                         pa.array([sha(enc.decode(c)).hexdigest() for c in codes], pa.string())]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return src.mapInArrow(run, schema)

"""Blocks of words as numbers: what the phrase and passage operators work on."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .ppm import pack, unpack

#: Bytes of text of one block.
BLOCK_BYTES = 12 << 20


def cut_into_blocks(batches: Iterator[pa.RecordBatch], column: str, size: int,
                    done: Callable[[pa.Table], Iterator[pa.RecordBatch]]) -> Iterator[pa.RecordBatch]:
    """Call ``done`` for runs of rows that hold about ``size`` bytes of ``column`` (one row
    at least), in order."""
    waiting: list[pa.Table] = []
    held = 0
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        ends = np.cumsum(pc.fill_null(pc.binary_length(rows[column]), 0).to_numpy().astype(np.int64) + 1)
        begin, before = 0, 0
        while begin < len(ends):
            # up to the first row that fills the block
            stop = min(int(np.searchsorted(ends, before + size - held)) + 1, len(ends))
            waiting.append(rows.slice(begin, stop - begin))
            held += int(ends[stop - 1]) - before
            begin, before = stop, int(ends[stop - 1])
            if held >= size:
                yield from done(pa.concat_tables(waiting))
                waiting, held = [], 0
    if waiting:
        yield from done(pa.concat_tables(waiting))


def numbered(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Words (runs of bytes other than ASCII white space) of each text: how many, their
    numbers one text after the other, and the words by number. Null is empty."""
    split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat = split.flatten()
    if isinstance(flat, pa.ChunkedArray):
        flat = flat.combine_chunks()
    coded = flat.dictionary_encode()
    numbers, words = coded.indices.to_numpy().astype(np.int64), coded.dictionary.cast(pa.binary()).to_pylist()
    real = np.array([bool(w) for w in words], bool)
    is_word = real[numbers]  # white space at the ends makes empty strings
    before = np.concatenate(([0], np.cumsum(is_word)))
    ends = before[np.cumsum(pc.list_value_length(split).to_numpy().astype(np.int64))]
    new = np.cumsum(real) - 1
    return (np.diff(ends, prepend=0), new[numbers[is_word]].astype(np.uint32),
            [w for w in words if w])


def pack_words(words: list[bytes]) -> tuple[bytes, bytes]:
    """(letters, lengths)"""
    letters = b"".join(words)
    return (len(letters).to_bytes(8, "little") + pa.compress(letters, "zstd", asbytes=True),
            pack(np.array([len(w) for w in words], np.uint32)))


def unpack_words(letters: bytes, lengths: bytes) -> list[bytes]:
    size = int.from_bytes(letters[:8], "little")
    text = pa.decompress(letters[8:], size, "zstd", asbytes=True) if size else b""
    n = unpack(lengths, "<u4").astype(np.int64)
    ends = np.cumsum(n)
    return [text[a:b] for a, b in zip((ends - n).tolist(), ends.tolist())]


def word_array(letters: bytes, lengths: bytes) -> pa.Array:
    """Packed words as an Arrow column."""
    size = int.from_bytes(letters[:8], "little")
    text = pa.decompress(letters[8:], size, "zstd") if size else pa.py_buffer(b"")
    n = unpack(lengths, "<u4").astype(np.int64)
    offsets = np.concatenate(([0], np.cumsum(n)))
    return pa.Array.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(offsets), text])


def only_used(numbers: np.ndarray, words: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """Numbers and words without the words that no number names."""
    used, new = np.unique(numbers, return_inverse=True)
    return new.astype(np.uint32), [words[k] for k in used.tolist()]


def rows_of(batches) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield {n: batch.column(i)[k].as_py() for i, n in enumerate(batch.schema.names)}


def one_row(types: dict[str, pa.DataType], **values) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([values[n]], t) for n, t in types.items()], names=list(types))

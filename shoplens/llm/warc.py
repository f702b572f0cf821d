"""WARC archives: writer and sequential reader.

Every record is a gzip member of its own. The reader goes through an archive in
one pass: it inflates member after member with an incremental zlib decompressor
(a fixed number of compressed bytes at a time), frames each record by its
Content-Length, and verifies block and payload digests. Archives are many files
of bounded size, so files are what is dealt out to tasks.

Payloads that repeat are written once: the record of the smallest page id is the
response, and the others are revisits that refer to it and hold no payload.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import ship, written

#: Payloads shorter than this are always written out.
MIN_REVISIT = 100
#: An archive is closed once it has this many compressed bytes.
ARCHIVE_BYTES = 64 << 20
#: Compressed bytes read at a time, and inflated bytes taken at a time.
READ_BYTES = 1 << 16
INFLATE_BYTES = 1 << 18
LEVEL = 6

#: Fixed values of the WARC 1.1 format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "2000-01-01T00:00:00Z"
_ID = uuid.uuid5(uuid.NAMESPACE_URL, "warc-record")


class WarcError(ValueError):
    """The archive is cut short, wrongly framed, or a digest doesn't match."""


def _digest(data: bytes) -> str:
    return "sha256:" + base64.b32encode(hashlib.sha256(data).digest()).decode()


def record(kind: str, page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None) -> bytes:
    """One record as it stands in an archive, before compression."""
    block = b"" if kind == "revisit" else payload
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(_ID, f'{kind} {page_id}')}>"),
            ("WARC-Date", _DATE), ("Content-Type", "text/html"), ("Content-Length", str(len(block))),
            ("WARC-Block-Digest", _digest(block)), ("WARC-Payload-Digest", _digest(payload)),
            ("X-Payload-Length", str(len(payload)))]
    if url is not None:  # any text in one line, as base64 if it isn't plain
        plain = url.isascii() and url.isprintable() and url == url.strip()
        head.append(("WARC-Target-URI", url) if plain else
                    ("X-Target-URI-Base64", base64.b64encode(url.encode()).decode()))
    if page_id is not None:
        head.append(("X-Page-ID", str(page_id)))
    if kind == "revisit":
        head += [("WARC-Profile", REVISIT_PROFILE), ("X-Refers-To-Page-ID", str(refers_to)),
                 ("WARC-Refers-To", f"<urn:uuid:{uuid.uuid5(_ID, f'response {refers_to}')}>")]
    lines = [VERSION, *(f"{k}: {v}".encode() for k, v in head), b"", block]
    return b"\r\n".join(lines) + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """``data`` as one gzip member."""
    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def members(read) -> Iterator[Iterator[bytes]]:
    """The gzip members of a stream, each as pieces of inflated bytes. ``read(n)``
    gives at most n more bytes, none at the end."""
    rest = b""

    def pieces():
        nonlocal rest
        z = zlib.decompressobj(31)
        while not z.eof:
            if not rest:
                rest = read(READ_BYTES)
                if not rest:
                    raise WarcError("archive ends inside a gzip member")
            try:
                out = z.decompress(rest, INFLATE_BYTES)
            except zlib.error as e:
                raise WarcError(f"not a gzip member: {e}") from e
            rest = z.unused_data if z.eof else z.unconsumed_tail
            if out:
                yield out

    while True:
        if not rest:
            rest = read(READ_BYTES)
            if not rest:
                return
        one = pieces()
        yield one
        for _ in one:  # what the caller left
            pass


def parse(pieces: Iterator[bytes]) -> tuple[dict[str, str], bytes]:
    """Headers (lower-case names) and block of one record, its length and digests
    checked."""
    data, end = bytearray(), -1
    while end < 0:
        piece = next(pieces, None)
        # URLs are of any length, so headers are. What isn't a record isn't read on.
        if piece is None or len(data) >= len(VERSION) and not data.startswith(VERSION):
            raise WarcError("record without end of header")
        seen = max(len(data) - 3, 0)
        data += piece
        end = data.find(b"\r\n\r\n", seen)
    lines = bytes(data[:end]).decode().split("\r\n")
    if lines[0] != VERSION.decode():
        raise WarcError(f"not a record: {lines[0][:40]!r}")
    head = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise WarcError(f"not a header line: {line[:40]!r}")
        head[name.strip().lower()] = value.strip()
    try:
        length = int(head["content-length"])
    except (KeyError, ValueError) as e:
        raise WarcError("record without a content length") from e
    del data[:end + 4]
    for piece in pieces:
        data += piece
        if len(data) > length + 4:
            break
    if len(data) != length + 4 or data[length:] != b"\r\n\r\n":
        raise WarcError(f"record of content length {length} is framed wrongly")
    block = bytes(data[:length])
    checked = ["warc-block-digest"] + ["warc-payload-digest"] * (head.get("warc-type") != "revisit")
    for name in checked:
        if name in head and head[name] != _digest(block):
            raise WarcError(f"{name} doesn't match")
    return head, block


def records(read) -> Iterator[tuple[dict[str, str], bytes]]:
    """All records of an archive, in order."""
    for pieces in members(read):
        yield parse(pieces)


def _open(path: str):
    # A path without a scheme is a local one.
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def decide(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """``pages`` (page_id, url, payload binary) with refers_to: the smallest page
    id of equal payloads of at least ``min_revisit`` bytes where that isn't the
    row's own, else null. Only digests are grouped."""
    keyed = pages.withColumn("digest", F.unhex(F.sha2("payload", 256)))
    long = F.length("payload") >= min_revisit
    groups = (keyed.where(long).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
              .where("n > 1").select("digest", "first"))
    same = keyed.join(groups, "digest", "left")
    refers: Column = F.when(long & ~F.col("first").eqNullSafe(F.col("page_id")), F.col("first"))
    return same.select("page_id", "url", "payload", refers.alias("refers_to"))


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record per row of ``pages`` into archives under ``path`` (a URI that
    all executors reach), and return the manifest: archive, n_records, n_bytes.

    Payload: the html in UTF-8, empty for null. Of records with equal payloads of
    at least 100 bytes those with the smallest page id are responses, others
    revisit; rows that repeat the smallest id are responses too, rows without an
    id revisit if any row of the group has one. Only archives in the manifest
    count: what a failed task left behind isn't read.
    """
    spark = pages.sparkSession
    ship(spark)
    src = pages.select(F.col(f"`{id_col}`").cast("bigint").alias("page_id"),
                       F.col(f"`{url_col}`").cast("string").alias("url"),
                       F.encode(F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")), "utf-8").alias("payload"))

    def run(batches):
        store, root = _open(path)
        store.create_dir(root, recursive=True)
        out, name, n, size, done = None, "", 0, 0, []
        for batch in batches:
            ids, urls, payloads, refers = (batch.column(k) for k in range(4))
            for k in range(batch.num_rows):
                if out is None:
                    name, n, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{root}/{name}")
                to = refers[k].as_py()
                data = member(record("response" if to is None else "revisit", ids[k].as_py(), urls[k].as_py(),
                                     payloads[k].as_py(), to))
                out.write(data)
                n, size = n + 1, size + len(data)
                if size >= archive_bytes:
                    out.close()
                    out = None
                    done.append((name, n, size))
        if out is not None:
            out.close()
            done.append((name, n, size))
        cols = list(zip(*done)) if done else [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()),
                                          pa.array(cols[2], pa.int64())], names=["archive", "n_records", "n_bytes"])

    made = decide(src).mapInArrow(run, "archive string, n_records bigint, n_bytes bigint")
    return written(made.select(F.concat(F.lit(path + "/"), "archive").alias("archive"), "n_records", "n_bytes"),
                   "warc-manifest")


def read_archives(manifest: DataFrame) -> DataFrame:
    """The records of the archives named in ``manifest`` (archive): page_id, url,
    record_type, payload (null for revisits), payload_bytes, payload_digest (hex),
    refers_to. A damaged archive is an error that names it."""
    ship(manifest.sparkSession)
    schema = ("page_id bigint, url string, record_type string, payload string, payload_bytes bigint, "
              "payload_digest string, refers_to bigint")

    def number(text):
        return None if text is None else int(text)

    def row(head, block):
        url = head.get("warc-target-uri")
        if url is None and "x-target-uri-base64" in head:
            url = base64.b64decode(head["x-target-uri-base64"]).decode()
        digest = base64.b32decode(head["warc-payload-digest"].partition(":")[2]).hex()
        revisit = head["warc-type"] == "revisit"
        return (number(head.get("x-page-id")), url, head["warc-type"], None if revisit else block.decode(),
                int(head["x-payload-length"]) if revisit else len(block), digest,
                number(head.get("x-refers-to-page-id")) if revisit else None)

    def run(batches):
        names = ["page_id", "url", "record_type", "payload", "payload_bytes", "payload_digest", "refers_to"]
        kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()]

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            for archive in batch.column(0).to_pylist():
                store, name = _open(archive)
                rows, size = [], 0
                with store.open_input_stream(name) as stream:
                    try:
                        for head, block in records(stream.read):
                            rows.append(row(head, block))
                            size += len(block)
                            if len(rows) >= 1000 or size > 8 << 20:
                                yield batch_of(rows)
                                rows, size = [], 0
                    except WarcError as e:
                        raise WarcError(f"{archive}: {e}") from e
                if rows:
                    yield batch_of(rows)

    n = max(1, manifest.count())
    return manifest.select("archive").repartition(n).mapInArrow(run, schema)


def archive_path(spark) -> str:
    return scratch_path(spark, "warc")

"""Registered queries of the text operators: each applies its operator with
production parameters to its whole table."""

from __future__ import annotations

import public_tokenizers

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fm_quality, html_text, lang_id
from .bpe import encode_documents
from .common import table
from .decontam import contaminated
from .exact_dedup import exact_dedup
from .phrases import collocations
from .ppm import ppm_score
from .repeats import without_repeats
from .sharding import row_bytes, shards_path, shuffle_to_shards
from .simhash import simhash_dedup
from .vector_codes import compress
from .warc import archive_path, read_archives, write_archives

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def register(f):
    QUERIES[f.__name__] = f
    return f


@register
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with the item and its coverage."""
    return contaminated(table(spark, sf_dir, "documents", "doc_id", "text"),
                        table(spark, sf_dir, "benchmark", "item_id", "text")).drop("tiles")


@register
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record, as read back from the archives it was written to."""
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html")
    return read_archives(write_archives(pages, archive_path(spark))).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE["op2_warc"] = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
g AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first
  FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN first IS NOT NULL AND first IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first IS DISTINCT FROM page_id THEN first END AS refers_to
FROM g
"""


@register
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return simhash_dedup(docs).select("doc_id", "fingerprint", "component_id")


@register
def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(table(spark, sf_dir, "pages", "page_id", "url", "html"))


@register
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which of equal documents stays, for every document."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return exact_dedup(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLE["op5_exact_dedup"] = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""


@register
def op6_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document under a model of nine tenths of them."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return ppm_score(docs.withColumn("train", lang_id.learns_from(F.col("doc_id"), 10, 0)), "train")


@register
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from the labels training may use."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "n_chars")
    labels = table(spark, sf_dir, "labels", "doc_id", "quality")
    learns = lang_id.learns_from(F.col("doc_id"))
    machine = fm_quality.fit(docs, labels.where(learns), metadata=("n_chars",))
    return fm_quality.score(docs.withColumn("held_out", ~learns), machine, metadata=("n_chars",))


@register
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the rows that training may use."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    learns = lang_id.learns_from(F.col("doc_id"))
    model = lang_id.fit(docs.where(learns).select("lang", "text"))
    return lang_id.predict(docs.select("doc_id", (~learns).alias("held_out"), "text"), model)


@register
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text of every document."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return encode_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), keep=("doc_id",), with_ids=False)


@register
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document, from the shards as written; law: rows."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    done = shuffle_to_shards(docs, shards_path(spark))
    return done.select("doc_id", row_bytes(F.col("text")).alias("size"),
                       F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
                       F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@register
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code and error of every vector, from codebooks after two rounds."""
    coded, books = compress(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))
    return coded.select("vec_id", "code", "error", "label_error", F.lit(books.sha256).alias("codebooks_sha256"))


def _round(k: int) -> str:
    """SQL of one assignment (a) to the codebooks b, and of the codebooks after it."""
    return f"""
a{k} AS (
  SELECT p.vec_id, p.part, min(64 * (
      (p.v[1] - b.v[1]) * (p.v[1] - b.v[1]) + (p.v[2] - b.v[2]) * (p.v[2] - b.v[2])
    + (p.v[3] - b.v[3]) * (p.v[3] - b.v[3]) + (p.v[4] - b.v[4]) * (p.v[4] - b.v[4])) + b.entry) AS best
  FROM p JOIN b{k} b ON p.part = b.part GROUP BY ALL),
m{k} AS (
  SELECT a.part, a.best % 64 AS entry, i, sum(p.v[i]) AS s, count(*) AS n
  FROM a{k} a JOIN p ON p.vec_id = a.vec_id AND p.part = a.part, range(1, 5) r(i) GROUP BY ALL),
b{k + 1} AS (
  SELECT b.part, b.entry, coalesce(any_value(moved), any_value(b.v)) AS v
  FROM b{k} b LEFT JOIN (
    SELECT part, entry, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS moved
    FROM m{k} GROUP BY part, entry) m ON m.part = b.part AND m.entry = b.entry
  GROUP BY b.part, b.entry)"""


ORACLE["op11_vector_codes"] = f"""
WITH k AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (
  SELECT vec_id, part, v[4 * part + 1:4 * part + 4] AS v FROM k, range(16) r(part)),
b0 AS (
  SELECT part, entry, v
  FROM (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM k ORDER BY vec_id LIMIT 64)
  JOIN p USING (vec_id)),{_round(0)},{_round(1)},{_round(2)},
f AS (
  SELECT a.vec_id, string_agg(format('{{:02x}}', best % 64), '' ORDER BY part) AS code,
         CAST(sum(best // 64) AS BIGINT) AS error
  FROM a2 a GROUP BY a.vec_id)
SELECT f.vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(x, ',' ORDER BY part, entry, i))
        FROM (SELECT part, entry, i, CAST(v[i] AS VARCHAR) AS x FROM b2, range(1, 5) r(i))) AS codebooks_sha256
FROM f JOIN k USING (vec_id)
"""


@register
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 collocations of each language with the highest scores."""
    return collocations(table(spark, sf_dir, "documents", "text", "lang"))


ORACLE["op12_collocations"] = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
p AS MATERIALIZED (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM d),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY lang),
f AS MATERIALIZED (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, m, count(*) AS f
  FROM p, range(1, 6) t(m), unnest(range(1, CAST(len(w) AS BIGINT) - m + 2)) AS r(i)
  GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE m >= 2),
inside AS (
  SELECT lang, array_to_string(w[i:j], ' ') AS phrase, max(f) AS most
  FROM c, range(1, 6) a(i), range(1, 6) b(j) WHERE j <= m AND j - i >= 1 AND j - i < m - 1 GROUP BY ALL),
cuts AS (
  SELECT c.lang, c.phrase, c.f AS a, l.f AS l, r.f AS r, n.n, k,
         (1000 * CAST(c.f AS HUGEINT) * n.n) // (CAST(l.f AS HUGEINT) * r.f) AS score
  FROM c JOIN n ON n.lang = c.lang, range(1, 5) t(k),
  f l, f r
  WHERE k < c.m AND l.lang = c.lang AND r.lang = c.lang
    AND l.phrase = array_to_string(c.w[1:k], ' ') AND r.phrase = array_to_string(c.w[k + 1:], ' ')),
low AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (
  SELECT low.*, row_number() OVER (PARTITION BY low.lang ORDER BY score DESC, a DESC, low.phrase) AS rank
  FROM low LEFT JOIN inside i ON i.lang = low.lang AND i.phrase = low.phrase
  WHERE 100 * coalesce(most, 0) < 100 * a)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 2000
"""


@register
def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the passages of 35 words that stand elsewhere too."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return without_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")


ORACLE["op13_substring_dedup"] = r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents),
s AS (
  SELECT rid, i, sha256(array_to_string(words[i:i + 34], ' ')) AS h
  FROM d, unnest(range(1, CAST(len(words) AS BIGINT) - 33)) AS r(i)),
g AS (
  SELECT rid, unnest(range(i, i + 35)) AS i
  FROM (SELECT *, count(*) OVER (PARTITION BY h) AS n FROM s) WHERE n > 1),
gone AS MATERIALIZED (SELECT DISTINCT rid, i FROM g),
w AS (SELECT rid, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM d),
k AS (
  SELECT w.rid, string_agg(w.word, ' ' ORDER BY w.i) FILTER (gone.i IS NULL) AS kept, count(gone.i) AS n_removed
  FROM w LEFT JOIN gone ON gone.rid = w.rid AND gone.i = w.i GROUP BY w.rid)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (rid)
"""

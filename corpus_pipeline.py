"""Training-data pipeline: documents in, token ids out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read back as the next stage's ``docs``. All stages but the last
return the columns of ``documents``, whatever further ones there are.

* language: documents in none of the learned languages go (no letter, or the
  best language is hardly likelier than chance). Learned from the labelled
  rows of its own input; where no row is labelled, all stay.
* exact: one row stays of rows with equal texts (white space normalised), the
  one with the smallest id.
* near: one row stays of each SimHash component, the one with the smallest id.
* decontaminate: documents that hold a benchmark item go.
* tokens: ids, their number, and digests of ids and decoded text.

Rows without an id, null and empty texts and repeated rows pass through as the
operators define; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.llm import bpe, decontam, lang_id
from shoplens.llm.common import table, work_columns, written
from shoplens.llm.exact_dedup import exact_dedup
from shoplens.llm.simhash import simhash_dedup

#: SQL can't express the language model, SimHash (XXH64 with a seed), tiling and
#: BPE; tests hold the stages against brute force.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    learns = lang_id.learns_from(F.col("doc_id"))
    model = lang_id.fit(docs.where(learns).select("lang", "text"))
    return lang_id.accepted(docs, model)


def _one_of_each(docs: DataFrame, groups: Callable[..., DataFrame]) -> DataFrame:
    """The rows that ``groups`` keeps. Rows are named by a written id, and only
    the ids of those that go are joined back."""
    rid = work_columns(docs, rid=None)["rid"]
    rows = written(docs.withColumn(rid, F.monotonically_increasing_id()), "stage-rows")
    gone = written(groups(rows, rid_col=rid).where(~F.col("kept")).select(F.col("rid").alias(rid)), "stage-gone")
    return rows.join(gone, rid, "left_anti").drop(rid)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _one_of_each(docs, exact_dedup)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _one_of_each(docs, simhash_dedup)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean_documents(docs, decontam.benchmark_table(spark, sf_dir))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), keep=("doc_id",))


STAGES = [("language", language), ("exact", exact), ("near", near), ("decontaminate", decontaminate),
          ("tokens", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of the documents that all stages keep."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs

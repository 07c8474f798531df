"""A training-data pipeline over ``documents``: reject low quality, drop exact
and near copies, mix sources to target weights, tokenise.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each stage's result as Parquet in the shared folder and reads it back as the
next one's documents. Every stage works on all rows that its predecessor kept.
The first three write their input with a key of each row and drop rows by that
key, never by id: ids may be null or repeat, with equal or different texts.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from telco_mart.llm import bpe, exact_dedup, mixing, quality, simhash_dedup  # noqa: E402
from telco_mart.llm.common import table, written  # noqa: E402
from telco_mart.llm.queries import RANKS, SEED  # noqa: E402

#: Name of the row key; columns of the documents may have any other name.
KEY = "__pipeline_row"


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with a unique row key, written so that the keys stay as they are."""
    return written(docs.withColumn(KEY, F.monotonically_increasing_id()), "keyed")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality classifier does not reject. Each row is judged on
    its own text: of rows that share an id (or have none) only the rejected go."""
    rows = keyed(docs)
    judged = quality.classify(rows, table(spark, sf_dir, "labels"), carry=(KEY,))
    rejected = written(judged.filter(~F.col("keep")).select(KEY), "rejected")
    return rows.join(rejected, KEY, "left_anti").select(docs.columns)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the one row with the largest id (null is below any id);
    of several with that id, the last by row key."""
    rows = keyed(docs)
    found = exact_dedup.exact_duplicates(rows.select(F.struct("doc_id", KEY).alias("key"), "text"), "key")
    dropped = written(found.filter(~F.col("kept")).select(f"key.{KEY}"), "copies")
    return rows.join(dropped, KEY, "left_anti").select(docs.columns)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, the one row with the smallest id (null
    is above any id); of several with that id, the first by row key."""
    rows = keyed(docs)
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", KEY)
    found = simhash_dedup.near_duplicates(rows.select(key.alias("key"), "text"), shingle=4, radius=4, id_col="key")
    dropped = written(found.filter(F.col("key") != F.col("component_id")).select(f"key.{KEY}"), "near_copies")
    return rows.join(dropped, KEY, "left_anti").select(docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of the documents by source, shuffled. A null source is one source
    of its own; rows that repeat, wholly or in their id, draw their counts one by
    one; a count may be zero. Other columns stay, whatever their names."""
    names = {c: f"__pipeline_{i}" for i, c in enumerate(docs.columns)}
    mixed = mixing.mix(docs.withColumnsRenamed(names), mixing.source_rates(docs, temperature=0.5), seed=SEED, source_col=names["source"])
    return mixed.select(*(F.col(n).alias(c) for c, n in names.items()))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, and whether they decode to the text byte for byte. A null text
    counts as empty and has no tokens; null ids and repeated rows are encoded
    row by row; only the columns of ``documents`` are read."""
    rows = docs.select("doc_id", "lang", "source", "n_chars", "text", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_sha256"))
    encoded = bpe.encode(rows, RANKS, keep_text=False, decoded=True)
    return encoded.select("doc_id", "lang", "source", "n_chars", "n_tokens", "ids", (F.sha2("decoded", 256) == F.col("text_sha256")).alias("round_trip"))


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_dedup_stage),
    ("SimHash near-dedup", simhash_stage),
    ("mixing sources to target weights", mixing_stage),
    ("byte-level BPE", bpe_stage),
]
#: A trained classifier decides the first stage: SQL can't state run()'s rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs

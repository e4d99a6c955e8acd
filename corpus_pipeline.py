"""Training-data pipeline over `documents`: each stage takes what its
predecessor kept, is written as Parquet and read again by the next one.

Language ID drops texts in no learned language; SimHash keeps one document of
each near-duplicate group; suffix-array dedup removes repeated 100-byte strings;
the secret scan redacts what it finds; packing lays the texts out in sequences.

Every stage takes `documents` as its predecessor left them, with any further
columns, whatever their names, and all but the last return the same columns. Null
ids, null and empty texts, repeated rows, long texts and empty tables are taken as
each stage says below.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.llm import langid, packing, secret_scan, simhash, suffix
from weir.llm.common import id_fold
from weir.llm.queries import TOKENIZER
from weir.session import apply_result_conf, scratch_path
from weir.sources.tables import table_path

MIN_LANGUAGE_SCORE = 0.1  # share of a text's n-grams that its best language must know


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language. Null texts and texts without a letter are in
    none and go; repeated rows and null ids are judged by their text alone; of equally
    probable languages the first by name is taken."""
    apply_result_conf(spark)
    bitmask = langid.learn(docs, id_fold() != 0)
    judged = langid.predict(docs, bitmask, [F.col(f"`{c}`") for c in docs.columns])
    kept = judged.where((F.col("lang_pred") != "und") & (F.col("score") >= MIN_LANGUAGE_SCORE))
    return kept.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the smallest id (null ids last),
    and of rows repeated under it the one whose text hashes smallest. Texts without a
    word share a fingerprint and are one group."""
    apply_result_conf(spark)
    return simhash.keep_one(docs, shingle=3, budget=2)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes that a 100-byte string covers which also starts
    earlier; `n_chars` follows the text. Rows stay, with what is left of their text."""
    apply_result_conf(spark)
    return suffix.remove_repeats(docs, width=100, text=True)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with every secret replaced; a string judged secret at one of its places
    is replaced at all places of that text. Null and empty texts stay as they are."""
    apply_result_conf(spark)
    return secret_scan.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece with its sequence, offset and ids; a null or empty text is one
    piece of the end id alone, a long one is cut into pieces of 2048 ids."""
    apply_result_conf(spark)
    return packing.pack(docs, public_tokenizers.path(TOKENIZER), capacity=2048, ids=True)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id), ("simhash_near_dedup", near_dedup), ("suffix_array_dedup", exact_dedup),
    ("secret_scan", secrets), ("best_fit_packing", pack),
]
ORACLE_SQL = None  # fingerprints, learned filters and tokenizers are beyond SQL; see tests/llm/test_pipeline.py


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; the last one's rows."""
    docs = spark.read.parquet(table_path(sf_dir, "documents"))
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
    return docs

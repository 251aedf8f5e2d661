"""Documents through the training-data operators, stage by stage.

Null ids and texts, repeated rows and empty tables pass through as the operators define it:

* language: rows without a letter, and those whose best language is less likely than ``LEAST_SCORE``, go; a null label
  is filled with the prediction.
* near copies: of each component the document with the smallest id stays, of rows equal in id and text one. Documents
  without an id come behind all others.
* decontamination: documents that a benchmark item leaks into go.
* secrets: every span is replaced by a mark and ``n_chars`` counted anew; no document goes.
* tokens: one row per document that is left.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakemart.llm import bpe_recursive, byte_cnn, entropy_secrets, group_jaccard, template_decon
from lakemart.session import new_table_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
LEAST_SCORE = 0.3


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known, by a network trained on the labelled ones."""
    found = byte_cnn.predict(docs, byte_cnn.learn(docs))
    known = found.where((F.col("lang_pred") != byte_cnn.UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return known.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose sets of five-word shingles are alike to 80 percent."""
    # a document without an id gets a number of its text above all ids
    own = F.shiftrightunsigned(F.xxhash64("text"), 2) + F.lit(1 << 62)
    keyed = docs.withColumn("key", F.coalesce(F.col("doc_id"), own))
    found = group_jaccard.link_components(keyed, words=5, percent=80, id_column="key")
    first = found.where("component_id = key").groupBy("key").agg(F.count("*").alias("rows_of_key"))
    # the join has brought the rows of a key together, so this needs no further shuffle
    repeated = F.when(F.col("rows_of_key") > 1, F.col("text"))
    nth = F.row_number().over(Window.partitionBy("key", repeated).orderBy("source"))
    return keyed.join(first, "key").withColumn("nth", nth).where("nth = 1").select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark item leaks into."""
    # a document without an id is known by its text
    named = docs.withColumn("name", F.coalesce(F.col("doc_id").cast("string"), F.sha2("text", 256)))
    leaks = template_decon.leaks(named, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), document_id="name")
    return named.join(leaks.select("name").distinct(), "name", "left_anti").select(*docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each secret."""
    masked = entropy_secrets.mask(entropy_secrets.scan(docs))
    return masked.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document; ``same`` tells whether they decode to its text."""
    n_tokens = F.size("ids").cast("long").alias("n_tokens")
    return bpe_recursive.round_trip(docs).select("doc_id", n_tokens, "ids", "same")


STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("near_copies", near_copies),
    ("decontaminate", decontaminate),
    ("mask_secrets", mask_secrets),
    ("tokens", tokens),
]

# The stages train a network, follow links and merge byte pairs, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another; each reads what the one before it has written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = new_table_path(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

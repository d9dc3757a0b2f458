"""The corpus pipeline (counted as part of chainframe.llm): language ID, near copies, personal data, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; each result is written as Parquet and read back as the next
stage's docs. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainframe.llm import jaccard, language, mixing, pii
from chainframe.llm.common import cut, word_count, words_digest
from chainframe.llm.queries import byte_bpe_digest


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the language that the model tells as the documents' lang. Only those without letters (or, without a model, all) have
    none and are rejected: the score falls with each further language in a clean text, so it is no reason to reject one."""
    model = language.fit(docs.where(~language.held_out()))
    told = language.predict(docs.select("doc_id", "text", "lang", "source", "n_chars"), model)
    kept = told.where(F.col("lang_pred") != language.UNKNOWN)
    return kept.select("doc_id", "text", F.col("lang_pred").alias("lang"), "source", "n_chars")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class: that of the smallest doc_id (of several texts of it, by the texts' digest; of its repeated rows,
    the smallest by its columns). Documents without words are alike only to themselves; those without a doc_id are in no class and stay."""
    keyed = docs.withColumn("_digest", words_digest(F.col("text")))
    classes = jaccard.classes(docs.select("doc_id", "text")).groupBy("doc_id", "digest").agg(F.first("root").alias("root"), F.count("*").alias("_rows"))
    row = F.struct("doc_id", "digest", "_rows")
    first = classes.where("root is not null").groupBy("root").agg(F.min(row).alias("x")).select("x.*")
    kept = first.unionByName(classes.where("root is null").drop("root"))
    met = keyed.join(kept.withColumnsRenamed({"doc_id": "_id", "digest": "_of"}), (F.col("doc_id") == F.col("_id")) & (F.col("_digest") == F.col("_of")))
    single = met.where("_rows = 1").select(docs.columns)
    repeated = met.where("_rows > 1").groupBy("_id", "_of").agg(F.min(F.struct(*docs.columns)).alias("x")).select("x.*")
    return single.unionByName(repeated).unionByName(docs.where("doc_id is null")).select(docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks personal data; n_chars follows the text."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each document as often as the mix of sources does."""
    return mixing.mix(docs, word_count(F.col("text")))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row a document taken: the digests of its token ids and of what they decode to."""
    return byte_bpe_digest(docs, written=True)


STAGES = [
    ("language ID", language_id),
    ("n-gram Jaccard join", near_copies),
    ("PII", personal_data),
    ("mixing", mixture),
    ("byte-level BPE", tokens),
]
#: Fitted models, EM, pattern graphs and BPE are not SQL; tests/llm holds the pipeline against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs

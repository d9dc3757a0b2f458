"""The queries of the training-data operators, with production parameters, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainframe.llm import ann, bpe, html, jaccard, language, mixing, pii, quality, secrets, warc
from chainframe.llm.common import cut, word_count


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.plan(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), word_count(F.col("text")))
    return mixing.per_row(plan).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.assess(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "p_good")


def span_digest(df: DataFrame, base: dict[str, str]) -> DataFrame:
    """doc_id with the number of spans of each base kind, the digest of these and the list of all. base: column by kind."""

    def listed(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    def of(*kinds):
        return lambda x: x["kind"].isin(*kinds)

    return df.select(
        "doc_id",
        *(F.size(F.filter("spans", of(kind))).cast("long").alias(c) for kind, c in base.items()),
        F.sha2(listed(F.filter("spans", of(*base))), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return span_digest(found, {"assign": "n_assign", "access": "n_access", "hex": "n_hex"})


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return span_digest(found, {kind: f"n_{kind}" for kind in pii.BASE})


def byte_bpe_digest(docs: DataFrame, written: bool = False) -> DataFrame:
    """doc_id with the digests of its ids and of the bytes they decode to. written: ids are written before they are decoded, so that a task
    encodes or decodes and holds one worker's memory."""
    import public_tokenizers

    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = bpe.encode(docs.select("doc_id", "text"), vocabulary, public_tokenizers.PATTERN)
    encoded = cut(encoded, "bpe-ids") if written else encoded
    return bpe.decode(encoded, vocabulary).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe_digest(table(spark, sf_dir, "documents"))


def op7_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 50 == 0)


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html")).withColumn("n_chars", F.length("text").cast("long"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, index = warc.write(table(spark, sf_dir, "pages"))
    return warc.read(path, index).select(
        F.expr("try_cast(key as long)").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.expr("try_cast(refers_to as long)").alias("refers_to")
    )


def identified(docs: DataFrame) -> DataFrame:
    """docs with the predicted language; the model learns from the labelled rows that are not held out."""
    model = language.fit(docs.where(~language.held_out()))
    return language.predict(docs, model)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identified(docs).select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


def queries() -> dict:
    return {f.__name__: f for f in (op1_ngram_jaccard_join, op2_mixing, op3_quality_rules, op4_secrets, op5_pii, op6_byte_bpe, op7_ann, op8_html_extraction, op9_warc, op10_language_id)}


#: DuckDB SQL of the one query that SQL expresses; the others are tested against plain versions.
WARC_SQL = """
    with payloads as (
        select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages
    ), ranked as (
        select *, min(page_id) over (partition by payload_digest) as first_id from payloads
    )
    select page_id, payload_bytes, payload_digest,
        case when payload_bytes >= 100 and page_id <> first_id then 'revisit' else 'response' end as record_type,
        case when payload_bytes >= 100 and page_id <> first_id then first_id end as refers_to
    from ranked
"""


def oracle_sql() -> dict[str, str]:
    return {"op9_warc": WARC_SQL}

"""The registered queries of the subpackage: each operator over its whole table."""

from uuid import uuid4

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from anticipa.llm import (
    decontaminate,
    importance,
    kd_shards,
    languages,
    lexical_search,
    licenses,
    minhash,
    oracles,
    packing,
    secrets,
    simhash,
    tokens,
    top_k,
    training_order,
    url_reputation,
)
from anticipa.llm.common import ship_code
from anticipa.session import shared_folder


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    ship_code(spark)
    return spark.read.parquet(f"{folder}/{table}.parquet")


def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(_read(spark, folder, "documents"))


def packed_digest(docs: DataFrame) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    crc = packing.ids_crc32(tokens.id_width(path))
    return packing.pack(docs, path).select(
        "doc_id", "start", "length", crc("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packed_digest(_read(spark, folder, "documents"))


def op7_training_order(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record as it is read back from the shards."""
    path = public_tokenizers.path("word_bpe_49k.json")
    out = f"{shared_folder(spark)}/training-order-{uuid4()}"
    width = tokens.id_width(path)
    if not training_order.write_in_order(_read(spark, folder, "documents"), out, path, key=7):
        return spark.createDataFrame([], "doc_id long, start long, tokens long, slot long, shard long, ids_crc32 long")
    read = training_order.read_in_order(spark, out, width, crc=True)
    return read.select(
        "doc_id", "start", "tokens", "slot",
        F.expr(f"slot DIV {training_order.SHARD_SLOTS}").alias("shard"), "ids_crc32",
    )


def op3_url_reputation(spark: SparkSession, folder: str) -> DataFrame:
    """Outcomes: a page is bad if the document of its number is labelled of low quality or toxic."""
    labels = _read(spark, folder, "labels")
    bad = F.greatest(1 - F.col("quality"), F.col("toxic"))
    outcomes = labels.select(F.col("doc_id").alias("page_id"), bad.cast("int").alias("bad"))
    return url_reputation.filter_urls(_read(spark, folder, "pages"), outcomes)


def op4_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return top_k.top_k(_read(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op5_kd_shards(spark: SparkSession, folder: str) -> DataFrame:
    rows = kd_shards.shard_by_bytes(_read(spark, folder, "documents"), 40)
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    rows = decontaminate.contamination(_read(spark, folder, "documents"), _read(spark, folder, "benchmark"))
    return rows.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op8_secrets(spark: SparkSession, folder: str) -> DataFrame:
    docs = _read(spark, folder, "documents").select("doc_id", "text")
    base = F.filter("spans", lambda s: s.kind.isin(*secrets.BASE))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    return secrets.with_spans(docs).select(
        "doc_id", *(count(k) for k in secrets.BASE),
        F.sha2(secrets.listed(base).cast("binary"), 256).alias("base_sha256"),
        secrets.listed(F.col("spans")).alias("spans"),
    )


def op9_languages(spark: SparkSession, folder: str) -> DataFrame:
    docs = _read(spark, folder, "documents")
    model = languages.train(docs.where(~languages.held_out(F.col("doc_id"))).select("text", "lang"))
    judged = languages.identify(docs.select("doc_id", "text"), model)
    return judged.select(
        "doc_id", languages.held_out(F.col("doc_id")).alias("held_out"), "language.lang_pred", "language.score"
    )


def op10_licenses(spark: SparkSession, folder: str) -> DataFrame:
    rows = licenses.scan(_read(spark, folder, "documents"))
    return rows.select(
        "doc_id", "n_words", F.size("starts").cast("long").alias("n_base"),
        F.array_min("starts").cast("long").alias("first_word"), F.array_max("starts").cast("long").alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score",
    )


def op11_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical_search.search(_read(spark, folder, "documents"), _read(spark, folder, "benchmark"))


def op12_importance(spark: SparkSession, folder: str) -> DataFrame:
    rows = importance.resample(_read(spark, folder, "documents"), _read(spark, folder, "benchmark"))
    return rows.drop("n_words")


def op13_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(_read(spark, folder, "documents"))


def queries() -> dict:
    return {
        "op1_simhash": op1_simhash,
        "op2_packing": op2_packing,
        "op3_url_reputation": op3_url_reputation,
        "op4_top_k": op4_top_k,
        "op5_kd_shards": op5_kd_shards,
        "op6_decontaminate": op6_decontaminate,
        "op7_training_order": op7_training_order,
        "op8_secrets": op8_secrets,
        "op9_languages": op9_languages,
        "op10_licenses": op10_licenses,
        "op11_lexical_search": op11_lexical_search,
        "op12_importance": op12_importance,
        "op13_minhash": op13_minhash,
    }


def oracle_sql() -> dict[str, str]:
    return oracles.oracle_sql()

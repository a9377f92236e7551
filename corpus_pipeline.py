"""A corpus from documents to packed sequences; each stage is one of the operators of anticipa.llm."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from anticipa.llm import decontaminate, languages, secrets, simhash
from anticipa.llm import queries as corpus
from anticipa.llm.common import columns_of, ship_code
from anticipa.session import written

_OWN = "anticipa pipeline"  # a column name that no table of a user has
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that some language of the labelled ones codes in fewer bits than no model would.

    Null texts, texts without a letter, and texts in other scripts or of noise go. Without any labelled text nothing can be
    judged, and every text with a letter stays.
    """
    ship_code(spark)
    model = languages.train(docs.select("text", "lang"), once_a_text=True)
    if model is None:
        return docs.where(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    return languages.recognised(docs, model, name=_OWN).where(F.col(_OWN)).select(*columns_of(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays."""
    ship_code(spark)
    return simhash.one_of_each_group(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item. Hits depend on the text alone, so texts go by their digest."""
    ship_code(spark)
    texts = docs.select(F.md5(F.col("text").cast("binary")).alias("doc_id"), "text")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.contamination(texts, benchmark).where("n_hit > 0").select(F.col("doc_id").alias(_OWN)).distinct()
    own = F.md5(F.col("text").cast("binary"))
    return docs.join(written(found, "contaminated"), own == F.col(_OWN), "left_anti").select(*columns_of(docs))


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret is replaced by a mark, and n_chars follows; the documents stay."""
    found = secrets.with_spans(docs, name=_OWN)
    text = secrets.redacted(F.col("text"), F.col(_OWN))
    changed = F.size(_OWN) > 0
    new = {"text": text, "n_chars": F.when(changed, F.length(text).cast("long")).otherwise(F.col("n_chars"))}
    return found.select(*(new[c].alias(c) if c in new else column for c, column in zip(docs.columns, columns_of(docs))))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_code(spark)
    return corpus.packed_digest(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language", known_language),
    ("simhash", near_duplicates),
    ("decontaminate", decontaminated),
    ("secrets", redacted),
    ("packing", packed),
]

# Trained models, fingerprints and tokenizers have no SQL. Tests hold the operators, not yet the whole chain, against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

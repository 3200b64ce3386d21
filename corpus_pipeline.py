"""A corpus from raw documents: language, near-duplicates, personal data, mix, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next stage's documents. All but the last keep the columns of documents. Rows are
told apart by their place, not by ``doc_id``: rows that share an id, or have none, are documents of
their own in every stage. An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventweir.llm import bpe, language, mixing, personal_data, simhash
from eventweir.llm.tables import fresh, own_columns, staged

#: Share of the labelled documents that the least clarity is calibrated to keep.
KEPT = 0.999


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or less clear than nearly all labelled ones, go. Clarity looks at
    windows, so a text in several languages stays. Null ``lang`` is no label; without any label
    nothing is known of clarity, and documents with a letter stay."""
    _, name, _, clarity = fresh(docs, "held_out", "lang_pred", "score", "clarity")
    rows = staged(language.identified(docs), "languages")
    labelled = rows.where(F.col("lang").isNotNull() & (F.col(name) != language.UNDETERMINED))
    least = labelled.agg(F.percentile_approx(clarity, 1 - KEPT, 100_000)).first()[0] or 0.0
    found = F.col(name) != language.UNDETERMINED
    if least == 0.0 and rows.where(found).isEmpty():
        found = F.col("text").rlike(r"\p{L}")
    return rows.where(found & (F.col(clarity) >= least)).select(*own_columns(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-copies one document stays: the one with the smallest id, null ids last."""
    return simhash.representatives(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts is replaced by its kind; null texts stay null."""
    return personal_data.without_personal_data(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are left out or repeated so that sources meet their target shares. Those without
    words, null texts among them, weigh nothing and get the certain copies of their source."""
    return mixing.take(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids' digests of every document of the mix, and of the text they decode to."""
    return bpe.digests(docs)


STAGES = [
    ("language", identify_language),
    ("simhash", drop_near_copies),
    ("personal_data", redact_personal_data),
    ("mixing", mix_sources),
    ("bpe", tokenize),
]

# A trained classifier, connected components and tokens are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

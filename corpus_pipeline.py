"""Documents to packed training sequences, in five stages.

Each stage takes the documents that the one before kept: quality rules, near duplicates,
benchmark decontamination, personal data, packing.  All but the last return the columns
of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grainframe.llm.decontaminate import find_leaks
from grainframe.llm.ngram_join import similar_sets
from grainframe.llm.packing import pack_documents
from grainframe.llm.pii import find_personal_data
from grainframe.llm.queries import tokenizer_path
from grainframe.llm.repetition import repetition_rules
from grainframe.session import cut_lineage

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the repetition rules."""
    return repetition_rules(docs.select(*COLUMNS)).where("kept").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component; repeated rows stay once.

    Rows are compared under numbers of their own, so rows without an id take part too:
    one of them stays where its component has no row with an id.
    """
    rows = cut_lineage(docs.select(*COLUMNS).withColumn("row", F.monotonically_increasing_id()), "numbered")
    groups = similar_sets(rows.select(F.col("row").alias("doc_id"), "text"))
    placed = rows.select("row", "doc_id").join(groups.select(F.col("doc_id").alias("row"), "component_id"), "row")
    first = placed.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first"))
    return rows.join(first.select("first.row"), "row", "left_semi").select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return find_leaks(docs.select(*COLUMNS), benchmark).where(F.size("leaks") == 0).select(*COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind; ``n_chars`` follows the text."""
    found = find_personal_data(docs.select(*COLUMNS))
    changed = F.col("spans") != ""
    return found.select(
        "doc_id",
        F.col("redacted").alias("text"),
        "lang",
        "source",
        F.when(changed, F.length("redacted").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"),
    )


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their place in sequences of 4096 tokens."""
    return pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packing),
]

#: Tokenisation and latent retrieval have no SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

"""Training-data pipeline over the documents table.

Each stage is a function of (spark, docs, sf_dir). The first four return the
columns of the documents for the rows they keep; the last returns packed
pieces with their token ids. `run` writes every stage's result under the shared
checkpoint folder before the next one reads it, so a lost executor repeats at
most one stage.

Nulls, empty tables, repeated rows and further columns: as stated by the
operators. Rows that share a doc_id are one document to the near-duplicate
stage, and one of them stays; rows without a doc_id all stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm.common import materialize, read
from tallyline.llm.decontaminate import decontaminate, judged
from tallyline.llm.near_duplicates import near_duplicates
from tallyline.llm.packing import pack_documents
from tallyline.llm.quality import judge
from tallyline.llm.secret_scan import redact, scan


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and whose histograms resemble a language's reference."""
    return judge(docs).where("kept").select("row.*")


def near_duplicate_groups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one with the least doc_id."""
    gone = near_duplicates(docs).where("doc_id <> component_id").select("doc_id").distinct()
    kept = docs.join(gone, "doc_id", "left_anti")
    repeated = materialize(kept.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated")
    if repeated.isEmpty():
        return kept
    one = kept.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return kept.join(repeated, "doc_id", "left_anti").unionByName(one)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark item contaminates."""
    return judged(decontaminate(docs, read(spark, sf_dir, "benchmark"))).where("not contaminated").select("row.*")


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret replaced by a mark; n_chars follows the new text."""
    found = scan(docs)
    changed = F.size("spans") > 0
    new = {"text": F.when(changed, redact()).otherwise(F.col("row.text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(changed, F.length(redact())).otherwise(F.col("row.n_chars")).cast(docs.schema["n_chars"].dataType)
    return found.select(*[new[c].alias(c) if c in new else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their token ids and place in a sequence."""
    return pack_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_duplicate_groups),
    ("benchmark decontamination", benchmark_passages),
    ("secret scan", secrets),
    ("packing", packing),
]

# Divergence, min-max hashing, multi-pattern search and tokenisation are beyond SQL: tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{i}")
    return docs

"""Training documents from raw ones: quality rules, line dedup, near-duplicate join, decontamination, encoding.

Each stage takes the documents that the one before kept and returns the columns of documents, the last
the encoded ones. ``run`` writes each stage's rows to the shared folder and reads them again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from itemflow.llm.decontaminate import remove_spans
from itemflow.llm.jaccard_join import jaccard_components
from itemflow.llm.line_dedup import dedup_documents
from itemflow.llm.line_quality import MIN_WORDS, clean_documents
from itemflow.llm.queries import encoded_digest, tokenizer_path
from itemflow.llm.scratch import stored
from itemflow.llm.sp_encode import encode_documents

#: No SQL expresses the merges of the encoder; tests hold ``run`` against a brute-force version.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that fail the rules go from the text; rejected documents go whole."""
    return clean_documents(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier one go; so do documents of which a fragment is left, by the quality rules' least words."""
    return dedup_documents(docs, MIN_WORDS).select(*[f"`{c}`" for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of 0.8 or more of their 5-word shingles join, the one with the smallest id stays."""
    found = jaccard_components(docs.select("doc_id", "text"), percent=80, size=5)
    return docs.join(found.where("component_id < doc_id").select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of the benchmark are cut out; documents that consist of them by half go."""
    return remove_spans(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of ids and decoded text of each document."""
    return encoded_digest(encode_documents(docs, tokenizer_path("piece_bpe_32k.model")))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("SentencePiece encoding", encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)

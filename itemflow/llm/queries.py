"""The registered queries of the operators, over the whole of their tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import importlib.util
import os

from itemflow.llm.decontaminate import matched_spans
from itemflow.llm.jaccard_join import jaccard_components
from itemflow.llm.language_id import identify, learn_languages
from itemflow.llm.line_dedup import dedup_lines
from itemflow.llm.line_quality import clean_lines
from itemflow.llm.merkle import build_manifest, folded, leaf_hash, proof_hash, proofs
from itemflow.llm.scratch import scratch_path
from itemflow.llm.sharding import balanced_shards
from itemflow.llm.sp_encode import encode_documents
from itemflow.llm.token_align import align_documents
from itemflow.llm.token_counts import count_documents
from itemflow.llm.token_files import read_token_files, write_token_files
from itemflow.llm.toxicity import learn_toxicity, score_toxicity
from itemflow.llm.url_rules import judge_urls

URL_RULES = (
    ("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"),
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """A file of the public vocabularies: in the folder ``ITEMFLOW_TOKENIZERS`` names, else of the installed package."""
    folder = os.environ.get("ITEMFLOW_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    if importlib.util.find_spec("public_tokenizers"):
        import public_tokenizers

        return public_tokenizers.path(name)
    return os.path.join("/opt/tokenizers", name)


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    docs = _table(spark, sf_dir, "documents").select(
        "doc_id", (F.length(data) + 16).cast("long").alias("size"), F.crc32(data).alias("text_crc32"), F.md5(data).alias("group")
    )
    placed = balanced_shards(docs, 40)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_lines(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_lines", "lines_removed", "chars_removed", F.octet_length("clean_text").cast("long").alias("clean_bytes"),
    )


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = matched_spans(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )


def _held_out():
    """A quarter of the documents, by id, from which nothing is learned; a null id is in no part."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    learned = learn_languages(docs.where(~_held_out()))
    return identify(docs.select("doc_id", "text"), learned).select(
        "doc_id", F.coalesce(_held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score", "n_grams"
    )


def encoded_digest(encoded: DataFrame) -> DataFrame:
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"), (F.array_max("stops")).cast("long").alias("n_bytes_spanned"),
    )


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return encoded_digest(encode_documents(docs, tokenizer_path("piece_bpe_32k.model")))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select(
        F.struct("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")).alias("row"), "text"
    )
    counted = count_documents(docs, tokenizer_path("word_bpe_49k.json"), id_col="row")
    last = F.when(F.size("prefix_tokens") > 0, F.element_at("prefix_tokens", -1)).otherwise(0).cast("long")
    return counted.select("row.doc_id", "row.n_bytes", last.alias("n_tokens"), (last > 2048).alias("over_limit"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "lines_removed", F.octet_length(text).cast("long").alias("clean_bytes"), F.crc32(text.cast("binary")).alias("clean_crc32"),
    )


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(_table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = learn_toxicity(docs, _table(spark, sf_dir, "labels").where(~_held_out()))
    return score_toxicity(docs, model).select(
        "doc_id", F.coalesce(_held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


def op10_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(_table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    changed = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    leaves = docs.select("doc_id", "lang", leaf_hash(*fields).alias("leaf"), F.when(changed, leaf_hash(*fields[:4], lowered)).alias("tampered"))
    found = proofs(build_manifest(leaves)).select("doc_id", "leaf", "manifest.*", F.coalesce("tampered", "leaf").alias("claimed"))
    return found.select(
        "doc_id", "leaf", "subroot", "root", proof_hash(F.col("path")).alias("proof_sha256"), folded(F.col("claimed"), F.col("path")).alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    write_token_files(_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), path)
    return read_token_files(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op13_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    aligned = align_documents(docs, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))
    return aligned.documents().select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


QUERIES = {f.__name__: f for f in (op1_sharding, op2_line_quality, op3_decontamination, op4_language_id, op5_sentencepiece, op6_line_dedup, op7_token_counts, op8_jaccard_join, op9_toxicity, op10_url_rules, op11_merkle_manifest, op12_token_files, op13_token_align)}

"""Registered queries of the operators, with the columns their users agreed on."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from msgrisk.llm import (
    decontamination, language_id, language_model, line_dedup, merkle, mixing, ngram_join, oracle, page_text, prefix_trie, suffix_dedup,
    token_cache, topk_search, toxicity,
)
from msgrisk.llm.tables import documents, fold, table
from msgrisk.session import scratch_path

TOKEN_LIMIT = 4096


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model score of every document, learned from nine folds of ten."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = language_model.fit(docs.where(fold("doc_id", 10) != 0), "text")
    scored = language_model.score(model, docs.withColumn("held_out", fold("doc_id", 10) == 0), "text", ("doc_id", "held_out"))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-copy component of every document: 4-word shingles, 85 %."""
    return ngram_join.join(documents(spark, sf_dir), n=4, percent=85)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 50-byte strings that documents of smaller doc_id have."""
    return suffix_dedup.remove_repeats(documents(spark, sf_dir))


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.ToxicityModel:
    """The grammar fitted on labelled rows of two folds of three. Where labels of a row disagree it is toxic."""
    marks = labels.where("toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = docs.select("doc_id", "text").where(fold("doc_id", 3) != 1).join(marks, "doc_id")
    return toxicity.fit(rows, "text", "toxic")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = toxicity_model(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(model, docs)
    predicted = (F.col("score") >= toxicity.THRESHOLD).cast("int")
    return scored.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", predicted.alias("predicted"))


def op5_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every fiftieth document as a query."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return topk_search.search(docs, docs.where("doc_id % 50 = 0"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without later copies of line runs that repeat."""
    cut = line_dedup.dedup(documents(spark, sf_dir).select("doc_id", "text"))
    return cut.select(
        "doc_id", "n_lines", "n_removed", "n_runs", F.length("text").alias("kept_chars"), F.sha2("text", 256).alias("kept_sha256")
    )


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return page_text.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, with the item."""
    return decontamination.find_leaks(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from three folds of four."""
    docs = documents(spark, sf_dir)
    tagger = language_id.fit(docs.where(fold("doc_id", 4) != 2), "text", "lang")
    held_out = docs.select("doc_id", "text", (fold("doc_id", 4) == 2).alias("held_out"))
    return language_id.identify(tagger, held_out)


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of every document that bring each source to its target."""
    mixed = mixing.mix(documents(spark, sf_dir))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proof of every document in a binary manifest by language, checked against the documents with one field altered."""
    # One more than the largest long is still a number here.
    altered_chars = F.col("n_chars").cast("decimal(20,0)") + 1
    row = lambda chars: merkle.leaf([F.col("doc_id"), F.col("source"), F.col("lang"), chars, F.col("text")])
    altered = F.when((F.crc32(F.col("doc_id").cast("string")) % 7 == 0) & F.col("n_chars").isNotNull(), row(altered_chars))
    leaves = documents(spark, sf_dir).select("doc_id", "lang", row(F.col("n_chars")).alias("leaf"), altered.alias("altered"))
    proofs = merkle.manifest(leaves, "leaf", "lang", "doc_id").withColumn("folded_root", merkle.fold(F.coalesce("altered", "leaf"), F.col("path")))
    digests = [merkle.hex_of(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")]
    return proofs.select(
        "doc_id", *digests, merkle.proof_digest(F.col("path")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == merkle.hex_of(F.col("root"))).alias("verified"),
    )


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie over conversations with shared openings."""
    turns = prefix_trie.turns_of(table(spark, sf_dir, "conversations"))
    nodes = prefix_trie.build(*prefix_trie.branch(turns))
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, counted through a cache that starts empty."""
    tokenizer = public_tokenizers.path("piece_bpe_32k.model")
    counted = token_cache.count_tokens(documents(spark, sf_dir), str(tokenizer), scratch_path(spark, "token-cache"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


QUERIES = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_ngram_join": op2_ngram_join,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_toxicity": op4_toxicity,
    "op5_topk_search": op5_topk_search,
    "op6_line_dedup": op6_line_dedup,
    "op7_html_extraction": op7_html_extraction,
    "op8_benchmark_decontamination": op8_benchmark_decontamination,
    "op9_language_id": op9_language_id,
    "op10_source_mixing": op10_source_mixing,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_token_counts": op13_token_counts,
}
ORACLE: dict[str, str] = dict(oracle.BODIES)

"""One query per operator over the whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotledger.llm import bpe, clustering, decontaminate, host_rules, html_text, jaccard, language, mixing, records, repeats, search, toxicity, warc
from slotledger.llm.common import ship

#: Where the public tokenizer files are found, unless a caller names another path.
TOKENIZER = "byte_bpe_50k.json"
WORD_TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_factorization_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_documents(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def op2_template_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op3_rank_order_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language.learn(docs.filter(~language.held_out())))


def op4_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = host_rules.judge(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op6_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.without_repeats(table(spark, sf_dir, "documents"))


def op7_hierarchical_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.each_copy(mixing.select_documents(table(spark, sf_dir, "documents"))).select("doc_id", "domain", "lang", "source", "n_tokens", "epoch")


def op8_binary_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.encode_and_read_back(table(spark, sf_dir, "documents"), tokenizer_path())


def op9_warc_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_and_read_back(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_partition_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicate_groups(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op11_incremental_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.digest(clustering.cluster(table(spark, sf_dir, "embeddings")))


def op12_merge_queue_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path(WORD_TOKENIZER)
    return bpe.digest(bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path), path))


def op13_geometric_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_factorization_toxicity,
        op2_template_removal,
        op3_rank_order_language,
        op4_host_rules,
        op5_positional_index,
        op6_recompression,
        op7_hierarchical_mixing,
        op8_binary_records,
        op9_warc_chain,
        op10_partition_jaccard,
        op11_incremental_centroids,
        op12_merge_queue_bpe,
        op13_geometric_blocks,
    )
}

"""From raw documents to a tokenized training set: five stages, each a job of its own over all that the last one kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from slotledger.llm import decontaminate, jaccard, language, mixing, records
from slotledger.llm.common import new_folder, ship, stored
from slotledger.llm.queries import tokenizer_path


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told, which becomes their `lang`; profiles are learned from those that are not held out.

    Texts that are null or have no letter go. Equal rows and other columns stay.
    """
    ship(spark)
    return language.with_known_language(docs, language.learn(docs.filter(~language.held_out())))


#: Near duplicates share so many of their shingles of so many words. The contract of op10 (three words, 0.9) is the query's own.
DUPLICATE_WORDS, DUPLICATE_PART = 5, (80, 100)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest doc_id; of equal rows one.

    Documents without words are in no group and stay.
    """
    ship(spark)
    return jaccard.one_of_each_group(docs, DUPLICATE_WORDS, DUPLICATE_PART)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item; texts without words stay."""
    ship(spark)
    return decontaminate.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the budget of their domain, language and source takes them; null levels are values of their own."""
    ship(spark)
    return mixing.mixed(docs)


#: Pieces of text that an encoding worker remembers; fewer than op8, since the stages before have filled the executors' heap.
PIECES = 300_000


def token_records(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids written as binary records and read back: doc_id, start, n_tokens, ids_crc32.

    A row for each row, repeated ones too, in ascending doc_id; an empty text is the end id alone.
    """
    ship(spark)
    return records.encode_and_read_back(docs, tokenizer_path(), new_folder(spark, "corpus"), PIECES)


STAGES = [
    ("language ID", known_language),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", source_mixing),
    ("token-ID / binary output", token_records),
]

#: Tokenization cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to the documents; the output of each is written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-').replace('/', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""The corpus pipeline: toxicity, exact copies, near copies, source mix, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millwright.llm import exact_dedup, mixing, ngram_join, packing, toxicity
from millwright.llm.common import scratch_path, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half, by a model fitted on the labels that apply to them.

    A null or empty text scores like any text without words, repeated rows stay or
    go together, a null doc_id has no label; further columns pass; an empty table
    stays empty.
    """
    return toxicity.clean_documents(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts the one with the smallest doc_id.

    Null texts count as empty and so are copies of each other; a null doc_id comes
    after all others; of rows that tie one stays; further columns pass; an empty
    table stays empty.
    """
    return exact_dedup.deduplicated(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by similar shingles the one with the smallest doc_id.

    Null and empty texts link with nothing and stay, as do rows without a doc_id;
    rows that repeat the kept doc_id all stay; further columns pass; an empty
    table stays empty.
    """
    return ngram_join.one_per_component(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often, and as far, as the mix of sources takes them, in the schedule's order.

    A null source is a source of its own; null and empty texts hold no words to
    take and are left out; repeated rows count one by one; further columns pass,
    n_chars being that of the text taken; an empty table stays empty.
    """
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences; ids are replaced by their CRC-32.

    A null or empty text is one end id; rows that repeat are packed one by one, a
    null doc_id stays null; other columns are not read; an empty table gives no
    pieces.
    """
    return packing.digest(packing.pack(docs))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("source mix", mix_sources),
    ("packing", pack),
]

#: The toxicity model and the tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"stage{k}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

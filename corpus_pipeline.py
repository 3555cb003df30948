"""The documents made ready for training, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from firmscope.llm import mixing, packing, simhash, substring, toxicity
from firmscope.shared import small_batches, stored
from firmscope.llm.ship import ship


def _ready(spark: SparkSession) -> None:
    ship(spark)
    small_batches(spark)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, learned from their labels, does not reject."""
    _ready(spark)
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near SimHash fingerprints."""
    _ready(spark)
    return simhash.deduplicated(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the words of passages that stand earlier."""
    _ready(spark)
    return substring.without_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix's documents: a row for each time that words of a document are taken."""
    _ready(spark)
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's pieces and their places in sequences."""
    _ready(spark)
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_dedup", drop_near_duplicates),
    ("substring_dedup", cut_repeats),
    ("source_mix", mix_sources),
    ("packing", pack_sequences),
]

#: The stages learn, hash and tokenize, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each one's rows written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

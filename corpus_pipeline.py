"""From raw documents to token shards: the stages of the corpus pipeline, in order.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from treelab.llm import bagminhash, decontamination, mixing, tokens, toxicity
from treelab.llm.shared import settle, settle_stage, staged, table

#: The mixture is as large as its input; under-weighted sources are cut to a token prefix, scarce ones are read twice at most.
MIXTURE = {"budget_share": 1.0, "max_epochs": 2, "seed": 23,
           "weights": {"domain": {"dom0": 3, "dom1": 2, "dom2": 2, "dom3": 2}, "lang": {"en": 4, "de": 2, "fr": 2, "es": 2}, "source": {"src0": 4}}}
END_ID = 2


@staged
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the classifier chain, trained on the labelled ones among them, rejects."""
    return toxicity.without_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


@staged
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return bagminhash.without_near_duplicates(docs)


@staged
def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a benchmark item."""
    return decontamination.without_benchmark(docs, table(spark, sf_dir, "benchmark"))


@staged
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as the mixture reads them; a document is there once per pass that reaches it."""
    return mixing.mixed(docs, **MIXTURE)


@staged
def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards below the shared folder; a row per document, read back from them."""
    return tokens.token_table(docs, tokens.public_path("word_bpe_49k.json"), END_ID)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("mixing", mix_sources),
    ("token_shards", write_tokens),
]
#: Trained models, signatures and file formats are beyond SQL; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; each result is written to the shared folder and read again by the next, which drops what it does not read."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle_stage(stage(spark, docs, sf_dir), f"stage-{name}")
    name, stage = STAGES[-1]
    return settle(stage(spark, docs, sf_dir), f"stage-{name}")

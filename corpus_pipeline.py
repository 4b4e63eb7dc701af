"""The corpus pipeline: raw documents to token digests, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from opsframe.llm.common import prepare, stored, table
from opsframe.llm.cotraining import good_documents
from opsframe.llm.decontaminate import clean_documents
from opsframe.llm.piece_encoding import piece_digests
from opsframe.llm.queries import PIECE_VOCABULARY, SURROGATE_KEY
from opsframe.llm.simhash import one_of_each
from opsframe.llm.surrogates import without_personal_data


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the co-trained classifier keeps."""
    return good_documents(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the lowest id of each component of near-duplicates."""
    return one_of_each(docs, width=3, max_bits=3)


def decontaminated(
    spark: SparkSession, docs: DataFrame, sf_dir: str
) -> DataFrame:
    """The documents that share no passage with the benchmark."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates in place of personal data."""
    return without_personal_data(docs, SURROGATE_KEY)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digests of each document's ids and of what they decode to."""
    return piece_digests(docs, PIECE_VOCABULARY, check="runs")


def _stage(run):
    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return run(prepare(spark), docs, sf_dir)

    return stage


STAGES = [
    ("quality-classifier", _stage(quality)),
    ("simhash-near-dedup", _stage(near_dedup)),
    ("decontamination", _stage(decontaminated)),
    ("surrogates", _stage(private)),
    ("piece-encoding", _stage(tokens)),
]

# No stage of this pipeline can be said in SQL as a whole: it trains a model
# and runs a tokenizer. tests/llm holds it against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs

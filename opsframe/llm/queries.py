"""One registered query per operator, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from opsframe.llm.chat_tree import format_conversations, read_back, with_probe
from opsframe.llm.common import prepare, table
from opsframe.llm.cotraining import SCORES, score, train
from opsframe.llm.decontaminate import contamination
from opsframe.llm.licences import fit, licences
from opsframe.llm.merkle import manifest
from opsframe.llm.oracles import ORACLES
from opsframe.llm.piece_encoding import piece_digests
from opsframe.llm.quality_rules import quality_rules
from opsframe.llm.sharding import shard_rows
from opsframe.llm.simhash import near_duplicates
from opsframe.llm.surrogates import replace_entities
from opsframe.llm.token_file import read_documents, write_token_files
from opsframe.llm.whitening import whiten
from opsframe.llm.word_bpe import bpe_digests
from opsframe.session import scratch_path

SHARDS = 40
END_ID = 2
# Rows of a batch where words are looked up: the more rows, the more of their
# words are the same and looked up once.
LARGE_BATCH = 4000
# Of a real corpus the key must be secret; this one makes results repeatable.
SURROGATE_KEY = "a key for tests and demonstrations"
BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECE_VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document from co-trained views."""
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", *SCORES)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose fingerprints are nearly equal."""
    return near_duplicates(table(spark, sf_dir, "documents"))


def op3_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place and checksum, read back from token files."""
    path = scratch_path(spark, "tokens")
    docs = table(spark, sf_dir, "documents")
    prepare(spark, rows=6000)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    write_token_files(docs, path, BYTE_VOCABULARY, END_ID, parts)
    return read_documents(spark, path)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each document shares with the benchmark items."""
    found = contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.drop("items", "spans")


def op5_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence families that the paragraphs of every document declare."""
    docs = table(spark, sf_dir, "documents")
    return licences(docs, fit(docs))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 40 shards by the hash of its id."""
    return shard_rows(table(spark, sf_dir, "documents"), SHARDS)


def op7_chat_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every conversation, read back from the prefix tree."""
    rows = with_probe(spark, table(spark, sf_dir, "conversations"))
    return read_back(format_conversations(rows, BYTE_VOCABULARY), BYTE_VOCABULARY)


def op8_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and the text decoded from them, as digests."""
    docs = table(spark, sf_dir, "documents")
    prepare(spark, rows=LARGE_BATCH)
    return piece_digests(
        docs, PIECE_VOCABULARY, check="runs", kept_runs=600_000
    )


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts of every document and the verdict of the rules."""
    return quality_rules(table(spark, sf_dir, "documents"))


def op10_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced."""
    return replace_entities(
        table(spark, sf_dir, "documents"), SURROGATE_KEY
    ).select("doc_id", "text", "n_replaced", "kinds")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root, proof and tamper check of every document."""
    return manifest(table(spark, sf_dir, "documents")).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
        "verified",
    )


def op12_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document under a word-level BPE."""
    docs = table(spark, sf_dir, "documents")
    prepare(spark, rows=LARGE_BATCH)
    return bpe_digests(docs, WORD_VOCABULARY)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every clean embedding whitened on its 32 leading components."""
    return whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_simhash": op2_simhash,
    "op3_token_file": op3_token_file,
    "op4_decontamination": op4_decontamination,
    "op5_licences": op5_licences,
    "op6_sharding": op6_sharding,
    "op7_chat_tree": op7_chat_tree,
    "op8_piece_encoding": op8_piece_encoding,
    "op9_quality_rules": op9_quality_rules,
    "op10_surrogates": op10_surrogates,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_word_bpe": op12_word_bpe,
    "op13_whitening": op13_whitening,
}

__all__ = ["ORACLES", "QUERIES"]

"""A training corpus from `documents`, stage by stage; each stage is written and read again before the next."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from logsieve.llm import chunking, jaccard, language, mixing, pieces
from logsieve.llm.common import stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in none of the labelled languages go."""
    return language.kept_documents(docs)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of 0.8 or more connect, the one with the smallest id stays."""
    return jaccard.representatives(docs)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has are taken out; a document that was nothing else goes."""
    return chunking.without_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of each source come as often, or as far, as its share of the mix says."""
    return mixing.mixed_documents(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document of the mix, with an end id."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.encode(docs, model, output="ids", keys=("doc_id", "lang", "source"), block_chars=8_000_000)


STAGES: list[tuple[str, Stage]] = [
    ("language", keep_known_languages),
    ("near copies", keep_one_of_near_copies),
    ("repeated passages", drop_repeated_passages),
    ("mixing", mix_sources),
    ("encoding", encode_pieces),
]

#: The segmentation of a tokenizer can't be said in SQL; the tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stored(docs, "stage")
    return docs

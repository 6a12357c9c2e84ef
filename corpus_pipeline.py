"""The corpus pipeline: stages over `documents`, each written and read again before the next.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of `documents`. Learned rules take the labels of the same folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wicketflow.llm import decision_list, exact_dedup, mixing, sentence_lattice, simhash
from wicketflow.llm.common import table
from wicketflow.scratch import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the learned rules keep."""
    return decision_list.keep_good(docs, table(spark, sf_dir, "labels"))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_duplicates(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates, that with the smallest id."""
    return simhash.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids and scores of the n best segmentations of each document of the mix, the ids of the best read back as text."""
    import public_tokenizers

    return sentence_lattice.encode_nbest(docs, public_tokenizers.path("piece_bpe_32k.model"), alternatives=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_duplicates),
    ("simhash_near_dedup", near_duplicates),
    ("mix_sources", mix_sources),
    ("encode_pieces", encode_pieces),
]

#: Learned rules and fingerprints have no SQL form; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stage(spark, docs)
    return docs

"""A training corpus from raw documents: filter, deduplicate, mix and pack.

Every stage takes what its predecessor kept, with the columns of `documents`; the
last returns the pieces of the packed sequences. Between stages the documents are
one table on shared storage, so a lost executor costs work of one stage only.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tripfold.llm import minhash_dedup, mixing, packing, quality_cnn, quality_rules
from tripfold.llm.ordered import kept
from tripfold.llm.workers import share_path

MIX = mixing.Mix()  # production parameters
SEQUENCE_IDS, END_ID = 2048, 1
TOKENIZER = "word_bpe_49k.json"


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the network, learned from this corpus' labels, scores below its threshold.

    Null and empty texts are scored like others, very long ones as a whole; repeated rows stay or go
    together. Without labels of both kinds, and from an empty table, nothing is dropped.
    """
    share_path(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_cnn.keep_good(docs, quality_cnn.learn(docs, labels))


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail the threshold table: also null, empty and wordless texts. Very long texts are counted as a whole."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of every group of near-duplicates: the least doc_id, equal rows once; all documents without words stay."""
    share_path(spark)
    return minhash_dedup.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draws each source to its weight; a document comes once for each pass.

    Null is a source like others; sources without words have no weight. Ties are cut row by row.
    """
    return mixing.mixed_documents(docs, MIX)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences. Null and empty texts are a piece with the end id; very long texts are cut."""
    share_path(spark)
    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER), SEQUENCE_IDS, END_ID)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_classifier),
    ("quality rules", rules),
    ("near-duplicates", near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: The first stage is a trained network, which SQL cannot express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the whole table of documents; none for an empty one. Further columns travel along to the last stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

"""The registered queries of this subpackage: thin views on its operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tripfold.llm import html_extract, lz_fingerprint, minhash_dedup, mixing, ordered, packing, position_index, quality_cnn, quality_rules, sharding, token_counts, token_files, vector_codes, whitening
from tripfold.llm.workers import share_path
from tripfold.sources.paths import scratch_root

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[SparkSession, str], DataFrame]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        share_path(spark)
        return build(spark, sf_dir)

    QUERIES[build.__name__] = run
    return build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_sharding(spark, sf_dir):
    return sharding.assign_shards(table(spark, sf_dir, "documents"), 24)


@query
def op2_minhash_dedup(spark, sf_dir):
    found = minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query
def op3_quality_rules(spark, sf_dir):
    return quality_rules.judge(table(spark, sf_dir, "documents"))


@query
def op4_lz_fingerprint(spark, sf_dir):
    return lz_fingerprint.fingerprint_documents(table(spark, sf_dir, "documents"))


@query
def op5_packing(spark, sf_dir):
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack_documents(table(spark, sf_dir, "documents"), path, limit=2048, end_id=1)


@query
def op6_html_extract(spark, sf_dir):
    return html_extract.extract_pages(table(spark, sf_dir, "pages"))


@query
def op7_quality_cnn(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return quality_cnn.score_documents(docs, quality_cnn.learn(docs, table(spark, sf_dir, "labels")))


@query
def op8_mixing(spark, sf_dir):
    return mixing.mixture(table(spark, sf_dir, "documents"))


@query
def op9_token_counts(spark, sf_dir):
    path = public_tokenizers.path("piece_bpe_32k.model")
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), path, limit=4096)


@query
def op10_token_files(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_50k.json")
    folder = f"{scratch_root(spark)}/ids"
    files = ordered.kept(token_files.write_token_files(table(spark, sf_dir, "documents"), folder, path, end_id=0))
    return token_files.read_token_files(spark, folder, files)


@query
def op11_decontamination(spark, sf_dir):
    return position_index.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)


@query
def op12_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=16)


@query
def op13_vector_codes(spark, sf_dir):
    return vector_codes.quantize(table(spark, sf_dir, "embeddings"), parts=16, entries=64, rounds=2)

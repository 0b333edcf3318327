"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfcast.llm import (
    decontaminate,
    language,
    licenses,
    neighbours,
    packing,
    pii,
    quality,
    resampling,
    secrets,
    sharding,
    simhash,
    toxicity,
    variants,
)
from shelfcast.llm.common import ready, remainder
from shelfcast.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(ready(spark), sf_dir)
    QUERIES[fn.__name__] = run
    return run


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@query
def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(documents(spark, sf_dir), tokenizer_path())
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@query
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", "fingerprint", "component_id")


@query
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))


@query
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(documents(spark, sf_dir))


@query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(documents(spark, sf_dir), read_table(spark, sf_dir, "labels"),
                             remainder("doc_id", 4) == 2)


@query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(documents(spark, sf_dir), read_table(spark, sf_dir, "labels"),
                            remainder("doc_id", 5) == 0)


@query
def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(documents(spark, sf_dir))


@query
def op7_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(documents(spark, sf_dir))


@query
def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.classify(documents(spark, sf_dir), remainder("doc_id", 3) == 1)


@query
def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(read_table(spark, sf_dir, "embeddings"))


@query
def op11_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.report(documents(spark, sf_dir))


@query
def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))


@query
def op13_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.grouped(documents(spark, sf_dir))


def all_queries() -> dict:
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    return dict(ORACLE)

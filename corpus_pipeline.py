"""The corpus pipeline: five stages from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept
and returns a DataFrame, which is written as Parquet and read again as the next
stage's documents. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import decontaminate, packing, pii, simhash, toxicity
from shelfcast.llm.common import fresh, ready, remainder, written
from shelfcast.llm.queries import tokenizer_path
from shelfcast.sources.tables import read_table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave out the documents that the toxicity classifier rejects.

    It learns from the given documents that have a label. Null and empty texts
    score as texts without features; repeated rows fare alike.
    """
    ready(spark)
    labels = read_table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels, F.coalesce(remainder("doc_id", 4) != 2, F.lit(False)))
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col("text"))
    return toxicity.score(inner, model, "doc").filter("predicted = 0").select("doc.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each SimHash group: the least id, then the least content hash.

    Null and empty texts share fingerprint zero and are one group; a null id
    comes last; of rows that repeat in every column one stays.
    """
    ready(spark)
    key = fresh(docs, "content_hash")
    keyed = docs.withColumn(key, F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]))
    found = written(simhash.near_duplicates(keyed, keep=(key,)).select("doc_id", "root", key), "groups")
    best = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col(key)))
    first = found.groupBy("root").agg(best.alias("b")).select(
        F.col("b.doc_id").alias("_id"), F.col(f"b.{key}").alias("_key")).distinct()
    kept = keyed.join(first, keyed["doc_id"].eqNullSafe(F.col("_id")) & (keyed[key] == F.col("_key")), "left_semi")
    if found.count() != found.select("doc_id", key).distinct().count():
        kept = kept.dropDuplicates(["doc_id", key])
    return kept.select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave out the documents that contain a benchmark item; null and wordless texts contain none."""
    ready(spark)
    return decontaminate.decontaminated(docs, read_table(spark, sf_dir, "benchmark"))


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data, generalise or remove the terms that disclose it; every document stays."""
    ready(spark)
    clean = pii.sanitise(docs)
    if "n_chars" in clean.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack all remaining documents into sequences of at most 4096 tokens: one row per piece."""
    ready(spark)
    return packing.pack_documents(docs, tokenizer_path()).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("pii", sanitise),
    ("packing", pack),
]

#: Trained classifiers and token ids cannot be written in SQL; tests/llm/test_pipeline.py has the plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; every result but the last is written and reread."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

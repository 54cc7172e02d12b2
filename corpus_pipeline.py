"""Corpus pipeline: language ID, near-dedup, decontamination, mixing, sharding.

Each stage takes the documents its predecessor kept and returns those it keeps
with the columns of documents; the last adds shard and slot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cartoscope.llm import decontam, langid, mixing, sharding, simhash
from cartoscope.llm.storage import forget, store

#: A text whose nearest profile leaves less than this share of the greatest distance is in no known language.
LEAST_LANGUAGE_SCORE = 0.1


#: Text that goes to a Python worker at once; Spark's default is 64 MB, held by the JVM and the worker of every task.
BATCH = {"spark.sql.execution.arrow.maxBytesPerBatch": "8m", "spark.sql.execution.arrow.maxRecordsPerBatch": "2000"}


def _bounded(spark: SparkSession) -> None:
    """Small batches for the session that the pipeline runs in, as its stages are evaluated later."""
    for name, value in BATCH.items():
        spark.conf.set(name, value)


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; null, letterless and unlike texts go.

    The bound costs no clean document of the check tables (clean documents left
    alone: 1.00). Here as in the other stages an empty table gives an empty
    one, repeated rows fare alike, and the columns of documents stay whatever
    their names.
    """
    _bounded(spark)
    profiles = langid.fit_profiles(langid.learnable(docs))
    found = langid.identify(docs, profiles)
    return found.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE_SCORE)).select(*docs.columns)


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group: the one with the least doc_id.

    A null doc_id comes after all others; of rows that repeat a doc_id, the one
    with the least text hash stays.
    """
    _bounded(spark)
    return simhash.one_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    _bounded(spark)
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), torn=True)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that sources, languages and topics have their target weights."""
    return mixing.mixed(docs).where("sampled").select(*docs.columns)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with shard (0 to 15) and slot."""
    return sharding.shard(docs)


STAGES = [
    ("language ID", identified),
    ("SimHash near-dedup", deduplicated),
    ("benchmark decontamination", decontaminated),
    ("mixing", mixed),
    ("sharding", sharded),
]

#: Profiles, fingerprint components and raking have no SQL form: tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's table is written, and its predecessor's then deleted."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if before is not None:
            forget(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)

"""A training corpus from ``documents``: five stages, each written and read again."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from tallystream.llm.decontaminate import decontaminate
from tallystream.llm.mixing import mix_documents
from tallystream.llm.pii_crf import redact
from tallystream.llm.prob_minhash import near_distinct
from tallystream.llm.queries import ship
from tallystream.llm.repetition import keep_by_rules
from tallystream.llm.texts import table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules keep."""
    ship(spark)
    return keep_by_rules(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates: that of the least doc_id."""
    ship(spark)
    return near_distinct(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of benchmark items cut out; documents that are mostly such go."""
    ship(spark)
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data masked."""
    ship(spark)
    return redact(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix reads them, numbered in ``repetition``."""
    return mix_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("near dedup", near_dedup),
    ("decontamination", decontamination),
    ("pii", pii),
    ("source mix", source_mix),
]

# The suffix automaton, the random field and the signatures have no SQL form.
ORACLE_SQL = None


def _shared_folder(spark: SparkSession) -> str:
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="run-")
    return f"{shared.rstrip('/')}/corpus-{uuid.uuid4().hex}"


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written, then the next one's input."""
    folder, docs = _shared_folder(spark), table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        path = os.path.join(folder, f"{k}.parquet")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

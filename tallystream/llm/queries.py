"""Registered queries of this package, each over its whole table."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystream.llm.decontaminate import contamination
from tallystream.llm.exact_copies import exact_copies
from tallystream.llm.filter_audit import filter_audit
from tallystream.llm.license_join import license_scan
from tallystream.llm.main_text import main_texts
from tallystream.llm.mixing import mix_plan
from tallystream.llm.pii_crf import personal_data
from tallystream.llm.prob_minhash import near_classes
from tallystream.llm.quality_classifier import quality_scores
from tallystream.llm.repetition import repetition_rules
from tallystream.llm.spelling import spelling_variants
from tallystream.llm.texts import table
from tallystream.llm.token_count import token_counts
from tallystream.llm.url_cascade import url_verdicts

# The rules of op6, as (verdict, host and start of path).
URL_RULES = (
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
)
TOKENIZER = "byte_bpe_50k.json"
BATCH_ROWS = 1024


def ship(spark: SparkSession) -> None:
    """Sends this package to the workers, once per context, and bounds their batches.

    Texts may be long: batches of the default number of rows would need much memory.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    context = spark.sparkContext
    if getattr(context, "_tallystream_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    archive = os.path.join(tempfile.mkdtemp(prefix="run-"), "tallystream.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(os.path.join(top, "tallystream")):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, top))
    context.addPyFile(archive)
    context._tallystream_shipped = True


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", (F.col("n_hit") > 0).alias("contaminated")
    )


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return license_scan(table(spark, sf_dir, "documents"))


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return main_texts(table(spark, sf_dir, "pages"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return repetition_rules(table(spark, sf_dir, "documents"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return url_verdicts(table(spark, sf_dir, "pages"), URL_RULES)


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return personal_data(table(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ship(spark)
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    found = near_classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "n_copies")


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_plan(table(spark, sf_dir, "documents"))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_copies(table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return spelling_variants(table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_classifier,
        op2_decontamination,
        op3_license_scan,
        op4_main_text,
        op5_quality_rules,
        op6_url_filter,
        op7_pii,
        op8_token_counts,
        op9_near_duplicates,
        op10_source_mix,
        op11_exact_dedup,
        op12_spelling_variants,
        op13_filter_audit,
    )
}

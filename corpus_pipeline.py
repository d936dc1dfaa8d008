"""Corpus pipeline over ``documents``: language ID, exact dedup, SimHash near-dedup, source mixing, packing.

Each stage calls one operator of ``gripe.llm`` and works on all that the stage
before it kept.  Stage outputs are written to the shared folder and read back.

Rows are matched to decisions by id and text, so ids that repeat with
different texts do no harm; of rows equal in both, the dedup stage keeps one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gripe.llm import exact_dedup, language_id, mixing, packing, simhash
from gripe.llm.common import stage_table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an identifiable language go: no letter, or nothing to learn from.

    A close decision between two languages is a flag of the operator, no reason to go."""
    model = language_id.train(docs.filter(~language_id.held_out("doc_id")))
    found = language_id.identify(docs, model, keep=True)
    return found.filter(F.col(found.columns[-3]) != "und").select(*docs.columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest id stays."""
    return exact_dedup.keep_first(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row with the smallest id stays."""
    return simhash.keep_first(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.apply_mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in the training sequences."""
    return packing.pack(docs, digest=True)


STAGES = [
    ("language ID", language),
    ("exact dedup", exact),
    ("SimHash near-dedup", near),
    ("mixing sources", mix),
    ("best-fit packing", pack),
]

#: Language codes, fingerprints and tokens have no SQL form; tests/llm hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stage_table(docs, f"pipeline-{k}")
    return docs

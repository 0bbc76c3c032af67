"""From raw documents to packed training sequences: five stages, each one an
operator of ``churnlake.llm`` applied to all that the stage before it kept.

Every stage function takes (spark, docs, sf_dir); all but the last return the
columns of ``documents``.  ``run`` writes each stage's rows as Parquet under
the shared folder and rereads them as the next one's documents.

The near-duplicate stage goes by rows, not by doc_id: rows without doc_id or
with a repeated one are documents of their own, and a row is dropped only for
an earlier row of its own group.
"""

from __future__ import annotations

import public_tokenizers

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlake.llm import decontam, packing, pii, quality, simhash
from churnlake.llm.common import table
from churnlake.session import materialize

#: SQL cannot express packing (or fingerprints); tests hold the stages against brute force.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component stays: the first by doc_id (null last), hash
    of the text and row number.  The number is written with the rows, so that
    it names the same row in every pass."""
    row = "_row"
    while row in docs.columns:
        row += "_"
    rows = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "numbered_rows")
    name = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", F.xxhash64("text").alias("hash"), F.col(row).alias("row"))
    found = simhash.near_duplicates(rows.select(name.alias("name"), "text"), "name")      # a component has the name of its first row
    extra = found.filter(F.col("name.row") != F.col("component_id.row")).select(F.col("name.row").alias(row))
    return rows.join(extra, row, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.find_benchmark(docs, table(spark, sf_dir, "benchmark"), keep=True)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs

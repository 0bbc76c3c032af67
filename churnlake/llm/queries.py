"""Queries of the training-data operators: the contract's columns on whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from . import align, chat, decontam, html_crf, langid, oracles, packing, pii, quality, simhash, spelling, token_files, topk, url_reputation
from .common import table

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn
    return deco


@query("op1_pii")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


@query("op2_url_reputation", oracles.OP2)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = url_reputation.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))
    return got.select("page_id", "host", "path", "rule", "verdict", F.round(F.col("bad_rate") * 1e6).cast("long").alias("bad_rate_ppm"),
                      F.round(F.col("bound") * 1e6).cast("long").alias("bound_ppm"))


@query("op3_token_files")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), drop_space=True, end_id=2)


@query("op4_decontamination", oracles.OP4)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = decontam.find_benchmark(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return got.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


@query("op5_simhash")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return got.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op6_quality_rules")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


#: The turns that the contract adds to the conversations.
_EXTRA_TURNS = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


@query("op7_chat_format", oracles.OP7)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame(_EXTRA_TURNS, "conv_id long, turn long, role string, text string")
    return chat.format_conversations(chat.events_of_turns(turns.unionByName(more)))


@query("op8_best_fit_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=0)


@query("op9_html_extraction")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_crf.extract(table(spark, sf_dir, "pages"))


@query("op10_language_id")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


@query("op11_token_alignment")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.report(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


@query("op12_top_k", oracles.OP12)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0))


@query("op13_spelling")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL

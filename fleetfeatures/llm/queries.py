"""The registered queries of these operators and their check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fleetfeatures.llm import chat, exactdedup, html, linededup, minhash, mixing, mtree, negatives, packing, phrases, quality, suffix, tokencounts
from fleetfeatures.llm.common import shared_path, table, written
from fleetfeatures.llm.tokens import tokenizer_file

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function
    return add


@_register("op1_html_extraction")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return html.extract_pages(table(spark, folder, "pages"))


@_register("op2_source_mixing", mixing.SQL)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"), table(spark, folder, "labels"))


@_register("op3_token_counts")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return tokencounts.maintained_counts(table(spark, folder, "documents"), shared_path(spark))


@_register("op4_quality_rules", quality.SQL)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_report(table(spark, folder, "documents"))


@_register("op5_long_repeats")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return suffix.repeat_report(table(spark, folder, "documents"))


@_register("op6_minhash_near_dedup")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.class_report(table(spark, folder, "documents"))


@_register("op7_exact_top_k", mtree.SQL)
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return mtree.top_k(table(spark, folder, "embeddings"))


@_register("op8_best_fit_packing")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), tokenizer_file("word_bpe_49k.json"))


@_register("op9_chat_formatting", chat.SQL)
def op9(spark: SparkSession, folder: str) -> DataFrame:
    file = tokenizer_file("byte_bpe_50k.tiktoken")
    turns = chat.with_probe(spark, table(spark, folder, "conversations"))
    return chat.digests(written(chat.build_packs(turns, file)), file)


@_register("op10_line_dedup", linededup.SQL)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return linededup.line_report(table(spark, folder, "documents"))


@_register("op11_hard_negatives", negatives.SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return negatives.hard_negatives(table(spark, folder, "embeddings"))


@_register("op12_phrase_collocations", phrases.SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents"))


@_register("op13_exact_dedup", exactdedup.SQL)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return exactdedup.duplicate_report(table(spark, folder, "documents"))

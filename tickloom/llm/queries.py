"""Queries opN_<name> over the corpus tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import language
from tickloom.llm.decontaminate import PositionalIndex
from tickloom.llm.line_dedup import drop_common_lines
from tickloom.llm.ngram_join import JaccardJoin
from tickloom.llm.ngram_resampling import resample
from tickloom.llm.packing import pack
from tickloom.llm.ranked_search import search
from tickloom.llm.runtime import table
from tickloom.llm.secrets import KINDS, scan, span_text
from tickloom.llm.sql import SQL
from tickloom.llm.substring_dedup import remove_repeats
from tickloom.llm.token_counts import count_tokens
from tickloom.llm.toxicity import held_out, score, train
from tickloom.llm.topk_search import top_k
from tickloom.llm.url_filter import judge


def op1_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    found = scan(table(spark, folder, "documents").select("doc_id", "text"))
    base = F.filter("secrets", lambda s: s["kind"] < 3)

    def count(kind: str) -> Column:
        return F.size(F.filter("secrets", lambda s: s["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, KINDS[:3]), F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("secrets")).alias("spans"))


def op2_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    found = JaccardJoin(table(spark, folder, "documents")).components()
    return found.select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def op4_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    judged = PositionalIndex(table(spark, folder, "documents"), table(spark, folder, "benchmark")).judged()
    return judged.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    model = train(documents, table(spark, folder, "labels"), ~held_out(F.col("doc_id")))
    return score(documents, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text", "lang")
    model = language.train(documents, ~language.held_out(F.col("doc_id")))
    return language.label(documents, model, with_spans=False).select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


#: The rules of the url filter's query.
URL_RULES = (("com/en/", "block"), ("example.com/en/7", "allow"), ("net/de/", "allow"), ("example.net/de/8", "block"), ("org/es/", "block"))


def op6_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "rule string, verdict string")
    return judge(table(spark, folder, "pages"), rules)


def op7_topk_search(spark: SparkSession, folder: str) -> DataFrame:
    return top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"))


def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return count_tokens(table(spark, folder, "documents"))


def op10_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(table(spark, folder, "documents"), with_text=False).drop("kept")


def op11_target_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return resample(table(spark, folder, "documents"), table(spark, folder, "benchmark")).drop("n_words")


def op12_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = drop_common_lines(table(spark, folder, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op13_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_secret_scans": op1_secret_scans, "op4_benchmark_decontamination": op4_benchmark_decontamination, "op2_ngram_join": op2_ngram_join, "op3_toxicity": op3_toxicity, "op6_url_filters": op6_url_filters, "op7_topk_search": op7_topk_search, "op5_language_id": op5_language_id, "op9_token_counts": op9_token_counts, "op8_packing": op8_packing, "op10_substring_dedup": op10_substring_dedup, "op11_target_resampling": op11_target_resampling, "op12_line_dedup": op12_line_dedup, "op13_ranked_search": op13_ranked_search}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)

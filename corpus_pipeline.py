"""The corpus pipeline: toxicity, near duplicates, decontamination, secrets, packing.

Each stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and
returns a DataFrame; all but the last return the columns of ``docs``, whatever
their names: columns other than doc_id and text go under names of our own
meanwhile.  ``run`` writes each stage's rows as Parquet to the shared folder,
hands the reread rows on and deletes what the run's stage needed meanwhile.

Edge cases: rows are judged one by one, by id and text, also where ids are
missing or repeat.  Of rows that repeat id and text one stays, unless both are
missing.  In a group of near duplicates a row with the smallest id stays; if
none has an id, one of them does.  Null texts are kept as they are; a very long
text is one text.  An empty table passes through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import toxicity as toxic
from tickloom.llm.decontaminate import PositionalIndex
from tickloom.llm.ngram_join import JaccardJoin
from tickloom.llm.packing import pack
from tickloom.llm.runtime import once, table, without
from tickloom.llm.secrets import redacted, scan
from tickloom.storage import scratch, stored, sweep

#: The hash of id and text that tells rows apart, as in JaccardJoin and PositionalIndex.
ROW = "__row__"


def hidden(docs: DataFrame) -> DataFrame:
    """The columns other than doc_id and text under names that no operator uses."""
    return docs.toDF(*(c if c in ("doc_id", "text") else f"__own_{i}__" for i, c in enumerate(docs.columns)))


def without_rows(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose hash isn't in the one column of ``rows``."""
    own = hidden(docs)
    marked = own.withColumn(ROW, F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")))
    return without(marked, rows.toDF(ROW), ROW).select(own.columns).toDF(*docs.columns)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the model, learnt from ``labels``, rejects."""
    own = hidden(docs)
    model = toxic.train(own.select("doc_id", "text"), table(spark, sf_dir, "labels"), ~toxic.held_out(F.col("doc_id")))
    return toxic.score(own, model).where("predicted = 0").select(own.columns).toDF(*docs.columns)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates, the one with the smallest id, once."""
    found = stored(JaccardJoin(docs.select("doc_id", "text")).components(), "near-duplicates")
    others = found.where("doc_id <> component_id or doc_id is null and component_id is not null").select("row")
    # groups in which nothing has an id
    nameless = found.where("component is not null and component_id is null").select("component", "row")
    kept = nameless.groupBy("component").agg(F.min("row").alias("kept"))
    others = others.unionByName(nameless.join(kept, "component").where("row <> kept").select("row"))
    rows = hidden(without_rows(docs, stored(others, "near-duplicate-rows")))
    known = F.col("doc_id").isNotNull() | F.col("text").rlike(r"[^\x20\x09-\x0D]")
    keyed = rows.withColumn(ROW, F.when(known, F.xxhash64("doc_id", "text")))
    return once(keyed, ROW, ("doc_id", "text")).select(rows.columns).toDF(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops contaminated documents."""
    judged = PositionalIndex(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark")).judged()
    return without_rows(docs, stored(judged.where("contaminated").select("key"), "contaminated"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret by a mark; n_chars follows the text."""
    own = hidden(docs)
    clean = F.when(F.col("text").isNotNull(), redacted(F.col("text"), F.col("secrets")))
    out = scan(own).withColumn("text", clean).select(own.columns).toDF(*docs.columns)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text")).cast(docs.schema["n_chars"].dataType))
    return out


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return pack(docs.select("doc_id", "text"))


STAGES = [
    ("toxicity", toxicity),
    ("ngram_join", ngram_join),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("packing", packing),
]

#: A fitted classifier and a tokenizer can't be written in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    with scratch() as written:
        docs = table(spark, sf_dir, "documents")
        for name, stage in STAGES:
            docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
            sweep(spark, written)
    return docs

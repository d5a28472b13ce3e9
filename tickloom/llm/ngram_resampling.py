"""Importance resampling of documents towards a target, by hashed word n-grams.

1. Words are exploded with their positions; within a document lead() brings the
   words that follow, and the n-grams of each order are concatenated and hashed to
   buckets.  This position table is written once: a row a word, a bucket an order.
2. Buckets are counted over all documents and over the target; a bucket's gain is
   the logarithm of the target's smoothed share over the documents' share.
3. Gains join the position table; a document's weight is the sum over its n-grams.
4. Gumbel noise from a hash of the doc_id makes the highest scores a weighted draw
   without replacement; ranks come from one deal into ranges, not from one task.

Rows with equal doc_id and text are computed once, carry their number along and
come back as that many rows, so a row that fills a third of the table is one
document's work.

Edge cases: null, empty or wordless texts have no features, weight 0 and are never
drawn; they get a score all the same.  A missing doc_id draws its noise from
the empty id and loses ties.  Equal scores go to the smaller doc_id; repeated rows
have ranks of their own.  Where documents or target are empty, the counts are 0 and
smoothing alone decides.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.line_dedup import UPPER
from tickloom.operators.ranking import numbered
from tickloom.storage import stored

#: ASCII but letters and digits: what separates words.
SEPARATORS = "".join(c for c in map(chr, range(128)) if not c.isalnum())
#: Copies of a row that come back from one array.
COPIES = 4096


def text_words(text: Column) -> Column:
    """Runs of letters, digits and anything beyond ASCII, with A-Z lower-cased."""
    spaced = F.translate(F.coalesce(text, F.lit("")), UPPER + SEPARATORS, UPPER.lower() + " " * len(SEPARATORS))
    return F.filter(F.split(spaced, " "), lambda w: w != "")


def position_table(texts: DataFrame, orders: int, buckets: int) -> DataFrame:
    """A row a word of ``texts`` (doc_id, text): row_, doc_id, copies and the bucket b1, b2, ... of the n-gram of each order that starts there.

    A text without words has one row without buckets.
    """
    keyed = texts.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("row_", F.xxhash64("doc_id", "text"))
    once = keyed.groupBy("row_", "doc_id").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    words = once.select("row_", "doc_id", "copies", F.posexplode_outer(text_words(F.col("text"))).alias("place", "w1"))
    following = Window.partitionBy("row_", "doc_id").orderBy("place")
    words = words.select("row_", "doc_id", "copies", "w1", *(F.lead("w1", k).over(following).alias(f"w{k + 1}") for k in range(1, orders)))
    spaced: list[Column] = [F.col("w1")]
    for k in range(2, orders + 1):
        # null where the document ends
        spaced.append(F.concat(spaced[-1], F.lit(" "), F.col(f"w{k}")))
    return words.select("row_", "doc_id", "copies", *((F.crc32(gram) % buckets).cast("int").alias(f"b{k}") for k, gram in enumerate(spaced, 1)))


def _each(table: DataFrame, orders: int) -> DataFrame:
    return table.select("row_", "doc_id", "copies", F.explode(F.array(*(f"b{k}" for k in range(1, orders + 1)))).alias("bucket"), F.col("b1").isNotNull().alias("word"))


def _counts(table: DataFrame, orders: int, name: str) -> DataFrame:
    return _each(table, orders).where("bucket is not null").groupBy("bucket").agg(F.sum("copies").alias(name))


def gains(documents: DataFrame, target: DataFrame, orders: int, buckets: int) -> DataFrame:
    """bucket, gain: one row for each of the ``buckets``."""
    every = documents.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    both = every.join(_counts(documents, orders, "s"), "bucket", "left").join(_counts(target, orders, "t"), "bucket", "left").na.fill(0, ["s", "t"])
    # as many rows as there are buckets
    all_s, all_t = (F.sum(c).over(Window.partitionBy()).cast("double") for c in "st")
    share = (F.col("t").cast("double") + 1) * (all_s + buckets) / ((F.col("s").cast("double") + 1) * (all_t + buckets))
    return both.select("bucket", F.floor(F.lit(1000.0) * F.ln(share)).alias("gain"))


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, from the first 32 bits of a hash."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + 0.5) / 4294967296.0)))


def resample(documents: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, orders: int = 3, buckets: int = 10_000, seed: int = 42) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank (null if not drawn) of every document.

    ``percent`` of the documents with at least ``least_words`` words are drawn.
    """
    table = stored(position_table(documents, orders, buckets), "positions")
    wanted = position_table(target.select(F.lit(None).cast("long").alias("doc_id"), "text"), orders, buckets)
    gain = stored(gains(table, wanted, orders, buckets), "gains")
    # one row a bucket
    summed = _each(table, orders).join(F.broadcast(gain), "bucket", "left").groupBy("row_", "doc_id", "copies").agg(F.count("bucket").alias("n_features"), F.coalesce(F.sum("gain"), F.lit(0)).alias("weight"), F.count_if("word").alias("words_"))
    scored = summed.withColumn("n_words", F.expr(f"words_ div {orders}")).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    blocks = scored.withColumn("block_", F.explode(F.sequence(F.lit(0), F.expr(f"(copies - 1) div {COPIES}"))))
    rows = blocks.withColumn("copy_", F.explode(F.sequence(F.lit(1), F.least(F.lit(COPIES), F.col("copies") - COPIES * F.col("block_")))))
    rows = stored(rows.select("doc_id", "n_words", "n_features", "weight", "score", (COPIES * F.col("block_") + F.col("copy_")).alias("copy_")), "scores")
    draw = rows.where(F.col("n_words") >= least_words).count() * percent // 100
    may = F.col("n_words") >= least_words
    order = [may.desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("copy_")]
    placed = numbered(rows, order, name="place")
    rank = F.when(F.col("place") <= draw, F.col("place")).cast("long")
    return placed.select("doc_id", "n_words", "n_features", "weight", "score", rank.alias("rank"))

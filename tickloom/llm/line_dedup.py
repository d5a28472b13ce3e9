"""Lines that many documents share, dropped everywhere they stand.

1. Every line of every text is normalised (white space stripped at both ends, A-Z
   lower-cased) and hashed to 128 bits.
2. The distinct documents of each hash are counted: first once per hash and
   document, then per hash, so that no line is one task's work however often it is.
3. Lines join the hashes found in enough documents; only their places travel.  A hash
   with more than its share of all such lines is dealt out over salts.
4. Each text is put together again, by position, from the lines that stay.

A document is a row; rows with equal doc_id and text count as one.

Edge cases: a null or empty text is one empty line, whose key is too short to be
dropped unless ``least_chars`` is 0.  Rows without a doc_id are told apart by their
text; a document of dropped lines only keeps the empty text.  Repeated rows get the
same result each.  A line ends at \\n alone: \\r is white space of the line.  Empty
tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.storage import stored

#: Into as many pieces at least the lines that are looked up are dealt; also the most hashes that are salted.
PIECES = 4096
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BLANKS = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    """The line stripped of ASCII white space, with A-Z lower-cased."""
    line = F.btrim(line, F.lit(BLANKS))
    # lower() knows more letters than A-Z, but not among ASCII, and is much the faster
    return F.when(F.octet_length(line) == F.char_length(line), F.lower(line)).otherwise(F.translate(line, UPPER, UPPER.lower()))


def text_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _rows(documents: DataFrame) -> DataFrame:
    """doc_id, lines and what tells documents apart: id_ and row_."""
    text = F.col("text").cast("string")
    own = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    return own.select("doc_id", F.coalesce("doc_id", F.lit(0)).alias("id_"), F.xxhash64("doc_id", "text").alias("row_"), text_lines(F.col("text")).alias("lines"))


def common_lines(documents: DataFrame, least_docs: int = 10, least_chars: int = 1) -> DataFrame:
    """Every place of a line that is found in enough documents: id_, row_, place."""
    lines = _rows(documents).select("id_", "row_", F.posexplode("lines").alias("place", "line"))
    key = lines.select("id_", "row_", "place", line_key(F.col("line")).alias("key")).where(F.char_length("key") >= least_chars)
    hashed = key.select("id_", "row_", "place", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("2"), "key").alias("h2"))
    shared = hashed.groupBy("h1", "h2").agg(F.count_distinct("id_", "row_").alias("docs_"), F.count("*").alias("lines_"))
    shared = stored(shared.where(F.col("docs_") >= least_docs).select("h1", "h2", "lines_"), "common-lines")
    total = shared.agg(F.sum("lines_")).first()[0] or 1
    salts = F.expr(f"lines_ * {PIECES} div {total}") + 1
    # each has a PIECES-th of the lines or more, so there are PIECES at most
    often = shared.withColumn("salts_", salts).where("salts_ > 1").select("h1", "h2", "salts_")
    dealt = hashed.join(F.broadcast(often), ["h1", "h2"], "left").withColumn("salt_", F.pmod(F.xxhash64("row_", "place"), F.coalesce("salts_", F.lit(1))))
    asked = shared.select("h1", "h2", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)).alias("salt_"))
    return dealt.join(asked, ["h1", "h2", "salt_"]).select("id_", "row_", "place")


def drop_common_lines(documents: DataFrame, least_docs: int = 10, least_chars: int = 1) -> DataFrame:
    """doc_id, n_lines (before), n_dropped and the text that stays, ``kept``."""
    gone = common_lines(documents, least_docs, least_chars).groupBy("id_", "row_").agg(F.collect_set("place").alias("gone"))
    both = _rows(documents).join(gone, ["id_", "row_"], "left")
    places = F.sequence(F.lit(0), F.size("lines") - 1)
    stay = F.when(F.col("gone").isNull(), F.col("lines")).otherwise(F.transform(F.array_except(places, "gone"), lambda i: F.get("lines", i)))
    return both.select(
        "doc_id",
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
        F.array_join(stay, "\n").alias("kept"),
    )

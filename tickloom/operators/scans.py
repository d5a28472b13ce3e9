"""Running values over keys of any size: a key's rows lie in pieces, and what comes before a piece is carried over.

Rows are dealt into sorted ranges of key and order, and written, since sampled
ranges wouldn't come out the same twice.  A key that fills a third of the table is
spread over a third of the ranges.  Windows run within a piece, a key's rows of one
range; of each piece that has neighbours one summary row is made, and the running
value of the summaries before (or after) it is joined to its rows.  A key in more
than one range is the first or the last of each, so there are at most two summaries
a range.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tickloom.storage import stored

PIECE = "piece_"


def in_pieces(df: DataFrame, by: Sequence[str], order: Sequence[Column], pieces: int | None = None) -> DataFrame:
    """The rows with the range they are dealt to."""
    pieces = pieces or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [*(F.col(b) for b in by), *order]
    return stored(df.repartitionByRange(pieces, *keys).withColumn(PIECE, F.spark_partition_id()), "pieces")


def of_piece(by: Sequence[str], order: Sequence[Column]) -> WindowSpec:
    return Window.partitionBy(PIECE, *by).orderBy(*order)


def carried(rows: DataFrame, by: Sequence[str], summary: Mapping[str, Column], over: Mapping[str, Callable[[WindowSpec, WindowSpec], Column]]) -> DataFrame:
    """Adds to the rows what other pieces of their key amount to; null where there are none.

    ``summary`` aggregates a piece; ``over`` combines summaries, given the windows
    of the pieces before and after.
    """
    pieces = rows.groupBy(PIECE, *by).agg(*(c.alias(n) for n, c in summary.items()))
    pieces = pieces.withColumn("pieces_", F.count("*").over(Window.partitionBy(*by))).where("pieces_ > 1")
    order = Window.partitionBy(*by).orderBy(PIECE)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(*by).orderBy(F.desc(PIECE)).rowsBetween(Window.unboundedPreceding, -1)
    known = pieces.select(PIECE, *by, *(combine(before, after).alias(n) for n, combine in over.items()))
    # keys may be null
    mine = known.select(F.col(PIECE).alias("its_piece_"), *(F.col(b).alias(f"its_{b}_") for b in by), *over)
    same = F.col(PIECE) == F.col("its_piece_")
    for b in by:
        same = same & F.col(b).eqNullSafe(F.col(f"its_{b}_"))
    # two rows a range at most
    return rows.join(F.broadcast(mine), same, "left").drop("its_piece_", *(f"its_{b}_" for b in by))


def asof_in_pieces(left: DataFrame, right: DataFrame, by: Sequence[str], left_on: str, right_on: str, values: Sequence[str], pieces: int | None = None) -> DataFrame:
    """``joins.asof`` for keys of any size: left rows with the values of the last right row at or before their time."""
    known = F.struct(F.col(right_on).alias("at_"), *(F.col(v) for v in values))
    a = left.select("*", F.col(left_on).alias("t_"), F.lit(1).alias("side_"))
    b = right.select(*by, F.col(right_on).alias("t_"), F.lit(0).alias("side_"), known.alias("known_"))
    order = [F.col("t_").asc(), F.col("side_").asc(), F.col("known_").asc()]
    rows = in_pieces(a.unionByName(b, allowMissingColumns=True), by, order, pieces)
    rows = carried(rows, by, {"last_": F.max("known_")}, {"before_": lambda before, _: F.last("last_", ignorenulls=True).over(before)})
    here = F.last("known_", ignorenulls=True).over(of_piece(by, order).rowsBetween(Window.unboundedPreceding, 0))
    out = rows.withColumn("found_", F.coalesce(here, "before_")).where("side_ = 1")
    return out.select(*left.columns, F.col("found_.at_").alias(f"matched_{right_on}"), *(F.col(f"found_.{v}").alias(v if v not in left.columns else f"{v}_right") for v in values))


def running_in_pieces(df: DataFrame, by: Sequence[str], order: Sequence[Column], totals: Mapping[str, Column], pieces: int | None = None) -> DataFrame:
    """Running sums of the columns ``totals`` up to each row, for keys of any size."""
    rows = in_pieces(df.withColumns({f"{n}_": c for n, c in totals.items()}), by, order, pieces)
    rows = carried(rows, by, {f"{n}_own_": F.sum(f"{n}_") for n in totals}, {f"{n}_before_": lambda before, _, n=n: F.sum(f"{n}_own_").over(before) for n in totals})
    upto = of_piece(by, order).rowsBetween(Window.unboundedPreceding, 0)
    none = F.lit(0)
    return rows.withColumns({n: F.coalesce(F.sum(f"{n}_").over(upto), none) + F.coalesce(f"{n}_before_", none) for n in totals}).select(*df.columns, *totals)

"""Price adjustment factors from corporate actions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.operators import scans
from tickloom.storage import stored


def ex_rights_close(last_close_milli, dividend, rights_price, bonus, rights) -> Column:
    """The theoretical close in milli after a dividend, bonus and rights per ten shares, cut towards zero."""
    last = F.col(last_close_milli).cast("double") if isinstance(last_close_milli, str) else last_close_milli
    cash, price, free, paid = (F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in (dividend, rights_price, bonus, rights))
    shares = 10 + free + paid
    value = F.try_divide((last / 1000 * 10 - cash) + paid * price, shares) * 1000
    return F.when(F.coalesce(last, F.lit(0.0)) == 0, last).when(shares == 0, last).otherwise(F.try_divide(value, F.lit(1.0))).cast("long")


def _step(top: Column, bottom: Column) -> Column:
    plain = top.isNull() | bottom.isNull() | (top == 0) | (bottom == 0) | (top == bottom)
    return F.when(plain, F.lit(1.0)).otherwise(F.try_divide(top.cast("double"), bottom.cast("double")))


def adjustment_factors(bars: DataFrame, actions: DataFrame, by: str = "instrument_id", date: str = "trade_date", last_close: str = "last_close_milli", event_date: str = "event_date") -> DataFrame:
    """Adds hfq and qfq to bars; actions hold category_raw, c1 .. c4 and an ordinal.

    An action (category 1) falls on the first bar at or after its date; of
    several on one bar the last by date and ordinal counts.
    """
    from tickloom.operators.joins import asof

    events = actions.where("category_raw = 1").select(by, F.col(event_date).alias("event_"), "ordinal", "c1", "c2", "c3", "c4")
    placed = asof(events, bars.select(by, F.col(date).alias("bar_")), [by], "event_", "bar_", [], forward=True).where("matched_bar_ is not null")
    order = F.struct("event_", "ordinal")
    last = placed.groupBy(by, F.col("matched_bar_").alias(date)).agg(*(F.max_by(c, order).alias(c) for c in ("c1", "c2", "c3", "c4")), F.lit(True).alias("event_here"))
    rows = _with_steps(bars.join(last, [by, date], "left"), last_close)
    order = Window.partitionBy(by).orderBy(date)
    hfq = F.product("h_").over(order.rowsBetween(Window.unboundedPreceding, 0))
    # the reverse product of later rows as a running one in descending order
    qfq = F.coalesce(F.product("q_").over(Window.partitionBy(by).orderBy(F.desc(date)).rowsBetween(Window.unboundedPreceding, -1)), F.lit(1.0))
    return _rounded(rows, hfq, qfq, bars.columns)


def _with_steps(rows: DataFrame, last_close: str) -> DataFrame:
    """Bars that know the action on them (event_here, c1 .. c4), with the steps of both factors."""
    close = F.col(last_close).cast("double")
    pre = F.when(F.col("event_here"), ex_rights_close(last_close, "c1", "c2", "c3", "c4").cast("double")).otherwise(close)
    rows = rows.withColumns({"close_": close, "pre_": pre})
    return rows.withColumns({"h_": _step(F.col("close_"), F.col("pre_")), "q_": _step(F.col("pre_"), F.col("close_"))})


def _rounded(rows: DataFrame, hfq: Column, qfq: Column, columns: list[str]) -> DataFrame:
    return rows.withColumns({"hfq": F.round(hfq, 10), "qfq": F.round(qfq, 10), "pre_last_close_milli": F.col("pre_").cast("long")}).select(*columns, "pre_last_close_milli", "hfq", "qfq")


def adjustment_factors_in_pieces(bars: DataFrame, actions: DataFrame, by: str = "instrument_id", date: str = "trade_date", last_close: str = "last_close_milli", event_date: str = "event_date", pieces: int | None = None) -> DataFrame:
    """``adjustment_factors`` for instruments of any size; bars hold one row an instrument and date.

    Bars and actions are scanned once in one order, actions before the bars of
    their date.  An action counts on a bar if it is the last one so far and later
    than the bar before.  That, and the products of both factors, are carried from
    piece to piece.
    """
    parts = ["ordinal", "c1", "c2", "c3", "c4"]
    events = actions.where("category_raw = 1").select(by, F.col(event_date).alias("t_"), F.lit(0).alias("side_"), F.struct(F.col(event_date).alias("at_"), *parts).alias("event_"))
    both = bars.select("*", F.col(date).alias("t_"), F.lit(1).alias("side_")).unionByName(events, allowMissingColumns=True)
    order = [F.col("t_"), F.col("side_"), F.col("event_.ordinal")]
    rows = scans.in_pieces(both, [by], order, pieces)
    bar = F.when(F.col("side_") == 1, F.col("t_"))
    last = lambda name: lambda before, _: F.last(name, ignorenulls=True).over(before)
    rows = scans.carried(rows, [by], {"own_event_": F.max("event_"), "own_bar_": F.max(bar)}, {"event_before_": last("own_event_"), "bar_before_": last("own_bar_")})
    here = scans.of_piece([by], order)
    event = F.coalesce(F.last("event_", ignorenulls=True).over(here.rowsBetween(Window.unboundedPreceding, 0)), "event_before_")
    previous = F.coalesce(F.last(bar, ignorenulls=True).over(here.rowsBetween(Window.unboundedPreceding, -1)), "bar_before_")
    met = rows.select(*bars.columns, scans.PIECE, "side_", event.alias("event_"), previous.alias("previous_")).where("side_ = 1")
    hit = F.coalesce(F.col("event_.at_").isNotNull() & (F.col("previous_").isNull() | (F.col("event_.at_") > F.col("previous_"))), F.lit(False))
    steps = stored(_with_steps(met.select(*bars.columns, scans.PIECE, hit.alias("event_here"), *(F.when(hit, F.col(f"event_.{c}")).alias(c) for c in parts[1:])), last_close), "steps")
    product = lambda name, side: lambda *windows: F.product(name).over(windows[side])
    steps = scans.carried(steps, [by], {"own_h_": F.product("h_"), "own_q_": F.product("q_")}, {"h_before_": product("own_h_", 0), "q_after_": product("own_q_", 1)})
    one = F.lit(1.0)
    hfq = F.product("h_").over(scans.of_piece([by], [F.col(date)]).rowsBetween(Window.unboundedPreceding, 0)) * F.coalesce("h_before_", one)
    qfq = F.coalesce(F.product("q_").over(scans.of_piece([by], [F.desc(date)]).rowsBetween(Window.unboundedPreceding, -1)), one) * F.coalesce("q_after_", one)
    return _rounded(steps, hfq, qfq, bars.columns)


def anchored(factors: DataFrame, anchor: str, by: str = "instrument_id", date: str = "trade_date") -> DataFrame:
    """qfq divided by its value on the last bar at or before the anchor; instruments without such a bar raise."""
    base = factors.where(F.col(date) <= anchor).groupBy(by).agg(F.max_by("qfq", date).alias("base_"))
    # a join splits an instrument of many bars, a window doesn't
    rows = factors.join(base, by, "left")
    base = F.col("base_")
    checked = F.when(base.isNull() | (base == 0), F.raise_error(F.lit("no usable factor at the anchor")).cast("double")).otherwise(base)
    return rows.withColumn("qfq", F.round(F.col("qfq") / checked, 10)).select(factors.columns)


def selected(factors: DataFrame, kind: str, anchor: str | None = None, by: str = "instrument_id", date: str = "trade_date") -> DataFrame:
    """adj_factor of one kind; only qfq can be anchored."""
    if kind not in ("qfq", "hfq"):
        raise ValueError("a factor is qfq or hfq")
    if anchor and kind == "hfq":
        raise ValueError("hfq has no anchor")
    rows = anchored(factors, anchor.replace("-", ""), by, date) if anchor else factors
    return rows.select(by, date, F.round(F.col(kind), 10).alias("adj_factor"))

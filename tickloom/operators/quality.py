"""Data-quality reports: schema, keys, signs, prices, calendars."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.codes import exchange_of_symbol
from tickloom.functions.dates import compact, is_true
from tickloom.functions.money import num
from tickloom.operators import aggregates, daybits
from tickloom.operators.joins import overlap_ratio
from tickloom.schema import table_schema

SAMPLES = 5


def schema_check(df: DataFrame, required: Sequence[str], expected: Sequence[str]) -> dict:
    """Required columns that are missing are errors, unexpected ones warnings."""
    missing = [c for c in required if c not in df.columns]
    extra = [c for c in df.columns if expected and c not in expected]
    return {"status": "error" if missing else "warn" if extra else "ok", "missing": missing, "unexpected": extra}


def key_check(df: DataFrame, key: Sequence[str]) -> dict:
    """missing (a key column isn't there), missing_value, duplicate or pass."""
    absent = [c for c in key if c not in df.columns]
    if absent or not key:
        return {"status": "missing", "missing": absent}
    any_null = F.lit(False)
    for c in key:
        any_null = any_null | F.col(c).isNull() | (F.col(c).cast("string") == "")
    n_null = df.agg(F.count_if(any_null)).first()[0]
    n_rows, n_keys = aggregates.duplicate_rows(df, key).first()
    samples = [r.asDict() for r in aggregates.duplicate_groups(df, key).orderBy(*key).limit(SAMPLES).collect()] if n_rows else []
    return {"status": "missing_value" if n_null else "duplicate" if n_rows else "pass", "n_null": n_null, "n_duplicate_rows": n_rows, "n_duplicate_keys": n_keys, "samples": samples}


def sign_checks(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, n_negative, n_null) of columns read as numbers."""
    value = {c: F.col(c).try_cast("double") for c in columns if c in df.columns}
    counts = df.agg(*(F.count_if(v < 0).alias(f"{c}_neg") for c, v in value.items()), *(F.count_if(v.isNull()).alias(f"{c}_null") for c, v in value.items()))
    return counts.select(F.inline(F.array(*(F.struct(F.lit(c).alias("column"), F.col(f"{c}_neg").alias("n_negative"), F.col(f"{c}_null").alias("n_null")) for c in value))))


def price_anomalies(df: DataFrame) -> DataFrame:
    """Bars whose prices contradict each other; a null contradicts nothing."""
    o, h, low, c = (num(x) for x in ("open", "high", "low", "close"))
    wrong = [h < low, h < o, h < c, low > o, low > c]
    hit = F.lit(False)
    for w in wrong:
        hit = hit | F.coalesce(w, F.lit(False))
    return df.where(hit)


def market_rules(df: DataFrame) -> DataFrame:
    """(rule, n): price contradictions, negative volumes and amounts, adjustment factors not above zero."""
    rules = {}
    if {"open", "high", "low", "close"} <= set(df.columns):
        o, h, low, c = (num(x) for x in ("open", "high", "low", "close"))
        rules["ohlc"] = (h < low) | (h < o) | (h < c) | (low > o) | (low > c)
    for name in ("vol", "volume", "amount"):
        if name in df.columns:
            rules[f"negative_{name}"] = num(name) < 0
    if "adj_factor" in df.columns:
        rules["adj_factor"] = num("adj_factor") <= 0
    if not rules:
        return df.sparkSession.createDataFrame([], "rule string, n long")
    # a null operand makes a comparison unknown, and OR keeps what is known
    counts = df.agg(*(F.count_if(rule).alias(name) for name, rule in rules.items()))
    return counts.select(F.inline(F.array(*(F.struct(F.lit(n).alias("rule"), F.col(n).alias("n")) for n in rules))))


def calendar_coverage(df: DataFrame, calendar: DataFrame, date: str, by: str = "exchange", cal_date: str = "cal_date", flag: str = "is_open") -> DataFrame:
    """One row: open days within the data's dates, days present, missing, and extra days that no calendar holds."""
    days = df.select(compact(date).alias("d")).where("d is not null").distinct()
    opened = calendar.where(is_true(flag)).select(F.col(cal_date).alias("d")).distinct()
    bounds = days.agg(F.min("d").alias("low"), F.max("d").alias("high"))
    expected = opened.join(F.broadcast(bounds), (F.col("d") >= F.col("low")) & (F.col("d") <= F.col("high"))).select("d")
    both = expected.withColumn("e", F.lit(True)).join(days.withColumn("a", F.lit(True)), "d", "full").join(opened.withColumn("o", F.lit(True)), "d", "left")
    out = both.agg(
        F.count_if("e").alias("n_expected"),
        F.count_if("a").alias("n_actual"),
        F.count_if(F.col("e") & F.col("a").isNull()).alias("n_missing"),
        F.count_if(F.col("a") & F.col("o").isNull()).alias("n_extra"),
        F.sort_array(F.slice(F.sort_array(F.collect_list(F.when(F.col("e") & F.col("a").isNull(), F.col("d")))), 1, SAMPLES)).alias("missing_samples"),
    )
    span = opened.agg(F.min("d").alias("cal_low"), F.max("d").alias("cal_high"))
    short = (F.col("cal_low") > F.col("low")) | (F.col("cal_high") < F.col("high"))
    status = F.when(F.col("cal_low").isNull(), "warn").when(F.col("n_extra") > 0, "error").when((F.col("n_missing") > 0) | short, "warn").otherwise("ok")
    return out.crossJoin(bounds).crossJoin(span).withColumn("status", status)


def symbol_gaps(df: DataFrame, calendar: DataFrame, symbol: str, date: str, suspensions: DataFrame | None = None, cal_date: str = "cal_date", flag: str = "is_open") -> DataFrame:
    """(symbol, word, missing, explained): the open days of the symbol's exchange within its own dates that it lacks, as words of days.

    A symbol goes by the calendar of its exchange, and without one by all open days.
    ``explained`` are the missing days on which it was suspended.  Text that is no
    date counts nowhere.
    """
    held = daybits.day_words(df.select(F.col(symbol).alias("symbol"), F.col(date).alias("d")), ["symbol"], "d", "held")
    opened = calendar.where(is_true(flag)).select("exchange", F.col(cal_date).alias("d"))
    own = daybits.day_words(opened.where("exchange <> 'ALL'"), ["exchange"], "d", "open").select(F.col("exchange").alias("calendar"), "word", "open")
    anywhere = daybits.day_words(opened, [], "d", "open").select(F.lit("*").alias("calendar"), "word", "open")
    named = own.select(F.col("calendar").alias("exchange")).distinct().withColumn("own", F.lit(True))
    spans = held.groupBy("symbol").agg(F.min("low").alias("low"), F.max("high").alias("high")).withColumn("exchange", exchange_of_symbol("symbol"))
    # a row an exchange
    spans = spans.join(F.broadcast(named), "exchange", "left").withColumn("calendar", F.when(F.col("own"), F.col("exchange")).otherwise("*"))
    words = spans.select("symbol", "calendar", "low", "high", F.explode(F.expr("sequence(low >> 6, high >> 6)")).alias("word"))
    # a word for two months of an exchange's calendar
    due = words.join(F.broadcast(own.unionByName(anywhere)), ["calendar", "word"]).select("symbol", "word", F.col("open").bitwiseAND(daybits.within("word", "low", "high")).alias("open"))
    sides = [due, held.select("symbol", "word", "held")]
    if suspensions is not None:
        sides.append(daybits.day_words(suspensions.select(F.col(symbol).alias("symbol"), F.col(date).alias("d")), ["symbol"], "d", "halted").select("symbol", "word", "halted"))
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sides)
    none = F.lit(0).cast("long")
    either = lambda name: F.coalesce(F.bit_or(name), none) if name in both.columns else none
    met = both.groupBy("symbol", "word").agg(either("open").alias("open"), either("held").alias("held"), either("halted").alias("halted"))
    missing = daybits.without(F.col("open"), F.col("held"))
    return met.select("symbol", "word", missing.alias("missing"), missing.bitwiseAND(F.col("halted")).alias("explained")).where("missing <> 0")


def _by_reason(gaps: DataFrame) -> DataFrame:
    """A row for the explained days of a word and one for the others: symbol, word, bits, explained."""
    plain = daybits.without(F.col("missing"), F.col("explained"))
    told = F.array(F.struct(F.col("explained").alias("bits"), F.lit(True).alias("explained")), F.struct(plain.alias("bits"), F.lit(False).alias("explained")))
    return gaps.select("symbol", "word", F.inline(told)).where("bits <> 0")


def symbol_coverage(df: DataFrame, calendar: DataFrame, symbol: str, date: str, suspensions: DataFrame | None = None, cal_date: str = "cal_date", flag: str = "is_open") -> DataFrame:
    """(symbol, missing date, explained): every day of ``symbol_gaps``, spelt out."""
    gaps = _by_reason(symbol_gaps(df, calendar, symbol, date, suspensions, cal_date, flag))
    return daybits.spelt(gaps, "word", "bits").select("symbol", "d", "explained")


def symbol_gap_counts(df: DataFrame, calendar: DataFrame, symbol: str, date: str, suspensions: DataFrame | None = None, cal_date: str = "cal_date", flag: str = "is_open") -> DataFrame:
    """(symbol, explained, n_days, first_day) of what is missing, counted in bits."""
    gaps = _by_reason(symbol_gaps(df, calendar, symbol, date, suspensions, cal_date, flag))
    first = F.min(daybits.first_day(F.col("word"), F.col("bits")))
    return gaps.groupBy("symbol", "explained").agg(F.sum(F.bit_count("bits")).alias("n_days"), daybits.day_text(first).alias("first_day"))


def missing_day_counts(df: DataFrame, calendar: DataFrame, symbol: str, date: str, least: Column, cal_date: str = "cal_date", flag: str = "is_open") -> DataFrame:
    """(day, n_symbols, least): how many symbols lack each open day within their own dates, and the least value of theirs.

    The same days as ``symbol_coverage`` without suspensions, of which none is spelt
    out: between two days that a symbol holds lies one range it lacks, so there are
    no more ranges than rows.  A range is cut at multiples of powers of two into a few
    blocks; equal blocks are summed in every task, and only these, as many as twice the
    days of a calendar, meet the days they cover.
    """
    rows = df.select(F.col(symbol).alias("symbol"), daybits.day_number(F.col(date)).alias("day"), least.alias("least")).where("day is not null")
    held = rows.groupBy("symbol", "day").agg(F.min("least").alias("least"))
    before = F.lag("day").over(Window.partitionBy("symbol").orderBy("day"))
    # a symbol's least value is one for all its days
    lowest = F.min("least").over(Window.partitionBy("symbol"))
    gaps = held.select("symbol", (before + 1).alias("low"), (F.col("day") - 1).alias("high"), lowest.alias("least")).where("low <= high")
    opened = calendar.where(is_true(flag)).select("exchange", daybits.day_number(F.col(cal_date)).alias("day")).where("day is not null")
    own = opened.where("exchange <> 'ALL'").select(F.col("exchange").alias("calendar"), "day").distinct()
    anywhere = opened.select(F.lit("*").alias("calendar"), "day").distinct()
    named = own.select(F.col("calendar").alias("exchange")).distinct().withColumn("own", F.lit(True))
    # a row an exchange
    gaps = gaps.withColumn("exchange", exchange_of_symbol("symbol")).join(F.broadcast(named), "exchange", "left").withColumn("calendar", F.when(F.col("own"), F.col("exchange")).otherwise("*"))
    blocks = gaps.select("calendar", "least", F.inline(_blocks("low", "high"))).groupBy("calendar", "level", "place").agg(F.count("*").alias("n"), F.min("least").alias("least"))
    days = own.unionByName(anywhere).select("calendar", "day", F.explode(F.sequence(F.lit(0), F.lit(LEVELS - 1))).alias("level")).withColumn("place", F.expr("shiftright(day, level)"))
    covered = days.join(blocks, ["calendar", "level", "place"])
    return covered.groupBy("day").agg(F.sum("n").alias("n_symbols"), F.min("least").alias("least")).select(daybits.day_text(F.col("day")).alias("day"), "n_symbols", "least")


#: Blocks have up to 2^21 days, so that any two dates lie within a few.
LEVELS = 22


def _blocks(low: str, high: str) -> Column:
    """A range of days as an array of (level, place): days place * 2^level and on, 2^level of them."""
    # of each size at most one block at the left and one at the right, once smaller ones have taken what doesn't fit
    begin, end = (lambda i: f"shiftright({low} + shiftleft(1, {i}) - 1, {i})"), (lambda i: f"shiftright({high} + 1, {i})")
    whole = f"filter(sequence(0, {LEVELS - 1}), i -> {begin('i')} < {end('i')})"
    left = f"i < {LEVELS - 1} and {begin('i')} & 1 = 1"
    right = f"i < {LEVELS - 1} and {end('i')} & 1 = 1 and not ({begin('i')} & 1 = 1 and {begin('i')} = {end('i')} - 1)"
    top = f"if(i = {LEVELS - 1}, transform(sequence({begin('i')}, {end('i')} - 1), p -> struct(i as level, p as place)), array())"
    one = lambda when, place: f"if({when}, array(struct(i as level, {place} as place)), array())"
    return F.expr(f"flatten(transform({whole}, i -> concat({one(left, begin('i'))}, {one(right, end('i') + ' - 1')}, {top})))")


def validate_table(df: DataFrame, table: str) -> list[dict]:
    """Issues of a core table: missing columns or values, and keys that aren't unique."""
    schema = table_schema(table)
    issues = []
    absent = [c for c in schema.required if c not in df.columns]
    if absent:
        issues.append({"issue": "missing_columns", "columns": absent})
    for row in aggregates.null_counts(df, [c for c in schema.required if c in df.columns]).where("n_null > 0").collect():
        issues.append({"issue": "missing_required", "columns": [row.column], "n": row.n_null})
    if all(c in df.columns for c in schema.key):
        n_rows, _ = aggregates.duplicate_rows(df, list(schema.key)).first()
        if n_rows:
            issues.append({"issue": "primary_key_duplicates", "columns": list(schema.key), "n": n_rows})
    return issues


def evaluate(df: DataFrame, key: Sequence[str], required: Sequence[str] = (), expected: Sequence[str] = (), positive: Sequence[str] = (), date: str | None = None, calendar: DataFrame | None = None) -> dict:
    """All checks and the worst of their states: ok, warn or error."""
    report: dict = {"schema": schema_check(df, required, expected), "key": key_check(df, key), "rules": {r.rule: r.n for r in market_rules(df).collect()}}
    if positive:
        report["signs"] = [r.asDict() for r in sign_checks(df, positive).collect()]
    if date:
        report["dates"] = aggregates.date_profile(df, date).first().asDict()
        report["calendar"] = {"status": "warn", "reason": "calendar_unavailable"} if calendar is None else calendar_coverage(df, calendar, date).first().asDict()
    states = [report["schema"]["status"], "ok" if report["key"]["status"] == "pass" else "error", "error" if any(report["rules"].values()) else "ok", report.get("calendar", {}).get("status", "ok")]
    report["status"] = max(states, key=("ok", "warn", "error").index)
    return report


def resource_checks(one: DataFrame, two: DataFrame, key: Sequence[str] = ("market_id", "code"), date: str = "stats_date", least: int = 1000, share: float = 0.95) -> list[str]:
    """What speaks against a pair of statistics tables."""
    against = []
    dates = []
    for name, df in (("first", one), ("second", two)):
        if aggregates.duplicate_rows(df, key).first().n_rows:
            against.append(f"{name}: keys repeat")
        main = aggregates.dominant(df, date).first()
        dates.append(main.value)
        if (main.total or 0) < least:
            against.append(f"{name}: fewer than {least} rows")
        if (main.coverage or 0) < share:
            against.append(f"{name}: its date covers too few rows")
    if (overlap_ratio(one, two, key).first().overlap or 0) < share:
        against.append("keys overlap too little")
    return against + (["dates differ"] if dates[0] != dates[1] else [])


def covers(calendar: DataFrame, start: str, end: str) -> bool:
    """Whether a calendar holds every natural day of a range; the gate before a dependent run."""
    from tickloom.operators.calendar import missing_days

    return not missing_days(calendar, start, end).limit(1).count()


def report_frame(spark, report: Mapping) -> DataFrame:
    """A report as one JSON row."""
    import json

    return spark.createDataFrame([(json.dumps(report, ensure_ascii=False, default=str),)], "report string")

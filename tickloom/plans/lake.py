"""Registered queries of sources, sinks, write modes, filters, quality reports and streams, beside the same in SQL."""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import pandas as pd
from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom import catalog, schema
from tickloom.functions import codes
from tickloom.operators import calendar, filters, quality, ranking, snapshot
from tickloom.plans import views as v
from tickloom.plans.market import QUERIES, SQL, query, scratch
from tickloom.plans.views import load
from tickloom.sources import formats, gateway, layout, packed, table_functions, tables, writers
from tickloom.streaming import refresh

HERE = __name__
# one register of all queries
__all__ = ["QUERIES", "SQL"]


def _rows(spark: SparkSession, kind: str, *rows: tuple) -> DataFrame:
    return spark.createDataFrame(list(rows), kind)


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# --- scans of lakes in mixed layouts

_DAILY_SQL = "SELECT CAST(o_custkey AS VARCHAR) AS ts_code, strftime(o_orderdate, '%Y%m%d') AS trade_date, CAST(o_totalprice AS DOUBLE) AS close, CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderkey AS DOUBLE) END AS vol FROM orders"


def _mixed_lake(spark: SparkSession, folder: str) -> str:
    """Half of the orders with plain dates and numbers; the others with dashes, numbers as text and no volume, in folders by month."""
    root = scratch(spark, "lake")
    rows = load(spark, folder, "orders").withColumns({"ts_code": F.col("o_custkey").cast("string"), "close": F.col("o_totalprice").cast("double"), "vol": F.col("o_orderkey").cast("double")})
    even = rows.where("o_orderkey % 2 = 0").select("ts_code", v.day("o_orderdate").alias("trade_date"), "close", "vol")
    odd = rows.where("o_orderkey % 2 = 1").select("ts_code", F.date_format("o_orderdate", "yyyy-MM-dd").alias("trade_date"), F.col("close").cast("string").alias("close"), F.date_format("o_orderdate", "yyyyMM").alias("month"))
    even.write.parquet(f"{root}/core/table=daily/parquet/plain")
    odd.repartition("month").write.partitionBy("month").parquet(f"{root}/core/table=daily/parquet/dashed")
    return root


@query("SELECT 0 AS place, 'r_regionkey' AS name UNION ALL SELECT 1, 'r_name' UNION ALL SELECT 2, 'n_nationkey' UNION ALL SELECT 3, 'n_name'")
def q_source_columns(spark, folder):
    root = scratch(spark, "columns")
    load(spark, folder, "region").select("r_regionkey", "r_name").coalesce(1).write.parquet(f"{root}/a")
    load(spark, folder, "nation").select("n_nationkey", "n_name").coalesce(1).write.parquet(f"{root}/b")
    return _rows(spark, "place int, name string", *enumerate(tables.source_columns(spark, [f"{root}/a", f"{root}/b"])))


@query(f"SELECT ts_code, trade_date, close, vol FROM ({_DAILY_SQL})")
def q_scan_mixed_layouts(spark, folder):
    return tables.read_core_table(spark, "daily", _mixed_lake(spark, folder)).select("ts_code", "trade_date", "close", "vol")


@query("SELECT month, count(*) AS n FROM (SELECT CASE WHEN o_orderkey % 2 = 1 THEN strftime(o_orderdate, '%Y%m') END AS month FROM orders) GROUP BY 1")
def q_scan_hive_values(spark, folder):
    root = _mixed_lake(spark, folder)
    return tables.scan_files(spark, layout.table_files(spark, root, "daily")).groupBy("month").agg(F.count("*").alias("n"))


@query(f"SELECT ts_code, close FROM ({_DAILY_SQL}) WHERE trade_date BETWEEN '19950310' AND '19961101' AND ts_code IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer)")
def q_query_stored_dates(spark, folder):
    return tables.query_table(spark, "daily", _mixed_lake(spark, folder), None, ["ts_code", "close"], "1995-03-10", "19961101")


@query("SELECT CAST(o_orderkey AS VARCHAR) AS instrument_id, strftime(o_orderdate, '%Y%m') || '01' AS list_date FROM orders WHERE strftime(o_orderdate, '%Y%m') BETWEEN '199501' AND '199606'")
def q_layout_prunes_dates(spark, folder):
    root = scratch(spark, "dated")
    rows = load(spark, folder, "orders").select(F.col("o_orderkey").cast("string").alias("instrument_id"), F.concat(F.date_format("o_orderdate", "yyyyMM"), F.lit("01")).alias("list_date"))
    rows.repartition("list_date").write.partitionBy("list_date").parquet(f"{root}/core/table=stock_basic_exchange/parquet")
    return tables.query_table(spark, "stock_basic", root, None, ["instrument_id", "list_date"], "1995-01-01", "1996-06-30")


@query("SELECT exchange, cal_date, is_open FROM (SELECT o_orderpriority AS exchange, strftime(o_orderdate, '%Y%m%d') AS cal_date, CAST(count(*) AS BIGINT) AS is_open FROM orders GROUP BY 1, 2)")
def q_core_table_roundtrip(spark, folder):
    root = scratch(spark, "core")
    rows = load(spark, folder, "orders").groupBy(F.col("o_orderpriority").alias("exchange"), v.day("o_orderdate").alias("cal_date")).agg(F.count("*").alias("is_open"), F.max("o_orderkey").alias("undeclared"))
    writers.write_core_table(rows, "trade_cal", root)
    return tables.read_core_table(spark, "trade_cal", root).select("exchange", "cal_date", "is_open")


@query(f"SELECT count(*) AS n_rows, min(trade_date) AS date_min, max(trade_date) AS date_max, 'ts_code,trade_date' AS key FROM ({_DAILY_SQL})")
def q_catalog_inspect(spark, folder):
    found = catalog.inspect(spark, _mixed_lake(spark, folder), "daily")
    return _rows(spark, "n_rows long, date_min string, date_max string, key string", (found["rows"], found["date_min"], found["date_max"], ",".join(found["key"])))


@query("""WITH d AS (SELECT o_orderpriority AS exchange, strftime(o_orderdate, '%Y%m%d') AS cal_date, CAST(count(*) AS BIGINT) AS is_open FROM orders GROUP BY 1, 2), t AS (SELECT count(*) AS n FROM d)
SELECT name, required, kind, CASE WHEN name = 'pretrade_date' THEN 0 ELSE n END AS n_held FROM t, (VALUES ('exchange', TRUE, 'string'), ('cal_date', TRUE, 'string'), ('is_open', TRUE, 'bigint'), ('pretrade_date', FALSE, 'string')) v(name, required, kind)""")
def q_table_schema(spark, folder):
    declared = schema.table_schema("trade_cal")
    rows = load(spark, folder, "orders").groupBy(F.col("o_orderpriority").alias("exchange"), v.day("o_orderdate").alias("cal_date")).agg(F.count("*").alias("is_open"))
    held = rows.agg(*(F.count(f.name).alias(f.name) if f.name in rows.columns else F.lit(0).cast("long").alias(f.name) for f in declared.fields))
    told = F.array(*(F.struct(F.lit(f.name).alias("name"), F.lit(f.name in declared.required).alias("required"), F.lit(f.type.simpleString()).alias("kind"), F.col(f.name).alias("n_held")) for f in declared.fields))
    return held.select(F.inline(told))


# --- text, sheets and pages


@query("SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, strftime(o.d, '%Y-%m-%d') AS trade_date FROM customer JOIN (SELECT o_custkey, max(o_orderdate) AS d FROM orders GROUP BY 1) o ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING' AND o.d >= '1998-01-01'")
def q_read_csv(spark, folder):
    target = scratch(spark, "csv")
    last = load(spark, folder, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.date_format(F.max("o_orderdate"), "yyyy-MM-dd").alias("trade_date"))
    load(spark, folder, "customer").join(last, "c_custkey").select("c_custkey", "c_name", "c_mktsegment", "trade_date").write.option("header", True).csv(target)
    return formats.read_csv(spark, target, {"c_mktsegment": "BUILDING", "start_date": "19980101"}).select("c_custkey", "c_name", "trade_date")


def _put(spark: SparkSession, path: str, content: bytes) -> None:
    """A small file, wherever Spark's paths lead."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(at)
    out.write(bytearray(content))
    out.close()


@query("SELECT n_nationkey AS row_index, n_name AS name, CASE WHEN n_regionkey % 2 = 0 THEN CAST(n_regionkey AS VARCHAR) END AS region FROM nation")
def q_read_xlsx(spark, folder):
    # the table of nations is a fixed 25 rows
    space = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rows = load(spark, folder, "nation").orderBy("n_nationkey").collect()
    cells = "".join(f'<row><c r="A{i}" t="inlineStr"><is><t>{r.n_name}</t></is></c>' + (f'<c r="C{i}"><v>{r.n_regionkey}</v></c>' if r.n_regionkey % 2 == 0 else "") + "</row>" for i, r in enumerate(rows, 1))
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as book:
        book.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{space}"><sheetData>{cells}</sheetData></worksheet>')
    path = f"{scratch(spark, 'sheets')}/nations.xlsx"
    _put(spark, path, held.getvalue())
    return formats.read_xlsx(spark, path).select("row_index", F.get("cells", 0).alias("name"), F.get("cells", 2).alias("region"))


@query("SELECT p_partkey, i AS row_index, CASE i WHEN 0 THEN 'key' ELSE CAST(p_partkey AS VARCHAR) END AS first, CASE i WHEN 0 THEN 'name' ELSE p_name END AS second FROM part, (SELECT unnest([0, 1]) AS i)")
def q_html_tables(spark, folder):
    page = F.concat(F.lit("<p>x<table class=t><tr><th>key</th><th> name</th></tr>\n<TR><td>"), F.col("p_partkey").cast("string"), F.lit("</td><td><b>"), "p_name", F.lit("</b></td></TR></table>"))
    out = formats.html_tables(load(spark, folder, "part").select("p_partkey", page.alias("html")))
    return out.select("p_partkey", "row_index", F.get("cells", 0).alias("first"), F.get("cells", 1).alias("second"))


@query("SELECT CAST(c_nationkey AS INTEGER) AS market_id, lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS code, nullif(c_mktsegment, '') AS segment, c_name AS name FROM customer WHERE c_custkey % 5 > 0")
def q_read_stats(spark, folder):
    target = scratch(spark, "stats")
    long = F.concat_ws("|", F.col("c_nationkey").cast("string"), F.col("c_custkey").cast("string"), "c_mktsegment", F.concat(F.lit(" "), "c_name"), *([F.lit("0")] * 33))
    # every fifth line is too short to count
    load(spark, folder, "customer").select(F.when(F.col("c_custkey") % 5 > 0, long).otherwise("1|2").alias("value")).write.text(target)
    return formats.read_stats(spark, target, {2: "segment", 3: "name"})


@query("SELECT o_orderkey, j AS report_index, i AS item_index, o_orderkey * 10 + j * 3 + i AS item FROM orders, (SELECT unnest([0, 1]) AS j), (SELECT unnest([0, 1]) AS i)")
def q_nested_items(spark, folder):
    report = lambda j: F.struct(F.array(*(F.col("o_orderkey") * 10 + j * 3 + i for i in range(3))).alias("items"))
    rows = load(spark, folder, "orders").select("o_orderkey", F.array(*map(report, range(3))).alias("reports"))
    return formats.nested_items(rows, "reports", "items", 2, 2).select("o_orderkey", "report_index", "item_index", "item")


# --- interfaces


def yearly(params: Mapping, offset: int = 0, size: int = 0) -> list[dict]:
    """A fetcher: 25 rows of a year, in pages; every page repeats the last row of the one before."""
    first = max(0, offset - 1) if size else 0
    return [{"year": params["year"], "k": k, "note": None} for k in range(first, min(25, offset + (size or 25)))]


def _registry() -> gateway.Registry:
    registry = gateway.Registry()
    given = lambda provider, trust, fetcher: gateway.Interface("yearly", fetcher, {"year": "integer", "k": "integer", "note": "string"}, {"year": "array"}, ("year",), ("year", "k"), provider, trust)
    registry.add(given("builtin", 0, "nowhere:nothing"))
    registry.add(given("trusted", 2, f"{HERE}:yearly"))
    return registry


@query("SELECT y.year AS year, CAST(k AS BIGINT) AS k FROM (SELECT DISTINCT CAST(year(o_orderdate) AS BIGINT) AS year FROM orders) y, (SELECT unnest(range(25)) AS k)")
def q_request_fans_out(spark, folder):
    low, high = load(spark, folder, "orders").agg(F.min(v.day("o_orderdate")), F.max(v.day("o_orderdate"))).first()
    return gateway.request(spark, _registry().get("yearly"), {"year": gateway.years(low, high)}, ["year", "k"], fanout="year", page_size=10)


@query("SELECT o_orderstatus AS status, 'trusted' AS chosen, count(*) AS n, CASE WHEN o_orderstatus = 'F' THEN count(*) ELSE 0 END AS n_forced FROM orders GROUP BY 1")
def q_registry_choice(spark, folder):
    # the trusted provider gives all orders, the one that is chosen by name only those that are filled
    registry = gateway.Registry()
    fields = {"o_orderkey": "integer", "o_orderstatus": "string"}
    for provider, trust, entry in (("builtin", 0, "nowhere:nothing"), ("filled", 1, f"{HERE}:filled_rows"), ("trusted", 2, f"{HERE}:order_rows")):
        registry.add(gateway.Interface("orders", entry, fields, {"path": "string", "year": "array"}, ("path",), ("o_orderkey",), provider, trust))
    low, high = load(spark, folder, "orders").agg(F.min(v.day("o_orderdate")), F.max(v.day("o_orderdate"))).first()
    asked = {"path": f"{folder}/orders.parquet", "year": gateway.years(low, high)}
    chosen = registry.get("orders")
    rows = gateway.request(spark, chosen, asked, fanout="year")
    registry.chosen["orders"] = "filled"
    forced = gateway.request(spark, registry.get("orders"), asked, ["o_orderkey"], fanout="year").withColumn("forced", F.lit(True))
    both = rows.join(forced, "o_orderkey", "left").groupBy(F.col("o_orderstatus").alias("status"))
    return both.agg(F.lit(chosen.provider).alias("chosen"), F.count("*").alias("n"), F.count_if("forced").alias("n_forced"))


def segments(spark: SparkSession, folder: str) -> dict:
    """An entry point that gives its rows, as a plan, under a name."""
    return {"records": load(spark, folder, "customer").groupBy(F.col("c_mktsegment").alias("segment")).agg(F.count("*").alias("n"))}


@query("SELECT c_mktsegment AS segment, count(*) AS n FROM customer GROUP BY 1")
def q_run_entry(spark, folder):
    return gateway.run_entry(spark, f"{HERE}:segments", "segment string, n long", folder=folder, unused=1)


@query("SELECT c_custkey, CAST(NULL AS VARCHAR) AS absent, c_name FROM customer")
def q_projected(spark, folder):
    return gateway.projected(load(spark, folder, "customer"), ["c_custkey", "absent", "c_name"])


def order_rows(params: Mapping) -> Iterator[dict]:
    """A fetcher over a table's files that filters by itself: only the columns of the interface, only row groups that may pass.

    A row group is decoded a few thousand rows at a time and its columns are read
    through small buffers, so memory depends on neither files nor row groups.
    """
    import pyarrow as pa
    import pyarrow.dataset as ds
    import pyarrow.parquet as pq

    marks = {"=": "__eq__", ">": "__gt__", ">=": "__ge__", "<": "__lt__", "<=": "__le__"}
    wanted = ds.field("o_orderdate") >= pd.Timestamp(params["year"], 1, 1)
    wanted &= ds.field("o_orderdate") < pd.Timestamp(params["year"] + 1, 1, 1)
    for name, operator, value in params.get("filters", []):
        wanted &= ds.field(name).isin(value) if operator == "in" else getattr(ds.field(name), marks[operator])(value)
    columns = ["o_orderkey", "o_orderstatus", "o_totalprice"]
    for fragment in ds.dataset(params["path"]).get_fragments(filter=wanted):
        groups = [g.id for part in fragment.split_by_row_group(filter=wanted) for g in part.row_groups]
        with fragment.filesystem.open_input_file(fragment.path) as source, pq.ParquetFile(source, buffer_size=1 << 20, pre_buffer=False) as file:
            for batch in file.iter_batches(8192, groups, [*columns, "o_orderdate"], use_threads=False) if groups else ():
                for row in pa.Table.from_batches([batch]).filter(wanted).select(columns).to_pylist():
                    yield row | {"year": params["year"]}


def filled_rows(params: Mapping) -> Iterator[dict]:
    """The same for filled orders alone."""
    return order_rows(dict(params) | {"filters": [("o_orderstatus", "=", "F")]})


@query("SELECT CAST(year(o_orderdate) AS BIGINT) AS year, o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE year(o_orderdate) >= 1997 AND year(o_orderdate) <> 1999 AND o_orderstatus IN ('F', 'O') AND o_totalprice > 200000 AND o_orderkey % 2 = 0")
def q_source_filters(spark, folder):
    fields = {"year": "integer", "o_orderkey": "integer", "o_orderstatus": "string", "o_totalprice": "number"}
    source = gateway.Interface("orders", f"{HERE}:order_rows", fields, {"path": "string", "year": "array"}, ("path",), filters=("o_orderstatus", "o_totalprice"))
    low, high = load(spark, folder, "orders").agg(F.min(v.day("o_orderdate")), F.max(v.day("o_orderdate"))).first()
    asked = [("year", ">=", 1997), ("o_orderstatus", "in", ["F", "O"]), ("o_totalprice", ">", 200_000.0)]
    rows = gateway.request(spark, source, {"path": f"{folder}/orders.parquet", "year": gateway.years(low, high)}, fanout="year", where=asked)
    return rows.where("year <> 1999 and o_orderkey % 2 = 0")


# --- table functions


def _ticks_view(spark: SparkSession, folder: str) -> str:
    """A view of the events under a name of its own."""
    name = f"ticks_{uuid.uuid4().hex}"
    load(spark, folder, "events").selectExpr("event_id", "user_id", "ts", "value", "value > 50 AS up").createOrReplaceTempView(name)
    table_functions.register(spark)
    return name


@query("SELECT user_id, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r <= 5")
def q_tail_function(spark, folder):
    view = _ticks_view(spark, folder)
    return spark.sql(f"SELECT user_id, event_id, value FROM tail_rows(TABLE({view}) PARTITION BY user_id ORDER BY (ts, event_id), n => 5)")


@query("WITH f AS (SELECT *, value > 50 AS up, sum(CASE WHEN value > 50 THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS k FROM events) SELECT event_id, CAST(sum(CASE WHEN up THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, k ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS streak FROM f")
def q_streak_function(spark, folder):
    view = _ticks_view(spark, folder)
    return spark.sql(f"SELECT event_id, streak FROM streak_rows(TABLE({view}) PARTITION BY user_id ORDER BY (ts, event_id), flag => 'up')")


@query("SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(year(o_orderdate) AS BIGINT) AS year FROM orders WHERE o_orderstatus = 'F'")
def q_entry_function(spark, folder):
    table_functions.register(spark)
    name = f"years_{uuid.uuid4().hex}"
    years = load(spark, folder, "orders").select(F.year("o_orderdate").cast("long").alias("year")).distinct()
    years.selectExpr(f"'{folder}/orders.parquet' AS path", "year", "array(array('o_orderstatus', '=', 'F')) AS filters").createOrReplaceTempView(name)
    return spark.sql(f"SELECT o_orderkey, year FROM entry_rows(TABLE({name}), entry => '{HERE}:order_rows', fields => 'o_orderkey long, year long')")


# --- packed payloads


def _lists(spark: SparkSession, folder: str, value: Column) -> DataFrame:
    """Each order's values of its items, by line number."""
    items = F.array_sort(F.collect_list(F.struct(F.col("l_linenumber").alias("n"), value.cast("long").alias("v"))))
    return load(spark, folder, "lineitem").groupBy("l_orderkey").agg(F.transform(items, lambda x: x["v"]).alias("v"))


@query("SELECT l_orderkey, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_extendedprice) - 1 AS INTEGER) AS place, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents FROM lineitem")
def q_unpack_deltas(spark, folder):
    values = _lists(spark, folder, F.round(F.col("l_extendedprice") * 100))
    steps = F.transform("v", lambda x, i: x - F.coalesce(F.get("v", i - 1), F.lit(0)))
    raw = values.select("l_orderkey", packed.pack_varints(steps).alias("raw"))
    return raw.select("l_orderkey", F.posexplode(packed.unpack_varints("raw", deltas=True)).alias("place", "cents"))


@query("SELECT l_orderkey, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_quantity) - 1 AS INTEGER) AS place, CAST(l_quantity AS BIGINT) - 25 AS quantity FROM lineitem")
def q_unpack_bits(spark, folder):
    values = _lists(spark, folder, F.col("l_quantity") - 25)
    raw = values.select("l_orderkey", F.size("v").alias("n"), packed.pack_bits("v", 7).alias("raw"))
    # bits beyond the count are padding
    unpacked = F.slice(packed.unpack_bits("raw", 7, signed=True), F.lit(1), F.col("n"))
    return raw.select("l_orderkey", F.posexplode(unpacked).alias("place", "quantity"))


@query(f"""WITH {v.DAILY_SQL} SELECT instrument, CAST(row_number() OVER (PARTITION BY instrument ORDER BY trade_date) - 1 AS INTEGER) AS place, CAST(trade_date AS BIGINT) AS date_raw, CAST(round(open * 1000) AS BIGINT) AS open_milli, CAST(round(close * 1000) AS BIGINT) AS close_milli, CAST(round(high * 1000) AS BIGINT) AS high_milli, CAST(round(low * 1000) AS BIGINT) AS low_milli, volume FROM daily""")
def q_bar_records(spark, folder):
    milli = lambda c: F.round(F.col(c) * 1000).cast("long").alias(c)
    days = v.daily(spark, folder).select("instrument", "trade_date", *map(milli, ("open", "close", "high", "low")), packed.compact_bits("volume").alias("volume"))
    before = F.coalesce(F.lag("close").over(Window.partitionBy("instrument").orderBy("trade_date")), F.lit(0))
    steps = F.array(F.col("open") - before, *(F.col(c) - F.col("open") for c in ("close", "high", "low")))
    days = days.withColumn("steps", steps).select("instrument", "trade_date", F.concat(packed.little_endian(F.col("trade_date"), 4), packed.pack_varints("steps"), packed.little_endian(F.col("volume"), 4), packed.little_endian(F.lit(0), 4)).alias("one"))
    whole = F.array_sort(F.collect_list(F.struct("trade_date", "one")))
    raw = days.groupBy("instrument").agg(whole.alias("all")).select("instrument", F.concat(packed.little_endian(F.size("all"), 2), F.aggregate("all", F.lit(b""), lambda a, x: F.concat(a, x["one"]))).alias("raw"))
    return packed.bar_records(raw, "raw", ["instrument"]).drop("minute", "amount")


# --- sinks and write modes


@query("SELECT f AS form, n, s AS keys FROM (SELECT count(*) AS n, CAST(sum(c_custkey) AS BIGINT) AS s FROM customer), (SELECT unnest(['parquet', 'csv', 'jsonl', 'duckdb']) AS f)")
def q_write_outputs(spark, folder):
    import duckdb

    out = writers.write_outputs(load(spark, folder, "customer"), scratch(spark, "outputs"), "customer", ("parquet", "csv", "jsonl", "duckdb"))
    read = {"parquet": spark.read.parquet, "csv": spark.read.option("header", True).csv, "jsonl": spark.read.json}
    counts = [F.count("*").alias("n"), F.sum(F.col("c_custkey").cast("long")).alias("keys")]
    frames = [how(out[form]).agg(*counts).select(F.lit(form).alias("form"), "n", "keys") for form, how in read.items()]
    with duckdb.connect(out["duckdb"].removeprefix("file:").replace("//", "/"), read_only=True) as db:
        own = db.execute("SELECT count(*), CAST(sum(c_custkey) AS BIGINT) FROM customer").fetchone()
    return _union([*frames, _rows(spark, "form string, n long, keys long", ("duckdb", *own))])


@query("SELECT o_orderstatus AS dataset, 'ok' AS status, CAST(n AS VARCHAR) AS updated_at FROM (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1)")
def q_run_log(spark, folder):
    target = scratch(spark, "runs")
    # one run for each state of an order
    states = load(spark, folder, "orders").groupBy("o_orderstatus").count()
    writers.write_run_log(states.select(F.col("o_orderstatus").alias("dataset"), F.concat(F.lit(f"{target}/"), "o_orderstatus").alias("path"), F.lit("ok").alias("status"), F.col("count").cast("string").alias("updated_at")), target)
    return catalog.run_log(spark, target).select("dataset", "status", "updated_at")


@query("SELECT 'trade_cal' AS dataset, 'core' AS status UNION ALL SELECT 'held', 'declared'")
def q_datasets(spark, folder):
    root = scratch(spark, "catalog")
    days = load(spark, folder, "orders").select(F.lit("SSE").alias("exchange"), v.day("o_orderdate").alias("cal_date"), F.lit(1).alias("is_open")).distinct()
    writers.write_core_table(days, "trade_cal", root)
    return catalog.datasets(spark, root, None, {"held": f"{root}/core", "gone": f"{root}/nowhere"}).select("dataset", "status")


@query("SELECT o_orderkey, o_orderstatus AS state, CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderkey AS VARCHAR) || '.5' END AS price, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders")
def q_json_rows(spark, folder):
    price = F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderkey") + 0.5).otherwise(F.lit(float("nan")))
    rows = load(spark, folder, "orders").select("o_orderkey", "o_orderstatus", price.alias("price"), F.to_date("o_orderdate").alias("day"))
    part = lambda n: F.get_json_object("json", f"$.{n}")
    plain = part("price").cast("double").cast("decimal(20, 1)").cast("string")
    return writers.json_rows(rows).select(part("o_orderkey").cast("long").alias("o_orderkey"), part("o_orderstatus").alias("state"), plain.alias("price"), part("day").alias("day"))


def _written(spark: SparkSession, folder: str, name: str, which: str = "o_orderkey % 3 > 0") -> tuple[str, DataFrame]:
    """Two thirds of the orders, or others, partitioned by their state; and all of them."""
    target = scratch(spark, name)
    rows = load(spark, folder, "orders").select("o_orderkey", "o_orderstatus", v.day("o_orderdate").alias("day"), "o_totalprice")
    writers.write(rows.where(which), target, "snapshot", partition_by=["o_orderstatus"])
    return target, rows


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def q_append_partitioned(spark, folder):
    target, rows = _written(spark, folder, "append")
    writers.write(rows.where("o_orderkey % 3 = 0"), target, "append", partition_by=["o_orderstatus"])
    return writers.read_written(spark, target).select("o_orderkey", "o_orderstatus", "o_totalprice")


@query("SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CASE WHEN o_orderkey % 2 = 0 OR o_orderkey % 3 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders")
def q_upsert_partitioned(spark, folder):
    target, rows = _written(spark, folder, "upsert")
    # orders are moved to another partition, or come if they weren't there
    writers.write(rows.where("o_orderkey % 2 = 0 or o_orderkey % 3 = 0").withColumn("o_orderstatus", F.lit("X")), target, "upsert_by_key", key=["o_orderkey"], partition_by=["o_orderstatus"])
    return writers.read_written(spark, target).select("o_orderkey", "o_orderstatus")


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 3 = 0 OR strftime(o_orderdate, '%Y') <> '1997'")
def q_replace_range_partitioned(spark, folder):
    target, rows = _written(spark, folder, "range", "o_orderkey % 3 > 0 or day not like '1997%'")
    writers.write(rows.where("o_orderkey % 3 = 0 and day like '1997%'"), target, "replace_range", partition_by=["o_orderstatus"], date_field="day", start="1997-01-01", end="1997-12-31")
    return writers.read_written(spark, target).select("o_orderkey", "o_orderstatus")


@query("SELECT 'F' AS label, count(*) AS n FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT 'O', NULL UNION ALL SELECT 'P', NULL")
def q_delete_dataset(spark, folder):
    root = scratch(spark, "delete")
    for state in "FOP":
        writers.staged(load(spark, folder, "orders").where(F.col("o_orderstatus") == state), f"{root}/{state}")
    for state in ("O", "P"):
        writers.delete_dataset(spark, root, state)
    left = [spark.read.parquet(f"{root}/{s}").agg(F.lit(s).alias("label"), F.count("*").alias("n")) if layout.exists(spark, f"{root}/{s}") else _rows(spark, "label string, n long", (s, None)) for s in "FOP"]
    return _union(left)


@query("SELECT o_orderpriority AS exchange, strftime(o_orderdate, '%Y%m%d') AS cal_date, CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderkey AS VARCHAR) END AS is_open FROM orders")
def q_typed(spark, folder):
    rows = load(spark, folder, "orders").select(F.col("o_orderpriority").alias("exchange"), v.day("o_orderdate").alias("cal_date"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderkey").cast("string")).otherwise("closed").alias("is_open"), "o_custkey")
    out = writers.typed(rows, "trade_cal")
    return out.select("exchange", "cal_date", F.when(F.typeof("is_open") == "bigint", F.col("is_open").cast("string")).alias("is_open"))


@query("SELECT 'meta' AS source, '20240105' AS day UNION ALL SELECT 'rows', (SELECT strftime(max(o_orderdate), '%Y%m%d') FROM orders) UNION ALL SELECT 'today', '20240109'")
def q_snapshot_date(spark, folder):
    rows = load(spark, folder, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("trade_date"))
    last = rows.agg(F.max("trade_date").alias("trade_date"))
    found = (("meta", writers.snapshot_date(rows, {"trade_date": "2024-01-05"}, "20240109")), ("rows", writers.snapshot_date(last, {}, "20240109")), ("today", writers.snapshot_date(rows, {}, "2024-01-09")))
    return _rows(spark, "source string, day string", *found)


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS day, 'k-' || o_orderkey AS plain, strftime(o_orderdate, '%Y%m%d') AS legacy FROM orders")
def q_key_text(spark, folder):
    written = F.date_format("o_orderdate", "yyyy-MM-dd")
    minute = F.concat(written, F.lit(" 09:30"))
    return load(spark, folder, "orders").select("o_orderkey", writers.key_text(written, True).alias("day"), writers.key_text(F.concat(F.lit("k-"), F.col("o_orderkey").cast("string")), False).alias("plain"), writers.key_text(minute, False, legacy=True).alias("legacy"))


# --- filters


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_custkey IN (1, 2, 4, 7, 11)")
def q_parsed_filters(spark, folder):
    asked = tables.parsed_filters(["o_orderstatus=F", '{"o_custkey": [1, 2, 4, 7, 11]}'])
    return tables.filtered(load(spark, folder, "orders"), asked).select("o_orderkey", "o_custkey")


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'O' AND strftime(o_orderdate, '%Y%m%d') >= '19970101'")
def q_merged_filters(spark, folder):
    asked, start, end = tables.merged_filters({"o_orderstatus": "O", "start_date": "1997-01-01", "unset": None}, {"o_orderstatus": "F"})
    rows = load(spark, folder, "orders").withColumn("day", v.day("o_orderdate"))
    return tables.filtered(rows, asked, "day", start, end).select("o_orderkey", "o_orderstatus")


@query(f"WITH {v.SECURITY_SQL} SELECT 'instrument_id' AS field, count(*) AS n FROM security WHERE tdx_code LIKE 'sh%'")
def q_symbol_field(spark, folder):
    rows = v.security(spark, folder).withColumns({"symbol": F.substring("tdx_code", 3, 6), "instrument_id": F.col("tdx_code")})
    name = tables.symbol_field(rows.columns)
    return rows.where(F.col(name).startswith("sh")).agg(F.lit(name).alias("field"), F.count("*").alias("n")).select("field", "n")


@query("SELECT 'preview' AS kind, least(100, (SELECT count(*) FROM orders)) AS n UNION ALL SELECT 'least', 1 UNION ALL SELECT 'default', 3")
def q_clamped_limit(spark, folder):
    rows = load(spark, folder, "orders").select("o_orderkey")
    frames = [tables.preview(rows, limit=limit).agg(F.lit(kind).alias("kind"), F.count("*").alias("n")) for kind, limit in (("preview", 5000), ("least", -3), ("default", None))]
    return _union(frames)


@query(f"WITH {v.SECURITY_SQL} SELECT ordinal, tdx_code FROM security WHERE tdx_code LIKE 'sh600%' OR tdx_code LIKE 'bj%'")
def q_filter_board(spark, folder):
    return filters.by_board(v.security(spark, folder), ["sse_main_board", "bse_listed_stock"]).select("ordinal", "tdx_code")


@query("SELECT c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')")
def q_stocks_only(spark, folder):
    kind = F.when(F.col("c_mktsegment") == "BUILDING", "a_share").when(F.col("c_mktsegment") == "MACHINERY", "cdr").when(F.col("c_mktsegment") == "FURNITURE", "b_share")
    return filters.stocks_only(load(spark, folder, "customer").withColumn("tdx_category", kind)).select("c_custkey")


@query("SELECT p_partkey, 'official_index' AS index_type FROM part WHERE p_partkey % 4 < 2")
def q_filter_indexes(spark, folder):
    head = F.get(F.array(*map(F.lit, ("sh000", "sz399", "sh880", "sz000"))), (F.col("p_partkey") % 4).cast("int"))
    rows = load(spark, folder, "part").select("p_partkey", F.concat(head, F.lpad((F.col("p_partkey") % 1000).cast("string"), 3, "0")).alias("tdx_code"))
    return filters.indexes_of(rows, "official_index").select("p_partkey", "index_type")


@query("SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN 'sse_etf' ELSE 'szse_etf' END AS etf_type FROM part WHERE p_partkey % 4 < 2")
def q_filter_etfs(spark, folder):
    head = F.get(F.array(*map(F.lit, ("sh510", "sz159", "sh600", "sz000"))), (F.col("p_partkey") % 4).cast("int"))
    rows = load(spark, folder, "part").select("p_partkey", F.concat(head, F.lpad((F.col("p_partkey") % 1000).cast("string"), 3, "0")).alias("tdx_code"))
    return filters.etfs(rows).select("p_partkey", "etf_type")


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_linenumber IN (1, 5)")
def q_filter_category(spark, folder):
    return filters.by_category(load(spark, folder, "lineitem"), ["Dividend", 5], "l_linenumber").select("l_orderkey", "l_linenumber")


@query("SELECT o_orderkey FROM orders WHERE strftime(o_orderdate, '%Y') BETWEEN '1994' AND '1996'")
def q_filter_years(spark, folder):
    rows = load(spark, folder, "orders").withColumn("day", F.date_format("o_orderdate", "yyyy-MM-dd"))
    return filters.in_years(rows, "day", "1994", "1996").select("o_orderkey")


@query("SELECT o_orderkey, k FROM orders, (SELECT unnest(['dated', 'free']) AS k) WHERE k = 'free' OR strftime(o_orderdate, '%Y%m%d') BETWEEN '19970301' AND '19970531'")
def q_filter_dataset(spark, folder):
    rows = load(spark, folder, "orders").withColumn("day", F.date_format("o_orderdate", "yyyy-MM-dd"))
    return _union([filters.by_dataset(rows, k, {"dated": "day"}, "1997-03-01", "1997-05-31").select("o_orderkey", F.lit(k).alias("k")) for k in ("dated", "free")])


@query("SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority LIKE '%URGENT%'")
def q_filter_direction(spark, folder):
    return filters.by_direction(load(spark, folder, "orders"), "URGENT", "o_orderpriority").select("o_orderkey", "o_orderpriority")


@query(f"WITH {v.SECURITY_SQL} SELECT ordinal FROM security WHERE NOT regexp_matches(upper(trim(name)), '^\\*?ST') AND (ordinal % 3 = 0 OR size - 10 > 1)")
def q_without_pennies(spark, folder):
    rows = v.security(spark, folder).withColumn("last_price", F.when(F.col("ordinal") % 3 != 0, F.col("size") - 10))
    return filters.without_pennies(rows).select("ordinal")


@query("SELECT event_id FROM events WHERE strftime(ts, '%H:%M') = '09:25'")
def q_opening_auction(spark, folder):
    return filters.opening_auction(load(spark, folder, "events").withColumn("trade_time", F.date_format("ts", "HH:mm"))).select("event_id")


@query("SELECT p_partkey FROM part WHERE upper(p_brand) IN ('BRAND#11', 'BRAND#13', 'BRAND#22') AND (lower(p_name) LIKE '%ring%' OR lower(p_name) LIKE '%bolt%')")
def q_filter_instruments(spark, folder):
    rows = load(spark, folder, "part").withColumns({"symbol": F.col("p_brand"), "name": F.col("p_name"), "asset_type": F.lit("Stock"), "exchange": F.lit("SSE")})
    return filters.instruments(rows, ["stock"], ["sse"], ["brand#11", "Brand#13", "BRAND#22"], ["RING", "bolt"]).select("p_partkey")


@query("SELECT p_partkey, p_partkey % 3 <> 2 AS noise FROM part")
def q_noise_topics(spark, folder):
    topic = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("msci "), "p_name")).when(F.col("p_partkey") % 3 == 1, " ").otherwise(F.col("p_name"))
    return load(spark, folder, "part").select("p_partkey", filters.is_noise(topic).alias("noise"))


@query("SELECT event_id FROM events WHERE (event_id & 5) <> 0")
def q_filter_rank_flags(spark, folder):
    return filters.with_bits(load(spark, folder, "events"), "event_id", filters.rank_mask(["ST", "次新"])).select("event_id")


@query("SELECT o_orderkey FROM orders WHERE o_totalprice >= 250000")
def q_above(spark, folder):
    return ranking.above(load(spark, folder, "orders"), "o_totalprice", 250_000).select("o_orderkey")


@query("SELECT c_custkey, row_number() OVER (ORDER BY u DESC NULLS LAST, c_name DESC) AS place FROM (SELECT c_custkey, c_name, CASE WHEN c_custkey % 4 > 0 THEN CAST(c_acctbal AS VARCHAR) END AS u FROM customer)")
def q_dataset_order(spark, folder):
    rows = load(spark, folder, "customer").select("c_custkey", F.col("c_name").alias("dataset"), F.when(F.col("c_custkey") % 4 > 0, F.col("c_acctbal").cast("string")).alias("updated_at"))
    return ranking.ranked(rows, ranking.dataset_order(), name="place").select("c_custkey", F.col("place").cast("long").alias("place"))


@query(f"WITH {v.CALENDAR_SQL} SELECT exchange, cal_date FROM calendar WHERE is_open = 1")
def q_open_dates(spark, folder):
    return calendar.open_dates(v.calendar(spark, folder).withColumn("is_open", F.when(F.col("is_open") == 1, "Yes").otherwise("0")))


@query("SELECT CASE p_partkey % 4 WHEN 0 THEN 'stats_row_missing' WHEN 1 THEN 'same_day' WHEN 2 THEN 'previous_trading_day' ELSE 'stats_date_unaligned' END AS indicator_status, count(*) AS n FROM part GROUP BY 1")
def q_alignment_counts(spark, folder):
    stats = F.get(F.array(F.lit(None), F.lit("20240103"), F.lit("20240102"), F.lit("20231229")), (F.col("p_partkey") % 4).cast("int"))
    rows = load(spark, folder, "part").withColumn("indicator_status", snapshot.stats_alignment(F.lit("20240103"), F.lit("20240102"), stats))
    return snapshot.alignment_counts(rows)


@query("SELECT p_partkey, p_retailprice AS bid1_price, CAST(p_size AS DOUBLE) AS bid1_volume, p_retailprice + 1 AS ask1_price, CAST(NULL AS DOUBLE) AS ask2_price FROM part")
def q_widened_book(spark, folder):
    side = lambda price: F.array(F.struct(price.alias("price"), F.col("p_size").cast("double").alias("volume")))
    rows = load(spark, folder, "part").withColumns({"bid_levels": side(F.col("p_retailprice")), "ask_levels": side(F.col("p_retailprice") + 1)})
    return snapshot.widened(rows, "levels").select("p_partkey", "bid1_price", "bid1_volume", "ask1_price", "ask2_price")


@query("SELECT l_orderkey, l_linenumber, round(l_extendedprice * l_quantity * 100, 6) AS amount FROM lineitem")
def q_auction_amount(spark, folder):
    return load(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", snapshot.auction_amount("l_extendedprice", "l_quantity").alias("amount"))


@query(f"WITH {v.SECURITY_SQL} SELECT ordinal, substr(tdx_code, 3) || '.' || upper(substr(tdx_code, 1, 2)) AS instrument_id FROM security WHERE tdx_code LIKE 'sz%'")
def q_instrument_id(spark, folder):
    return v.security(spark, folder).where(F.col("tdx_code").startswith("sz")).select("ordinal", codes.instrument_id("tdx_code").alias("instrument_id"))


# --- quality reports


@query("SELECT 'error' AS status, 'absent' AS missing, 'o_clerk,o_comment' AS unexpected, count(*) AS n FROM orders")
def q_schema_check(spark, folder):
    rows = load(spark, folder, "orders").select("o_orderkey", "o_custkey", F.lit("").alias("o_clerk"), F.lit("").alias("o_comment"))
    found = quality.schema_check(rows, ["o_orderkey", "absent"], ["o_orderkey", "o_custkey"])
    told = (F.lit(x).alias(n) for n, x in (("status", found["status"]), ("missing", ",".join(found["missing"])), ("unexpected", ",".join(found["unexpected"]))))
    return rows.agg(*told, F.count("*").alias("n"))


@query("SELECT 'missing_value' AS status, count(*) FILTER (WHERE o_custkey % 50 = 0) AS n_null, (SELECT coalesce(sum(n), 0)::BIGINT FROM (SELECT count(*) AS n FROM orders GROUP BY nullif(o_custkey % 50, 0), o_orderstatus HAVING count(*) > 1)) AS n_duplicate_rows FROM orders")
def q_key_check(spark, folder):
    rows = load(spark, folder, "orders").select(F.nullif(F.col("o_custkey") % 50, F.lit(0)).alias("k"), "o_orderstatus")
    found = quality.key_check(rows, ["k", "o_orderstatus"])
    return _rows(spark, "status string, n_null long, n_duplicate_rows long", (found["status"], found["n_null"], found["n_duplicate_rows"]))


@query(f"""WITH {v.DAILY_SQL} SELECT 'error' AS status, 'pass' AS key_status, count(*) FILTER (WHERE amount - 100 < 0) AS n_negative, min(trade_date) AS min_date, max(trade_date) AS max_date FROM daily""")
def q_quality_report(spark, folder):
    rows = v.daily(spark, folder).withColumn("amount", F.col("amount") - 100)
    report = quality.evaluate(rows, ["instrument", "trade_date"], ["close"], rows.columns, ["amount"], "trade_date")
    return _rows(spark, "status string, key_status string, n_negative long, min_date string, max_date string", (report["status"], report["key"]["status"], report["rules"]["negative_amount"], report["dates"]["min_date"], report["dates"]["max_date"]))


@query("""WITH r AS (SELECT o_orderpriority AS exchange, strftime(o_orderdate, '%Y%m%d') AS cal_date, CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey END AS is_open FROM orders)
SELECT 'missing_required' AS issue, 'is_open' AS columns, count(*) AS n FROM r WHERE is_open IS NULL UNION ALL SELECT 'primary_key_duplicates', 'exchange,cal_date', CAST(sum(n) AS BIGINT) FROM (SELECT count(*) AS n FROM r GROUP BY exchange, cal_date HAVING count(*) > 1)""")
def q_validate_table(spark, folder):
    rows = load(spark, folder, "orders").select(F.col("o_orderpriority").alias("exchange"), v.day("o_orderdate").alias("cal_date"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderkey")).alias("is_open"))
    issues = quality.validate_table(rows, "trade_cal")
    return _rows(spark, "issue string, columns string, n long", *((i["issue"], ",".join(i["columns"]), i.get("n")) for i in issues))


@query("SELECT unnest(['second: its date covers too few rows', 'second: keys repeat']) AS against")
def q_resource_checks(spark, folder):
    one = load(spark, folder, "customer").select((F.col("c_custkey") % 2).alias("market_id"), F.col("c_custkey").alias("code"), F.lit("20240102").alias("stats_date"))
    # the second table repeats itself, half of it a day earlier and later by turns
    late = F.when(F.col("code") % 3 == 0, "20231229").otherwise("20240102")
    two = one.unionByName(one).withColumn("stats_date", late)
    return _rows(spark, "against string", *((a,) for a in quality.resource_checks(one, two, least=1)))


@query(f"WITH {v.CALENDAR_SQL} SELECT TRUE AS inside, FALSE AS beyond")
def q_calendar_gate(spark, folder):
    days = v.calendar(spark, folder)
    return _rows(spark, "inside boolean, beyond boolean", (quality.covers(days, "1996-02-01", "2000-02-01"), quality.covers(days, "2001-06-01", "2099-01-02")))


# --- streams


def quotes(asked: Sequence[str], cursors: Mapping[str, int]) -> list[dict]:
    """A fetcher: each code moves on by one until it has moved three times."""
    return [{"instrument_id": c, "last_price": 10.0 + cursors[c], "update_time_raw": cursors[c] + 1} for c in asked if cursors[c] < 3]


_QUOTES = "instrument_id string, last_price double, update_time_raw long"


def _drained(spark: SparkSession, updates: DataFrame, first: DataFrame) -> DataFrame:
    """A snapshot and all updates until none is left, as public rows in the order of their batches."""
    out = scratch(spark, "quotes")

    def sink(rows: DataFrame, batch: int) -> None:
        refresh.public(rows).withColumn("batch", F.lit(batch)).write.mode("append").parquet(out)

    running = refresh.start(updates, sink, scratch(spark, "state"), first, interval=500)
    running.processAllAvailable()
    running.stop()
    return spark.read.schema("instrument_id string, last_price double, batch int").parquet(out)


@query("SELECT n_name AS instrument_id, k + 9.0::DOUBLE AS last_price, k = 0 AS snapshot FROM nation, (SELECT unnest([0, 1, 2, 3]) AS k)")
def q_stream_subscription(spark, folder):
    # a subscription holds at most a hundred codes: the 25 nations
    names = [r.n_name for r in load(spark, folder, "nation").collect()]
    first = _rows(spark, _QUOTES, *((n, 9.0, 0) for n in names))
    rows = _drained(spark, refresh.subscribe(spark, f"{HERE}:quotes", names, _QUOTES), first)
    return rows.select("instrument_id", "last_price", (F.col("batch") == -1).alias("snapshot"))


@query("SELECT n_name AS instrument_id, CAST(k AS DOUBLE) + 10 AS last_price FROM nation, (SELECT unnest([0, 1, 2]) AS k)")
def q_stream_bounded_batches(spark, folder):
    names = [r.n_name for r in load(spark, folder, "nation").collect()]
    rows = _drained(spark, refresh.subscribe(spark, f"{HERE}:quotes", names, _QUOTES, most_rows=4), _rows(spark, _QUOTES))
    return rows.select("instrument_id", "last_price")


@query("SELECT event_id, 'update' AS kind, 'r1' AS request_id, user_id FROM events")
def q_stream_events(spark, folder):
    rows = refresh.events(refresh.public(load(spark, folder, "events").withColumn("update_time_raw", F.lit(1)).select("event_id", "user_id", "update_time_raw")), "update", "r1")
    part = lambda path: F.get_json_object("event", path)
    return rows.where("event not like '%update_time_raw%'").select(part("$.data.event_id").cast("long").alias("event_id"), part("$.event").alias("kind"), part("$.request_id").alias("request_id"), part("$.data.user_id").cast("long").alias("user_id"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 3000 ELSE greatest(500, CAST(c_custkey * 7 AS INTEGER)) END AS ms FROM customer")
def q_stream_intervals(spark, folder):
    asked = F.when(F.col("c_custkey") % 3 > 0, (F.col("c_custkey") * 7).cast("string")).otherwise("")
    return load(spark, folder, "customer").select("c_custkey", refresh.interval_column(asked).alias("ms"))


@query("SELECT user_id, count(*) AS n FROM events GROUP BY 1")
def q_stream_scheduled(spark, folder):
    source, out, state = scratch(spark, "due"), scratch(spark, "done"), scratch(spark, "state")
    rows = load(spark, folder, "events").select("event_id", "user_id")

    def sink(batch: DataFrame, _: int) -> None:
        batch.write.mode("append").parquet(out)

    # two runs of a scheduler: each takes what came since the last
    for k in (0, 1):
        rows.where(f"event_id % 2 = {k}").write.mode("append").parquet(source)
        refresh.scheduled(spark.readStream.schema(rows.schema).parquet(source), sink, state)
    return spark.read.schema(rows.schema).parquet(out).groupBy("user_id").agg(F.count("*").alias("n"))


@query("""WITH e AS (SELECT *, event_type IN ('error', 'click') AS control FROM events, (SELECT unnest([0, 1, 2]) AS c)),
s AS (SELECT *, last_value(CASE WHEN control AND event_id % 3 = c THEN event_type END IGNORE NULLS) OVER w AS state, last_value(CASE WHEN NOT control THEN event_id END IGNORE NULLS) OVER w AS newest FROM e WINDOW w AS (PARTITION BY user_id, c ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING))
SELECT CAST(user_id AS VARCHAR) AS instrument_id, CAST(c AS VARCHAR) AS client, 'update' AS kind, event_id AS seq, value FROM s WHERE NOT control AND state = 'click'
UNION ALL SELECT CAST(s.user_id AS VARCHAR), CAST(c AS VARCHAR), 'snapshot', newest, q.value FROM s JOIN events q ON q.event_id = s.newest WHERE control AND s.event_type = 'click' AND s.event_id % 3 = c""")
def q_stream_subscriptions(spark, folder):
    # clicks subscribe one of three clients to a user, errors unsubscribe it, all else are quotes
    source, target = scratch(spark, "feed"), scratch(spark, "told")
    rows = load(spark, folder, "events").select(F.col("user_id").alias("instrument_id"), "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("mark"), F.col("event_id").alias("seq"), "value", F.dayofmonth("ts").alias("day"))
    for week in range(4):
        rows.where(f"(day - 1) div 8 = {week}").coalesce(1).write.mode("append").parquet(source)
    feed = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(source)
    kind = F.when(F.col("event_type") == "click", "subscribe").otherwise("unsubscribe")
    asked = feed.where("event_type in ('click', 'error')").select("instrument_id", (F.col("seq") % 3).alias("client"), kind.alias("kind"), "mark", "seq")
    told = refresh.subscriptions(feed.where("event_type not in ('click', 'error')"), asked)
    refresh.scheduled(told, refresh.applied_once(target, "told"), scratch(spark, "state"))
    return writers.read_written(spark, target).select("instrument_id", "client", "kind", "seq", "value")


@query("SELECT event_id, user_id, 'update' AS kind FROM events UNION ALL SELECT max(event_id), user_id, 'snapshot' FROM events GROUP BY user_id")
def q_stream_replay_once(spark, folder):
    source, target, state = scratch(spark, "feed"), scratch(spark, "once"), scratch(spark, "state")
    rows = load(spark, folder, "events").select("event_id", "user_id")
    first = rows.groupBy("user_id").agg(F.max("event_id").alias("event_id")).select("event_id", "user_id", F.lit("snapshot").alias("kind"))
    for part in range(3):
        rows.where(f"event_id % 3 = {part}").coalesce(1).write.mode("append").parquet(source)
    feed = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(source).withColumn("kind", F.lit("update"))
    sink = refresh.applied_once(target, "events")

    def lost(batch: DataFrame, number: int) -> None:
        sink(batch, number)
        if number == 1:
            raise RuntimeError("lost after the commit")

    # the second run repeats batch 1, and begins with the snapshot again
    for way in (lost, sink):
        running = refresh.start(feed, way, state, first, once=True)
        try:
            running.awaitTermination()
        except StreamingQueryException:
            sink(first, -1)
    return writers.read_written(spark, target).select("event_id", "user_id", "kind")


@query(f"WITH {v.CALENDAR_SQL}, o AS (SELECT cal_date FROM calendar WHERE is_open = 1) SELECT cal_date AS after, (SELECT min(b.cal_date) FROM o b WHERE b.cal_date > a.cal_date) || '1530' AS due FROM o a")
def q_next_runs(spark, folder):
    return refresh.next_runs(v.calendar(spark, folder).where("is_open = 1"), "1530").select(F.col("cal_date").alias("after"), "due")


@query("SELECT o_orderkey, json FROM (SELECT o_orderkey, '{\"k\":' || o_orderkey || ',\"n\":null}' AS json FROM orders)")
def q_json_nulls(spark, folder):
    rows = load(spark, folder, "orders").select(F.col("o_orderkey").alias("k"), F.lit(None).cast("double").alias("n"))
    return writers.json_rows(rows).select(F.get_json_object("json", "$.k").cast("long").alias("o_orderkey"), "json")

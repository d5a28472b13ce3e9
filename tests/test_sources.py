"""Layouts, queries, writers and formats on small files."""

import json
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from tickloom import catalog
from tickloom.schema import list_tables, table_schema
from tickloom.sources import formats, gateway, tables, versions, writers
from tickloom.sources.layout import table_files

DAILY = "ts_code string, trade_date string, close double"


def put(spark, rows, path, schema=DAILY):
    """One Parquet file of a given name, as other programs write them."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    os.makedirs(os.path.dirname(path), exist_ok=True)
    names = [c.split()[0] for c in schema.split(",")]
    kinds = {"string": pa.string(), "double": pa.float64(), "long": pa.int64()}
    pq.write_table(pa.table({n: pa.array([r[i] for r in rows], kinds[c.split()[1]]) for i, (n, c) in enumerate(zip(names, schema.split(","), strict=True))}), path)
    return path


ROWS = [("000001.SZ", "20240102", 10.2), ("000002.SZ", "20240102", 20.5)]


def test_simple_query(spark, tmp_path):
    put(spark, ROWS, f"{tmp_path}/core/daily.parquet")
    df = tables.query_table(spark, "daily", str(tmp_path), {"ts_code": "000001.SZ"}, ["ts_code", "trade_date", "close"], "20240101", "2024-01-31")
    assert [tuple(r) for r in df.collect()] == [("000001.SZ", "20240102", 10.2)]
    assert tables.query_table(spark, "daily", str(tmp_path), limit=1).count() == 1
    assert tables.query_table(spark, "daily", str(tmp_path), limit=0).count() == 0
    assert len(tables.query_table(spark, "daily", str(tmp_path)).columns) == 11
    assert tables.query_table(spark, "daily", str(tmp_path), {"open": None}).count() == 2
    assert tables.query_table(spark, "daily", str(tmp_path), {"ts_code": []}).count() == 0
    with pytest.raises(KeyError):
        tables.query_table(spark, "nothing", str(tmp_path))
    with pytest.raises(ValueError):
        tables.query_table(spark, "daily", str(tmp_path), fields=["nothing"])


def test_mixed_hive_labels(spark, tmp_path):
    root = f"{tmp_path}/core/table=daily"
    put(spark, ROWS[:1], f"{root}/trade_date=20240102/a.parquet")
    put(spark, [("000001.SZ", 11.0)], f"{root}/trade_date=2024-01-03/b.parquet", "ts_code string, close double")
    df = tables.query_table(spark, "daily", str(tmp_path), fields=["trade_date", "close"]).orderBy("trade_date")
    assert [tuple(r) for r in df.collect()] == [("20240102", 10.2), ("20240103", 11.0)]
    assert tables.query_table(spark, "daily", str(tmp_path), start_date="2024-01-03").count() == 1
    assert set(tables.read_core_table(spark, "daily", str(tmp_path)).select("trade_date").toPandas().trade_date) == {"20240102", "20240103"}


def test_damaged_file_outside_the_range(spark, tmp_path):
    root = f"{tmp_path}/core/table=daily/parquet"
    put(spark, ROWS, f"{root}/20240102.parquet")
    with open(f"{root}/20240103.parquet", "w") as f:
        f.write("not parquet")
    for start in ("20240101", None):
        assert tables.query_table(spark, "daily", str(tmp_path), fields=["close"], start_date=start, end_date="20240102").count() == 2


def test_no_matching_partition(spark, tmp_path):
    put(spark, ROWS, f"{tmp_path}/core/table=daily/parquet/20240102.parquet")
    df = tables.query_table(spark, "daily", str(tmp_path), fields=["close", "ts_code"], start_date="20250101")
    assert df.columns == ["close", "ts_code"]
    assert df.count() == 0


def test_missing_and_empty_tables(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="not under"):
        table_files(spark, str(tmp_path), "daily")
    os.makedirs(f"{tmp_path}/core/table=daily")
    with pytest.raises(FileNotFoundError, match="without files"):
        table_files(spark, str(tmp_path), "daily")


def test_schemas():
    assert "daily" in list_tables()
    assert table_schema("stock-basic").name == "stock_basic_exchange"
    assert len(table_schema("stock_basic").fields) == 27
    assert table_schema("daily").required == ["ts_code", "trade_date"]


def test_front_end():
    assert tables.parsed_filters(["a=1", '{"b": [2]}']) == {"a": "1", "b": [2]}
    with pytest.raises(ValueError):
        tables.parsed_filters(["a"])
    assert tables.merged_filters({"a": 1, "start_date": "x", "c": None}, {"a": 2, "b": 3}) == ({"a": 1, "b": 3}, "x", None)
    assert [tables.clamped(n, 3, 100) for n in (None, 0, 500)] == [3, 1, 100]
    assert tables.symbol_field(["name", "symbol", "instrument_id"]) == "instrument_id"


def test_preview(spark):
    df = spark.createDataFrame([("a", "2024-01-02", 1), ("b", "2024-01-03", 2), (None, None, 3)], "k string, d string, v int")
    assert tables.preview(df, {"k": ""}).collect()[0].v == 3
    assert tables.preview(df, {"k": None}).count() == 3
    assert tables.preview(df, {"k": ["a", None]}).count() == 1
    assert tables.preview(df, {"d": "20240103"}, date_field="d").collect()[0].v == 2


def test_upsert(spark, tmp_path):
    target, kind = f"{tmp_path}/t", "k long, v double"
    writers.write(spark.createDataFrame([(1, 10.0), (2, 20.0)], kind), target, "upsert_by_key", ["k"])
    result = writers.write(spark.createDataFrame([(1, 10.8), (3, 30.0)], kind), target, "upsert_by_key", ["k"])
    assert (result.rows_before, result.rows_written, result.rows_after, result.duplicates_dropped) == (2, 2, 3, 1)
    assert {r.k: r.v for r in writers.read_written(spark, target).collect()} == {"1": 10.8, "2": 20.0, "3": 30.0}


def test_upsert_moves_a_key_between_partitions(spark, tmp_path):
    target, kind = f"{tmp_path}/t", "k string, d string, v double"
    writers.write(spark.createDataFrame([("a", "20240102", 1.0)], kind), target, "upsert_by_key", ["k"], ["d"], "d")
    result = writers.write(spark.createDataFrame([("a", "20240103", 2.0)], kind), target, "upsert_by_key", ["k"], ["d"], "d")
    assert (result.rows_before, result.rows_after, result.duplicates_dropped) == (1, 1, 1)
    assert [versions.label_of(f) for f in versions.latest(spark, target).files] == ["d=20240103"]


def test_upsert_keys_of_one_day(spark):
    rows = spark.createDataFrame([("2024010209:30", 1.0), ("2024010209:31", 2.0)], "t string, v double")
    assert writers.upserted(rows, rows.limit(0), ["t"]).count() == 2
    assert writers.upserted(rows, rows.limit(0), ["t"], legacy_keys=True).count() == 1


def test_replace_range(spark, tmp_path):
    target, kind = f"{tmp_path}/t", "d string, v double"
    writers.write(spark.createDataFrame([("20240102", 10.0), ("20240103", 11.0), ("20240104", 12.0), (None, 0.5)], kind), target)
    result = writers.write(spark.createDataFrame([("2024-01-03", 11.8)], kind), target, "replace_range", date_field="d")
    assert (result.range_start, result.range_end) == ("20240103", "20240103")
    assert sorted(r.v for r in writers.read_written(spark, target).collect()) == [0.5, 10.0, 11.8, 12.0]
    with pytest.raises(ValueError):
        writers.write(spark.createDataFrame([(None, 1.0)], kind), target, "replace_range", date_field="d")
    with pytest.raises(ValueError):
        writers.write(spark.createDataFrame([("20240102", 1.0)], kind), target, "replace_range", date_field="d", start="20240105", end="20240101")


def test_overwrite_partition_and_append(spark, tmp_path):
    target, kind = f"{tmp_path}/t", "d string, v double"
    writers.write(spark.createDataFrame([("20240102", 1.0), ("20240103", 2.0), (None, 3.0), ("a/b", 4.0)], kind), target, partition_by=["d"])
    assert {"d=__null__", "d=a_b"} <= {versions.label_of(f) for f in versions.latest(spark, target).files}
    result = writers.write(spark.createDataFrame([("20240102", 9.0)], kind), target, "overwrite_partition", partition_by=["d"])
    assert result.partitions == ["d=20240102"]
    assert sorted(r.v for r in writers.read_written(spark, target).collect()) == [2.0, 3.0, 4.0, 9.0]
    with pytest.raises(ValueError):
        writers.write(spark.range(1), target, "overwrite_partition")
    flat = f"{tmp_path}/flat"
    writers.write(spark.range(2), flat, "append")
    assert writers.write(spark.range(2), flat, "append").rows_after == 4


def test_append_to_partitions(spark, tmp_path):
    target, kind = f"{tmp_path}/t", "k long, d string"
    writers.write(spark.createDataFrame([(1, "a"), (2, "b/c")], kind), target, partition_by=["d"])
    result = writers.write(spark.createDataFrame([(3, "a"), (4, None), (5, "")], kind), target, "append", partition_by=["d"])
    assert (result.rows_before, result.rows_written, result.rows_after) == (2, 3, 5)
    assert sorted(r.k for r in writers.read_written(spark, target).collect()) == [1, 2, 3, 4, 5]
    for wrong in ([], ["k"], ["d", "k"]):
        with pytest.raises(ValueError):
            writers.write(spark.createDataFrame([(6, "a")], kind), target, "append", partition_by=wrong)
    assert writers.read_written(spark, target).count() == 5


def test_only_touched_partitions_are_written(spark, tmp_path):
    target, kind = f"{tmp_path}/t", "k string, d string, p string, v double"
    first = [("1", "20240101", "a", 1.0), ("2", "20240102", "b", 2.0), ("3", None, "c", 3.0), ("4", "20240102", "c", 4.0), ("5", "20240105", "", 5.0)]
    writers.write(spark.createDataFrame(first, kind), target, partition_by=["p"])
    files = lambda p: {f for f in versions.latest(spark, target).files if versions.label_of(f) == f"p={p}"}
    writers.write(spark.createDataFrame([("9", "20240105", "c", 6.0)], kind), target, "upsert_by_key", ["k"], ["p"], "d")
    was = {p: files(p) for p in "abc"}
    writers.write(spark.createDataFrame([("1", "20240103", "b", 1.5)], kind), target, "upsert_by_key", ["k"], ["p"], "d")
    # the key's old partition holds nothing else and goes; c isn't touched
    assert not files("a")
    assert files("c") == was["c"] and files("b") > was["b"]
    writers.write(spark.createDataFrame([("7", "20240102", "e", 7.0)], kind), target, "replace_range", partition_by=["p"], date_field="d")
    rows = {(r.k, r.p, r.v) for r in writers.read_written(spark, target).collect()}
    assert rows == {("1", "b", 1.5), ("3", "c", 3.0), ("5", "", 5.0), ("9", "c", 6.0), ("7", "e", 7.0)}
    writers.write(spark.createDataFrame([("8", "20240109", "", 8.0)], kind), target, "overwrite_partition", partition_by=["p"])
    assert {r.k for r in writers.read_written(spark, target).collect()} == {"1", "3", "7", "8", "9"}


def test_keys_that_become_text_do_so_everywhere(spark, tmp_path):
    target = f"{tmp_path}/t"
    writers.write(spark.createDataFrame([(1, "a"), (2, "b")], "k long, p string"), target, partition_by=["p"])
    result = writers.write(spark.createDataFrame([(1, "a"), (3, "a")], "k long, p string"), target, "upsert_by_key", ["k"], ["p"])
    assert result.duplicates_dropped == 1
    assert sorted(r.k for r in writers.read_written(spark, target).collect()) == ["1", "2", "3"]


def test_outputs(spark, tmp_path):
    df = spark.createDataFrame([(1, "中")], "a int, b string")
    out = writers.write_outputs(df, str(tmp_path), "x", ("parquet", "csv", "jsonl"))
    assert spark.read.parquet(out["parquet"]).count() == 1
    assert spark.read.option("header", True).csv(out["csv"]).first().b == "中"
    assert spark.read.json(out["jsonl"]).first().b == "中"
    row = writers.json_rows(spark.createDataFrame([(float("nan"), None)], "a double, b string")).first()
    assert json.loads(row.json) == {"a": None, "b": None}


def test_core_table_keeps_declared_columns(spark, tmp_path):
    writers.write_core_table(spark.createDataFrame([("a", "20240101", 1, 2)], "exchange string, cal_date string, is_open int, odd int"), "trade_cal", str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/core/trade_cal.parquet").columns == ["exchange", "cal_date", "is_open"]
    assert catalog.datasets(spark, str(tmp_path)).first().dataset == "trade_cal"


def test_snapshot_date(spark):
    one = spark.createDataFrame([("2024-01-02",)], "trade_date string")
    assert writers.snapshot_date(one, {"trade_date": "2024-01-05"}, "20240109") == "20240105"
    assert writers.snapshot_date(one, {}, "20240109") == "20240102"
    assert writers.snapshot_date(one.limit(0), {}, "20240109") == "20240109"


def test_delete_stays_inside(spark, tmp_path):
    with pytest.raises(ValueError):
        writers.delete_dataset(spark, str(tmp_path), "../x")


def test_csv(spark, tmp_path):
    path = f"{tmp_path}/a.csv"
    with open(path, "w", encoding="utf-8-sig") as f:
        f.write("ts_code,trade_date,v\na,20240102,1\nb,2024-01-03,2\nc,,3\n")
    assert formats.read_csv(spark, path).columns == ["ts_code", "trade_date", "v"]
    assert [r.v for r in formats.read_csv(spark, path, {"start_date": "20240103"}).collect()] == ["2"]
    assert formats.read_csv(spark, path, {"ts_code": "a"}, limit=5).count() == 1
    with pytest.raises(ValueError):
        formats.read_csv(spark, path, limit=-1)


def test_stats_text(spark, tmp_path):
    line = "|".join(["1", "1", "平安|银行".split("|")[0]] + [str(i) for i in range(3, 36)])
    with open(f"{tmp_path}/s.txt", "w", encoding="gbk") as f:
        f.write(f"{line}\nshort|2\n")
    assert [tuple(r) for r in formats.read_stats(spark, f"{tmp_path}/s.txt", {2: "two"}).collect()] == [(1, "000001", "平安")]


def test_unique_columns():
    assert formats.unique_columns(["a", "b", "a", "a"]) == ["a", "b", "a__1", "a__2"]


def test_delimited_and_html(spark):
    df = spark.createDataFrame([("1/2|3|4/5/6",)], "t string")
    assert [tuple(r)[2:] for r in formats.delimited_rows(df, "t", r"\|", "/", ["a", "b"]).collect()] == [("1", "2"), ("4", "5")]
    html = spark.createDataFrame([("<table><tr><th>a</th></tr><tr><td><b>1</b></td><td> 2 </td></tr></table>",)], "html string")
    assert [r.cells for r in formats.html_tables(html).orderBy("row_index").collect()] == [["a"], ["1", "2"]]


def test_xlsx(spark, tmp_path):
    head = '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>'
    with zipfile.ZipFile(f"{tmp_path}/a.xlsx", "w") as z:
        z.writestr("xl/sharedStrings.xml", '<sst xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><si><t>x</t></si></sst>')
        z.writestr("xl/worksheets/sheet1.xml", head + '<row><c r="A1" t="s"><v>0</v></c><c r="C1"><v>2</v></c></row></sheetData></worksheet>')
    assert formats.read_xlsx(spark, f"{tmp_path}/a.xlsx").first().cells == ["x", None, "2"]


def test_nested_items(spark):
    df = spark.createDataFrame([([{"items": [1, 2, 3]}, {"items": [4]}],)], "reports array<struct<items:array<int>>>")
    assert [r.item for r in formats.nested_items(df, "reports", "items", 1, 2).collect()] == [1, 2]


def rows_of(params, offset=0, size=0):
    """A fetcher of the tests: numbers below 25, in pages."""
    return [{"k": k, "code": params.get("code")} for k in range(offset, min(25, offset + (size or 25)))]


def test_request(spark):
    interface = gateway.Interface("numbers", "tests.test_sources:rows_of", {"k": "integer", "code": "string"}, {"code": "array"}, ("code",), ("k", "code"))
    df = gateway.request(spark, interface, {"code": ["a", "b"]}, ["k"], fanout="code", page_size=10, order=["k"], limit=30)
    assert [r.k for r in df.collect()] == sorted([*range(25), *range(25)])[:30]
    for wrong in ({"fields": ["x"], "params": {"code": "a"}}, {"params": {}}, {"params": {"code": "a", "y": 1}}, {"params": {"code": "a"}, "persist": True}):
        with pytest.raises(ValueError):
            gateway.request(spark, interface, **wrong)


def test_pages_end():
    assert len(list(gateway.pages(lambda o: [{"k": o}], 2, ["k"]))) == 1
    assert len(list(gateway.pages(lambda o: [{"k": 1}, {"k": 2}], 2, ["k"]))) == 2


def test_registry():
    registry = gateway.Registry()
    made = lambda provider, trust: gateway.Interface("i", "m:f", {"a": "string"}, provider=provider, trust=trust)
    registry.add(made("builtin", 0))
    registry.add(made("other", 0))
    assert registry.get("i").provider == "builtin"
    registry.add(made("trusted", 5))
    assert registry.get("i").provider == "trusted"
    registry.add(made("rival", 5))
    with pytest.raises(ValueError):
        registry.get("i")
    registry.chosen["i"] = "other"
    assert registry.get("i").provider == "other"
    with pytest.raises(ValueError):
        registry.add(gateway.Interface("j", "broken", {}))


def runner(spark, n):
    return {"records": [{"a": i} for i in range(n)]}


def test_run_entry(spark):
    assert gateway.run_entry(spark, "tests.test_sources:runner", "a int", n=3, odd=1).count() == 3


def test_footer_stats(spark, data):
    row = catalog.footer_stats(spark, [f"{data}/orders.parquet"]).first()
    assert row.n_rows == spark.read.parquet(f"{data}/orders.parquet").count()


def test_inspect(spark, tmp_path):
    put(spark, ROWS, f"{tmp_path}/core/table=daily/parquet/20240102.parquet")
    found = catalog.inspect(spark, str(tmp_path), "daily")
    assert (found["rows"], found["date_min"], found["files"]) == (2, "20240102", 1)


def test_typed_and_validation(spark):
    from tickloom.operators import quality

    df = spark.createDataFrame([("SSE", "20240101", "x"), ("SSE", "20240101", "1")], "exchange string, cal_date string, is_open string")
    typed = writers.typed(df, "trade_cal")
    assert sorted(str(r.is_open) for r in typed.collect()) == ["1", "None"]
    issues = {i["issue"] for i in quality.validate_table(typed, "trade_cal")}
    assert issues == {"missing_required", "primary_key_duplicates"}


def test_a_write_that_stops_leaves_the_old_version_whole(spark, tmp_path, monkeypatch):
    """Stopped after its files are written and before its manifest is in place, a write over all partitions shows nothing."""
    target, kind = f"{tmp_path}/t", "k string, p string, v double"
    old = [(str(i), "abc"[i % 3], float(i)) for i in range(30)]
    writers.write(spark.createDataFrame(old, kind), target, "upsert_by_key", ["k"], ["p"])
    seen = writers.read_written(spark, target)
    fresh = spark.createDataFrame([(str(i), "bcd"[i % 3], -1.0) for i in range(0, 40, 2)], kind)

    def lost(*_):
        raise OSError("the driver is lost")

    with monkeypatch.context() as m:
        m.setattr(versions, "commit", lost)
        for mode, more in (("upsert_by_key", {"key": ["k"]}), ("overwrite_partition", {}), ("append", {}), ("snapshot", {})):
            with pytest.raises(OSError, match="lost"):
                writers.write(fresh, target, mode, partition_by=["p"], **more)
    assert sorted(map(tuple, writers.read_written(spark, target).collect())) == sorted(old)
    result = writers.write(fresh, target, "upsert_by_key", ["k"], ["p"])
    wanted = {r[0]: r for r in old} | {r.k: tuple(r) for r in fresh.collect()}
    assert sorted(map(tuple, writers.read_written(spark, target).collect())) == sorted(wanted.values())
    assert (result.rows_before, result.rows_written, result.rows_after, result.duplicates_dropped) == (30, 20, 35, 15)
    # who began to read the old version goes on reading it, until its files go
    assert sorted(map(tuple, seen.collect())) == sorted(old)
    assert versions.read(spark, target, labels=["p=d"]).count() == sum(1 for r in wanted.values() if r[1] == "d")
    assert versions.vacuum(spark, target) > 0
    assert versions.numbers(spark, target) == [2]
    assert sorted(map(tuple, writers.read_written(spark, target).collect())) == sorted(wanted.values())


def test_two_writers_of_one_version(spark, tmp_path):
    target = f"{tmp_path}/t"
    writers.write(spark.range(3), target)
    one = versions.next_version(versions.latest(spark, target), rows=1)
    versions.commit(spark, target, one)
    with pytest.raises(versions.Conflict):
        versions.commit(spark, target, one)
    assert versions.numbers(spark, target) == [1, 2]


def test_rows_are_evaluated_once(spark, tmp_path):
    """Every mode reads its input once; the report comes from the writing jobs."""
    kind = "k string, d string, v double"
    calls = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            calls.add(batch.num_rows)
            yield batch

    rows = spark.createDataFrame([(str(i), f"202401{i % 5 + 1:02d}", 1.0) for i in range(20)], kind)
    target = f"{tmp_path}/t"
    for mode, more, after in (("snapshot", {}, 20), ("append", {}, 40), ("upsert_by_key", {"key": ["k"]}, 20), ("replace_range", {"date_field": "d"}, 20), ("overwrite_partition", {}, 20), ("upsert_by_key", {"key": ["k"]}, 20)):
        calls.value = 0
        result = writers.write(rows.mapInArrow(counted, kind), target, mode, partition_by=["d"], **more)
        assert calls.value == 20, mode
        assert (result.rows_written, result.rows_after) == (20, after), mode
        assert writers.read_written(spark, target).count() == after


def test_a_plain_folder_becomes_a_version(spark, tmp_path):
    target = f"{tmp_path}/t"
    spark.createDataFrame([(1, "a b"), (2, "c")], "k long, p string").withColumn("part_p", F.col("p")).write.partitionBy("part_p").parquet(target)
    result = writers.write(spark.createDataFrame([(3, "c")], "k long, p string"), target, "append", partition_by=["p"])
    assert (result.rows_before, result.rows_after) == (2, 3)
    assert sorted(map(tuple, writers.read_written(spark, target).collect())) == [(1, "a b"), (2, "c"), (3, "c")]
    # a core table's scan reads the newest version too
    core = f"{tmp_path}/lake/core/table=trade_cal/parquet"
    day = lambda *ds: spark.createDataFrame([("SSE", d, 1) for d in ds], "exchange string, cal_date string, is_open int")
    writers.write(day("20240102", "20240103"), core, partition_by=["cal_date"])
    writers.write(day("20240103", "20240104"), core, "upsert_by_key", ["cal_date"], ["cal_date"])
    assert sorted(r.cal_date for r in tables.read_core_table(spark, "trade_cal", f"{tmp_path}/lake").select("cal_date").collect()) == ["20240102", "20240103", "20240104"]

"""Cursor source, refresh state and streaming bars."""

import random
from collections import defaultdict

import pytest

from tickloom.sources import versions, writers
from tickloom.streaming import refresh

CALLS = []


def fetch(codes, cursors):
    """A fetcher of the tests: each code moves once beyond its cursor, up to 2."""
    return [{"instrument_id": c, "last_price": 1.0 + cursors[c], "update_time_raw": cursors[c] + 1} for c in codes if cursors[c] < 2]


def test_limits():
    assert [refresh.interval_ms(v) for v in (None, "", 10, "4000")] == [3000, 3000, 500, 4000]
    with pytest.raises(ValueError):
        refresh.checked_codes([])
    with pytest.raises(ValueError):
        refresh.checked_codes([str(i) for i in range(101)])


def test_cursors_are_overwritten():
    rows = [{"instrument_id": "a", "update_time_raw": 5}, {"instrument_id": "b", "update_time_raw": "x"}, {"instrument_id": "a", "update_time_raw": 3}]
    assert refresh.advanced({"a": 9, "b": 1}, rows) == {"a": 3, "b": 1}


def test_reader_repeats_a_batch():
    schema = type("S", (), {"names": ["instrument_id", "update_time_raw"]})()
    reader = refresh.CursorReader(schema, {"codes": '["b", "a"]', "fetcher": "tests.test_streaming:fetch"})
    start = reader.initialOffset()
    rows, end = reader.read(start)
    rows = list(rows)
    assert rows == [("a", 1), ("b", 1)]
    assert list(reader.readBetweenOffsets(start, end)) == rows


def test_bounded_batches_leave_nothing_out():
    schema = type("S", (), {"names": ["instrument_id", "update_time_raw"]})()
    reader = refresh.CursorReader(schema, {"codes": '["c", "b", "a"]', "fetcher": "tests.test_streaming:fetch", "most_rows": "2"})
    at, seen = reader.initialOffset(), []
    while True:
        rows, end = reader.read(at)
        rows = list(rows)
        assert len(rows) <= 2
        assert list(reader.readBetweenOffsets(at, end)) == rows
        if not rows:
            break
        at, seen = end, seen + rows
    assert sorted(seen) == [(c, k) for c in "abc" for k in (1, 2)]


def test_subscription(spark, tmp_path):
    kind = "instrument_id string, last_price double, update_time_raw long"
    updates = refresh.subscribe(spark, "tests.test_streaming:fetch", ["a", "b"], kind)
    out = f"{tmp_path}/out"

    def sink(df, batch):
        refresh.public(df).write.mode("append").parquet(out)

    snapshot = spark.createDataFrame([("a", 0.5, 0)], kind)
    query = refresh.start(updates, sink, f"{tmp_path}/state", snapshot, interval=500)
    query.processAllAvailable()
    query.stop()
    rows = spark.read.parquet(out)
    assert rows.columns == ["instrument_id", "last_price"]
    assert {r.last_price for r in rows.where("instrument_id = 'a'").collect()} >= {0.5, 1.0}


def test_latest_per_key(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "k string, t int, v string")
    assert sorted(r.v for r in refresh.latest_per_key(df, "k", "t").collect()) == ["y", "z"]


def test_next_run(spark):
    days = lambda *names: spark.createDataFrame([("SSE", d, True) for d in names], "exchange string, cal_date string, is_open boolean")
    assert refresh.next_run(days("20240102", "20240104"), "202401021600", "1530") == "202401041530"
    assert refresh.next_run(days("20240102"), "202401051600", "1530") is None
    assert {r.cal_date: r.due for r in refresh.next_runs(days("20240102", "20240104"), "1530").collect()} == {"20240102": "202401041530", "20240104": None}


def told(spark, rows, batches, tmp_path, restart=()):
    """What subscribers are told when the rows come in so many batches; the query is started anew after those named."""
    kind = "instrument_id string, client string, kind string, mark long, seq long, value double"
    source, target = f"{tmp_path}/feed", f"{tmp_path}/told"
    size = -(-len(rows) // batches)
    for k in range(batches):
        spark.createDataFrame(rows[k * size : (k + 1) * size], kind).coalesce(1).write.mode("append").parquet(source)
        if k in restart or k == batches - 1:
            feed = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(source)
            out = refresh.subscriptions(feed.where("kind = 'quote'"), feed.where("kind <> 'quote'"))
            refresh.scheduled(out, refresh.applied_once(target, "t"), f"{tmp_path}/state")
    return sorted(tuple(r) for r in writers.read_written(spark, target).collect())


def test_subscribers_get_a_snapshot_and_newer_quotes(spark, tmp_path):
    """Clients come and go, old quotes come late, one instrument has most rows; state survives restarts."""
    rng = random.Random(1)
    rows = []
    for i in range(240):
        name, kind = rng.choice(["a", "a", "a", "b", "c"]), rng.choice(["quote"] * 4 + ["subscribe", "unsubscribe"])
        rows.append((name, None if kind == "quote" else rng.choice("xyz"), kind, i, i, float(i) if kind == "quote" else None))
    # a quote of long ago in the last batch
    rows.append(("a", None, "quote", 3, 0, -1.0))
    clients, newest, wanted = defaultdict(set), {}, []
    for name, client, kind, mark, seq, value in rows:
        if kind == "subscribe":
            clients[name].add(client)
            wanted += [(name, client, "snapshot", *newest[name])] if name in newest else []
        elif kind == "unsubscribe":
            clients[name].discard(client)
        elif name not in newest or (mark, seq) > newest[name][:2]:
            newest[name] = (mark, seq, value)
            wanted += [(name, c, "update", *newest[name]) for c in clients[name]]
    assert told(spark, rows, 3, tmp_path, restart=(0,)) == sorted(wanted)


def test_a_batch_that_comes_again_changes_nothing(spark, tmp_path):
    target = f"{tmp_path}/t"
    one, two = (refresh.applied_once(target, name) for name in ("one", "two"))
    rows = spark.createDataFrame([(1, "a")], "k long, v string")
    for sink, batch in ((one, -1), (one, -1), (one, 0), (one, 1), (one, 0), (two, 0), (two, 0), (one, 1)):
        sink(rows, batch)
    assert writers.read_written(spark, target).count() == 4
    assert versions.latest(spark, target).applied == {"one": 1, "two": 0}


def test_a_restart_sends_no_snapshot(spark, tmp_path):
    source, sent = f"{tmp_path}/feed", []
    spark.range(3).write.parquet(source)
    feed = spark.readStream.schema("id long").parquet(source)
    for _ in range(2):
        refresh.start(feed, lambda rows, batch: sent.append((batch, rows.count())), f"{tmp_path}/state", spark.range(1), once=True).awaitTermination()
    assert sent == [(-1, 1), (0, 3)]


def test_state_is_read_once_a_batch_and_written_where_it_changed():
    from types import SimpleNamespace as Of

    class State:
        def __init__(self):
            self.held, self.calls = {}, 0

        def __getattr__(self, name):
            self.calls += 1
            return {"get": lambda: self.held.get(()), "update": lambda v: self.held.update({(): v}), "iterator": lambda: iter(list(self.held.items())), "keys": lambda: iter(list(self.held)), "containsKey": lambda k: k in self.held, "updateValue": lambda k, v: self.held.update({k: v}), "removeKey": lambda k: self.held.pop(k)}[name]

    clients, newest, told = State(), State(), refresh._Subscribed()
    told.init(Of(getMapState=lambda *_: clients, getValueState=lambda *_: newest))
    quotes = [Of(kind="quote", client=None, mark=m, seq=m, value=float(m)) for m in range(2, 200)]
    asked = [Of(kind="subscribe", client=c, mark=1, seq=k, value=None) for k, c in enumerate("ab")]
    assert len(list(told.handleInputRows(("x",), iter(asked + quotes), None))) == 2 * len(quotes)
    gone = [Of(kind="unsubscribe", client="a", mark=300, seq=0, value=None), Of(kind="quote", client=None, mark=301, seq=1, value=1.0)]
    assert [(r.client, r.kind) for r in told.handleInputRows(("x",), iter(gone), None)] == [("b", "update")]
    assert clients.held == {("b",): (1,)}
    assert clients.calls + newest.calls < 12

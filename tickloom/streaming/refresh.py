"""Quote refresh: a cursor source, per-key state, snapshots followed by updates, and streaming bars."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import StructType

from tickloom.functions.dates import is_true
from tickloom.operators.calendar import neighbours
from tickloom.sources.gateway import _function
from tickloom.sources.layout import exists
from tickloom.sources.writers import write

LEAST_MS, DEFAULT_MS, MOST_CODES = 500, 3000, 100
INTERNAL = ("update_time_raw",)


def interval_ms(value: Any) -> int:
    """A poll interval in milliseconds: the default for none, never below the least."""
    return DEFAULT_MS if value in (None, "") else max(LEAST_MS, int(value))


def interval_column(value: Column) -> Column:
    """The same of a column; text that is no number is an error."""
    return F.when(value.isNull() | (value.cast("string") == ""), DEFAULT_MS).otherwise(F.greatest(F.lit(LEAST_MS), value.cast("int")))


def checked_codes(codes: Sequence[str]) -> list[str]:
    out = list(dict.fromkeys(c.strip() for c in codes if c.strip()))
    if not 1 <= len(out) <= MOST_CODES:
        raise ValueError(f"a subscription holds 1 to {MOST_CODES} codes")
    return out


def advanced(cursors: Mapping[str, int], rows: Sequence[Mapping[str, Any]], key: str = "instrument_id", mark: str = "update_time_raw") -> dict[str, int]:
    """Cursors after a batch: each returned row's mark, as it is; what can't be read changes nothing."""
    out = dict(cursors)
    for row in rows:
        try:
            out[str(row[key])] = int(row[mark])
        except (KeyError, TypeError, ValueError):
            continue
    return out


class CursorReader(SimpleDataSourceStreamReader):
    """Asks a fetcher (codes, cursors) -> rows for what changed; the offset is the map of cursors, kept in the checkpoint."""

    def __init__(self, schema: StructType, options: Mapping[str, str]):
        self.names, self.options = schema.names, options
        self.codes = json.loads(options["codes"])
        self.most = int(options.get("most_rows", "0")) or None

    def initialOffset(self) -> dict:
        return {"cursors": json.dumps(dict.fromkeys(self.codes, 0))}

    def _rows(self, start: dict) -> tuple[list[Mapping[str, Any]], dict]:
        cursors = json.loads(start["cursors"])
        rows = _function(self.options["fetcher"])(self.codes, cursors)
        # what a batch doesn't admit keeps its cursor and comes with a later poll; keys that are furthest behind come first
        rows = sorted(rows, key=lambda r: (cursors.get(str(r.get("instrument_id")), 0) if self.most else 0, str(r.get("instrument_id"))))[: self.most]
        return sorted(rows, key=lambda r: str(r.get("instrument_id"))), {"cursors": json.dumps(advanced(cursors, rows))}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        rows, end = self._rows(start)
        return iter([tuple(r.get(n) for n in self.names) for r in rows]), end

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        """A batch again after a failure: rows past the old cursors and not past the new ones."""
        low, high = json.loads(start["cursors"]), json.loads(end["cursors"])
        for r in self._rows(start)[0]:
            name = str(r.get("instrument_id"))
            if low.get(name, 0) < int(r["update_time_raw"]) <= high.get(name, 0):
                yield tuple(r.get(n) for n in self.names)


class CursorSource(DataSource):
    """``spark.readStream.format("quote_refresh")`` with options fetcher, codes (JSON), schema and most_rows, the bound of a batch."""

    @classmethod
    def name(cls) -> str:
        return "quote_refresh"

    def schema(self) -> str:
        return self.options["schema"]

    def simpleStreamReader(self, schema: StructType) -> CursorReader:
        return CursorReader(schema, dict(self.options))


def subscribe(spark: SparkSession, fetcher: str, codes: Sequence[str], schema: str, most_rows: int = 0) -> DataFrame:
    spark.dataSource.register(CursorSource)
    reader = spark.readStream.format("quote_refresh").schema(schema).option("fetcher", fetcher).option("codes", json.dumps(checked_codes(codes)))
    return reader.option("most_rows", str(most_rows)).load()


def public(df: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
    """Rows without internal fields."""
    return df.select(*fields) if fields else df.drop(*INTERNAL)


def events(df: DataFrame, kind: str, request_id: str) -> DataFrame:
    """Rows as JSON events: snapshot first, then update."""
    return df.select(F.to_json(F.struct(F.lit(kind).alias("event"), F.lit(request_id).alias("request_id"), F.struct(*df.columns).alias("data")), {"ignoreNullFields": "false"}).alias("event"))


def start(updates: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, snapshot: DataFrame | None = None, interval: Any = None, once: bool = False) -> StreamingQuery:
    """The snapshot as batch -1, then every micro-batch, to a sink.

    A restart from a checkpoint that has begun doesn't send the snapshot again, and
    the engine repeats the batch that wasn't ended; a sink of ``applied_once`` takes
    either at most once wherever a run stops.
    """
    if snapshot is not None and not exists(updates.sparkSession, f"{checkpoint}/offsets"):
        sink(snapshot, -1)
    writer = updates.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=f"{interval_ms(interval)} milliseconds")).start()


def applied_once(target: str, stream: str, mode: str = "append", **how: Any) -> Callable[[DataFrame, int], None]:
    """A sink into a table of versions that remembers, in the step that commits a batch, that it holds it.

    A batch or a snapshot that comes again changes nothing.  Several streams may write
    to one table, each under a name of its own.
    """

    def sink(rows: DataFrame, batch: int) -> None:
        write(rows, target, mode, batch=(stream, batch), **how)

    return sink


class _Subscribed(StatefulProcessor):
    """The state of one instrument: who is subscribed to it, and its newest quote."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.clients = handle.getMapState("clients", "client string", "since long")
        self.newest = handle.getValueState("newest", "mark long, seq long, value double")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:  # noqa: N802, N803
        told = lambda client, kind, mark, seq, value: Row(instrument_id=key[0], client=client, kind=kind, mark=mark, seq=seq, value=value)
        # each step of the state is a message to the engine: it is read once a batch, and what changed is written at the end
        newest, known = self.newest.get(), {client: since for (client,), (since,) in self.clients.iterator()}
        clients, had = dict(known), newest
        # a micro-batch bounds the rows of a key
        for row in sorted(rows, key=lambda r: (r.mark, r.seq)):
            if row.kind == "subscribe":
                clients[row.client] = row.mark
                if newest is not None:
                    yield told(row.client, "snapshot", *newest)
            elif row.kind == "unsubscribe":
                clients.pop(row.client, None)
            elif newest is None or (row.mark, row.seq) > (newest[0], newest[1]):
                newest = (row.mark, row.seq, row.value)
                for client in clients:
                    yield told(client, "update", *newest)
        for client in known.keys() - clients.keys():
            self.clients.removeKey((client,))
        for client in (c for c, since in clients.items() if known.get(c) != since):
            self.clients.updateValue((client,), (clients[client],))
        if newest is not had:
            self.newest.update(newest)

    def close(self) -> None:
        pass


def subscriptions(quotes: DataFrame, control: DataFrame) -> DataFrame:
    """What subscribers of instruments are told: instrument_id, client, kind (snapshot or update), mark, seq, value.

    ``quotes`` (instrument_id, mark, seq, value) and ``control`` (instrument_id, client,
    kind subscribe or unsubscribe, mark, seq) are streams; within a batch they count in
    the order of mark and seq.  A subscriber gets the newest quote at once and each newer
    one until it leaves; a quote that isn't newer than the newest is dropped.  State is
    kept by instrument, so it is spread as they are and nothing of it is in an offset.
    """
    spark = quotes.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    told = "instrument_id string, client string, kind string, mark long, seq long, value double"
    plain = lambda df, **more: df.select(F.col("instrument_id").cast("string").alias("instrument_id"), *((more.get(n) if n in more else F.col(n)).cast(t).alias(n) for n, t in (("client", "string"), ("kind", "string"), ("mark", "long"), ("seq", "long"), ("value", "double"))))
    none = F.lit(None)
    both = plain(quotes, client=none, kind=F.lit("quote")).unionByName(plain(control, value=none))
    return both.groupBy("instrument_id").transformWithState(_Subscribed(), told, "Append", "None")


def latest_per_key(df: DataFrame, key: str, mark: str) -> DataFrame:
    """The newest row of each key in a batch."""
    whole = F.struct(*(F.col(c) for c in df.columns))
    return df.groupBy(key).agg(F.max_by(whole, mark).alias("row_")).select("row_.*")


def changed(updates: DataFrame, key: str, mark: str, time: str, late: str = "10 minutes") -> DataFrame:
    """Updates once each, though a poll may repeat them; state is kept for the watermark."""
    return updates.withWatermark(time, late).dropDuplicatesWithinWatermark([key, mark])


def streaming_bars(ticks: DataFrame, width: str, by: Sequence[str], time: str, price: str, late: str = "10 minutes", slide: str | None = None, session: bool = False) -> DataFrame:
    """OHLC bars of tumbling, sliding or session windows; late ticks are dropped after the watermark."""
    window = F.session_window(time, width) if session else F.window(time, width, slide) if slide else F.window(time, width)
    order: Column = F.struct(time, price)
    return ticks.withWatermark(time, late).groupBy(window.alias("window"), *by).agg(
        F.min_by(price, order).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"), F.max_by(price, order).alias("close"), F.count("*").alias("n_ticks"),
    ).select(*by, F.col("window.start").alias("bar_start"), F.col("window.end").alias("bar_end"), "open", "high", "low", "close", "n_ticks")


def scheduled(updates: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """All that is there now as one run, for a scheduler outside."""
    query = start(updates, sink, checkpoint, once=True)
    query.awaitTermination()


def next_runs(calendar: DataFrame, clock: str, date: str = "cal_date", flag: str = "is_open", by: str = "exchange") -> DataFrame:
    """Each day with the next yyyyMMddHHmm that is due after it: a time of day on the open day that follows, or null."""
    return neighbours(calendar, date, flag, by).withColumn("due", F.concat("next_trade_date", F.lit(clock))).drop("pretrade_date", "next_trade_date")


def next_run(calendar: DataFrame, now: str, clock: str, date: str = "cal_date", flag: str = "is_open") -> str | None:
    """The first yyyyMMddHHmm at a time of day on an open day, after ``now``."""
    due = F.concat(F.col(date), F.lit(clock))
    return calendar.where(is_true(flag) & (due > now)).agg(F.min(due)).first()[0]

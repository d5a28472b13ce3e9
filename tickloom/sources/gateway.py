"""Pluggable sources: interfaces with declared parameters and fields, and paged reads as a Spark data source.

A fetcher is a plain function (params, page) -> rows; an interface says what it
takes and gives.  ``request`` validates, reads all pages in parallel through
Spark's Python data source API, projects, and never stores anything.
"""

from __future__ import annotations

import importlib
import inspect
import json
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.types import StructType

PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
KINDS = {"string": "string", "integer": "long", "number": "double", "float64": "double", "boolean": "boolean", "date": "string", "datetime": "timestamp"}


@dataclass(frozen=True)
class Interface:
    """fetcher: ``module:function``; fields and params: name -> kind."""

    name: str
    fetcher: str
    fields: Mapping[str, str]
    params: Mapping[str, str] = field(default_factory=dict)
    required: tuple[str, ...] = ()
    key: tuple[str, ...] = ()
    provider: str = "builtin"
    trust: int = 0
    #: fields that the fetcher itself filters by, as params["filters"], and whether it sorts and limits (params["sort"], params["limit"])
    filters: tuple[str, ...] = ()
    sorts: bool = False

    def schema(self, names: Sequence[str] | None = None) -> str:
        """A type of another kind, or one spelled a/b, is text."""
        return ", ".join(f"`{n}` {KINDS.get(self.fields[n], 'string')}" for n in names or self.fields)

    def problems(self) -> list[str]:
        out = [] if ":" in self.fetcher else ["fetcher is module:function"]
        out += [f"required parameter {r} isn't declared" for r in self.required if r not in self.params]
        out += [f"key {k} isn't a field" for k in self.key if k not in self.fields]
        return out + ([] if self.fields else ["no fields"])


class Registry:
    """Interfaces by name.  Of several, an explicit choice wins, then trust, then the built-in one; a tie is a conflict."""

    def __init__(self) -> None:
        self._known: dict[str, list[Interface]] = {}
        self.chosen: dict[str, str] = {}

    def add(self, interface: Interface) -> None:
        if problems := interface.problems():
            raise ValueError("; ".join(problems))
        self._known.setdefault(interface.name, []).append(interface)

    def names(self) -> list[str]:
        return sorted(self._known)

    def get(self, name: str) -> Interface:
        if name not in self._known:
            raise KeyError(f"unknown interface {name}")
        found = self._known[name]
        if name in self.chosen:
            return next(i for i in found if i.provider == self.chosen[name])
        best = max(i.trust for i in found)
        found = [i for i in found if i.trust == best]
        own = [i for i in found if i.provider == "builtin"]
        if len(found) > 1 and len(own) != 1:
            raise ValueError(f"{name} is given by {', '.join(i.provider for i in found)}")
        return own[0] if len(found) > 1 else found[0]


def _function(path: str) -> Callable:
    module, _, name = path.partition(":")
    return getattr(importlib.import_module(module), name)


def pages(fetch: Callable[[int], Sequence[Mapping[str, Any]]], size: int, key: Sequence[str] = (), most: int = 65_535) -> Iterator[Mapping[str, Any]]:
    """Rows page by page until one is short, empty, holds no new key, or the last offset is reached."""
    seen: set[tuple] = set()
    for offset in range(0, most, size):
        rows = fetch(offset)
        fresh = 0
        for row in rows:
            name = tuple(row.get(k) for k in key)
            if not key or name not in seen:
                seen.add(name)
                fresh += 1
                yield row
        if len(rows) < size or not fresh:
            return


@dataclass
class Part(InputPartition):
    params: str

    def __init__(self, params: str):
        self.params = params


#: How a fetcher is told a filter.
OPERATORS = {EqualTo: "=", In: "in", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}


COMPARED: dict[str, Callable[[Column, Any], Column]] = {
    "=": lambda c, v: c == v, "in": lambda c, v: c.isin(list(v)), ">": lambda c, v: c > v, ">=": lambda c, v: c >= v, "<": lambda c, v: c < v, "<=": lambda c, v: c <= v,
}


def holds(value: Any, operator: str, against: Any) -> bool:
    """Whether a value passes a filter; null passes none."""
    if value is None:
        return False
    if operator == "in":
        return value in against
    return {"=": value == against, ">": value > against, ">=": value >= against, "<": value < against, "<=": value <= against}[operator] if against is not None else False


class InterfaceReader(DataSourceReader):
    """Reads with the filters of its request: the fetcher is told those it takes, those on the fan-out parameter leave partitions out.

    A reader is shared by all plans over a frame, so what one plan pushes would hold
    in the others as well.  Only the request's own filters, which are in all of them,
    are taken off Spark's hands; those put on the frame later stay with Spark.
    """

    def __init__(self, schema: StructType, options: Mapping[str, str]):
        self.names, self.options = schema.names, options
        self.where = [(name, operator, value) for name, operator, value in json.loads(options.get("where", "[]"))]
        self.told = [f for f in self.where if f[0] in options.get("filters", "").split(",")]

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        for one in filters:
            operator = OPERATORS.get(type(one))
            known = operator is not None and len(one.attribute) == 1 and (one.attribute[0], operator, list(one.value) if operator == "in" else one.value) in self.told
            if not known:
                yield one

    def partitions(self) -> list[Part]:
        """One per value of the fan-out parameter that the filters allow: codes, years or pages."""
        base, fan = json.loads(self.options.get("params", "{}")), self.options.get("fanout")
        if self.told:
            base["filters"] = self.told
        for name in ("sort", "limit"):
            if name in self.options:
                base[name] = json.loads(self.options[name])
        values = base.get(fan) if fan else None
        if not isinstance(values, list) or not values:
            return [Part(json.dumps(base))]
        kept = [v for v in values if all(holds(v, operator, value) for name, operator, value in self.where if name == fan)]
        return [Part(json.dumps(base | {fan: v})) for v in kept] or [Part("")]

    def read(self, partition: Part) -> Iterator[tuple]:
        if not partition.params:
            return
        fetch, size = _function(self.options["fetcher"]), int(self.options.get("page_size", "0"))
        params = json.loads(partition.params)
        key = [k for k in self.options.get("key", "").split(",") if k]
        rows = pages(lambda offset: fetch(params, offset, size), size, key) if size else iter(fetch(params))
        for row in rows:
            yield tuple(row.get(n) for n in self.names)


class InterfaceSource(DataSource):
    """``spark.read.format("market_interface")`` with options fetcher, params (JSON), fanout, page_size and key."""

    @classmethod
    def name(cls) -> str:
        return "market_interface"

    def schema(self) -> str:
        return self.options["schema"]

    def reader(self, schema: StructType) -> InterfaceReader:
        return InterfaceReader(schema, dict(self.options))


def years(start: str, end: str) -> list[int]:
    """The years of a range, to fan a read out over."""
    return list(range(int(start[:4]), int(end[:4]) + 1))


def request(
    spark: SparkSession, interface: Interface, params: Mapping[str, Any] | None = None, fields: Sequence[str] | None = None, fanout: str | None = None, page_size: int = 0, order: Sequence[str] = (), limit: int | None = None, persist: bool = False, where: Sequence[tuple[str, str, Any]] = (),
) -> DataFrame:
    """Rows of an interface: validated, read, filtered, deduplicated by its key, projected, ordered, limited.

    ``where`` holds (field, =, in, >, >=, < or <=, value): what the fetcher takes
    itself is pushed to it, and a fan-out over years reads only those asked for.
    """
    if persist:
        raise ValueError("a request never stores rows")
    for name in fields or []:
        if name not in interface.fields:
            raise ValueError(f"{interface.name} has no field {name}")
    for name, operator, _ in where:
        if name not in interface.fields or operator not in COMPARED:
            raise ValueError(f"{interface.name} can't be filtered by {name} {operator}")
    params = dict(params or {})
    if unknown := [p for p in params if p not in interface.params]:
        raise ValueError(f"{interface.name} takes no {', '.join(unknown)}")
    if missing := [r for r in interface.required if params.get(r) in (None, "", [])]:
        raise ValueError(f"{interface.name} needs {', '.join(missing)}")
    spark.dataSource.register(InterfaceSource)
    reader = spark.read.format("market_interface").schema(interface.schema()).option("fetcher", interface.fetcher).option("params", json.dumps(params)).option("key", ",".join(interface.key))
    reader = reader.option("page_size", str(page_size)).option("filters", ",".join(interface.filters))
    if interface.sorts and order:
        # each partition comes sorted and cut; the rest of both is done here
        reader = reader.option("sort", json.dumps(list(order)))
        rest = any(name not in interface.filters for name, *_ in where)
        reader = reader.option("limit", json.dumps(limit)) if limit is not None and not interface.key and not rest else reader
    spark.conf.set(PUSHDOWN, "true")
    df = (reader.option("fanout", fanout) if fanout else reader).option("where", json.dumps(list(where))).load()
    for name, operator, value in where:
        df = df.where(COMPARED[operator](F.col(f"`{name}`"), value))
    df = df.dropDuplicates(list(interface.key)) if interface.key else df
    df = df.orderBy(*order) if order else df
    return (df if limit is None else df.limit(limit)).select(*(fields or interface.fields))


def run_entry(spark: SparkSession, entry: str, schema: str, **arguments: Any) -> DataFrame:
    """Call ``module:function`` with the arguments it takes; rows come as a DataFrame, a list, or under records, data or rows."""
    call = _function(entry)
    takes = inspect.signature(call).parameters
    loose = any(p.kind is p.VAR_KEYWORD for p in takes.values())
    found = call(**{k: v for k, v in (arguments | {"spark": spark}).items() if loose or k in takes})
    if isinstance(found, Mapping):
        found = next(found[k] for k in ("records", "data", "rows") if k in found)
    if isinstance(found, DataFrame):
        return found
    empty = spark.createDataFrame([], schema)
    return spark.createDataFrame([tuple(r.get(n) for n in empty.columns) for r in found], empty.schema)


def projected(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Asked columns; those that aren't there are null."""
    return df.select(*(F.col(n) if n in df.columns else F.lit(None).cast("string").alias(n) for n in names))

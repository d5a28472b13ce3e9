"""Declared tables: fields, keys, date fields and aliases."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import BooleanType, DataType, DoubleType, LongType, StringType, StructField, StructType, TimestampType

_TYPES: dict[str, DataType] = {"boolean": BooleanType(), "date": StringType(), "double": DoubleType(), "float64": DoubleType(), "int64": LongType(), "string": StringType(), "timestamp": TimestampType()}


@dataclass(frozen=True)
class Field:
    name: str
    kind: str = "string"
    required: bool = False
    unit: str | None = None

    @property
    def type(self) -> DataType:
        """Unknown kinds are text, as dates are."""
        return _TYPES.get(self.kind, StringType())


@dataclass(frozen=True)
class TableSchema:
    name: str
    fields: tuple[Field, ...]
    key: tuple[str, ...]
    date_field: str | None = None

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    def field(self, name: str) -> Field:
        for f in self.fields:
            if f.name == name:
                return f
        raise ValueError(f"table {self.name} has no field {name}")

    def checked(self, names: list[str] | None) -> list[str]:
        """The asked fields, or all if none are asked."""
        for name in names or []:
            self.field(name)
        return list(names) if names else self.names

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.fields if f.required or f.name in self.key]

    def struct(self) -> StructType:
        return StructType([StructField(f.name, f.type, True, {"unit": f.unit} if f.unit else {}) for f in self.fields])


def _fields(spec: str) -> tuple[Field, ...]:
    """``name``, ``name*`` (required), ``name:kind`` and ``name:kind[unit]``."""
    out = []
    for word in spec.split():
        name, _, kind = word.partition(":")
        kind, _, unit = kind.partition("[")
        out.append(Field(name.rstrip("*"), kind or "string", name.endswith("*"), unit.rstrip("]") or None))
    return tuple(out)


_PRICES = "open:float64[CNY] high:float64[CNY] low:float64[CNY] close:float64[CNY] pre_close:float64[CNY] change:float64[CNY] pct_chg:float64[%] vol:float64[lot] amount:float64[kCNY]"

# The core tables, their fields and aliases.
TABLES: dict[str, TableSchema] = {
    t.name: t
    for t in (
        TableSchema(
            "stock_basic_exchange",
            _fields(
                "instrument_id* symbol* exchange* asset_type* name* security_full_name market_code market industry_code industry region_code region "
                "company_code company_short_name company_full_name company_short_name_en company_full_name_en listing_status* list_date delist_date "
                "total_share:float64[1e8] float_share:float64[1e8] is_profit is_vie has_weighted_voting_rights sponsor share_report_date"
            ),
            ("instrument_id",),
            "list_date",
        ),
        TableSchema("trade_cal", _fields("exchange* cal_date* is_open*:int64 pretrade_date"), ("exchange", "cal_date"), "cal_date"),
        TableSchema("daily", _fields(f"ts_code* trade_date* {_PRICES}"), ("ts_code", "trade_date"), "trade_date"),
        TableSchema("adj_factor", _fields("ts_code* trade_date* adj_factor*:float64"), ("ts_code", "trade_date"), "trade_date"),
    )
}
ALIASES = {"stock_basic": "stock_basic_exchange", "stock-basic": "stock_basic_exchange", "stock-basic-exchange": "stock_basic_exchange"}


def table_schema(name: str) -> TableSchema:
    key = name.strip().lower()
    key = ALIASES.get(key, key)
    if key not in TABLES:
        raise KeyError(f"unknown table {name}")
    return TABLES[key]


def list_tables(aliases: bool = False) -> list[str]:
    return sorted([*TABLES, *(ALIASES if aliases else ())])


def register(schema: TableSchema, *aliases: str) -> None:
    TABLES[schema.name] = schema
    ALIASES.update(dict.fromkeys(aliases, schema.name))

"""Entity specs: which columns a source table has, their types, and what is derived from them."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronolake.functions.rules import Buckets, Case, RegexGroup, Rule, rule_from_config

KEY = "id"

# Columns that decide which of two events of one key is the later one.
ORDER = ("pg_lsn", "source_ts_ms", "kafka_offset")

# Columns that travel from the event to the row.
AUDIT = ("operation", "source_ts_ms", "processed_at", "kafka_partition", "kafka_offset", "pg_lsn")

AUDIT_TYPES = {
    "operation": "string",
    "source_ts_ms": "bigint",
    "processed_at": "timestamp",
    "kafka_partition": "int",
    "kafka_offset": "bigint",
    "pg_lsn": "bigint",
}

# Validity columns, plus the order key of the event that closed the row (the replay fence).
HISTORY_TYPES = {
    "_valid_from": "timestamp",
    "_valid_to": "timestamp",
    "_is_current": "boolean",
    "_hash": "string",
    "_cdc_order_lsn": "bigint",
    "_close_lsn": "bigint",
    "_close_ts_ms": "bigint",
    "_close_offset": "bigint",
}

CLOSE = ("_close_lsn", "_close_ts_ms", "_close_offset")

_INTEGRAL = {"tinyint", "smallint", "int", "integer", "bigint", "long"}


@dataclass(frozen=True)
class EntitySpec:
    """``columns`` maps name to Spark type; ``rules`` maps derived column name to its rule.

    ``decimals`` gives the scale of columns that arrive as encoded decimals, ``micros`` names times that
    arrive in microseconds; see ``as_connector``.
    """

    name: str
    columns: Mapping[str, str]
    rules: Mapping[str, Rule] = field(default_factory=dict)
    decimals: Mapping[str, int] = field(default_factory=dict)
    micros: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if KEY not in self.columns:
            raise ValueError(f"entity {self.name!r} needs a column {KEY!r}")
        clash = set(self.columns) & set(self.rules)
        if clash:
            raise ValueError(f"derived columns hide source columns: {sorted(clash)}")

    @classmethod
    def from_config(cls, name: str, config: Mapping[str, Any]) -> EntitySpec:
        """Read ``{"columns": [...], "types": {...}, "transforms": {...}}``; untyped columns are strings."""
        types = config.get("types", {})
        return cls(
            name,
            {column: types.get(column, "string") for column in config["columns"]},
            {column: rule_from_config(rule) for column, rule in config.get("transforms", {}).items()},
        )

    def payload_schema(self) -> T.StructType:
        """Every field as text: numbers and quoted numbers then cast alike, whatever the first row held."""
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])

    def typed(self, payload: str) -> list[Column]:
        return [self._value(F.col(f"{payload}.{c}"), c, t).alias(c) for c, t in self.columns.items()]

    def _value(self, text: Column, column: str, type_name: str) -> Column:
        if column in self.decimals:
            return from_connector_decimal(text, self.decimals[column]).cast(type_name)
        value = _lenient(text, type_name)
        return F.floor(value / 1000).cast(type_name) if column in self.micros else value

    def as_connector(self, decimals: Mapping[str, int] | None = None, micros: tuple[str, ...] = ()) -> EntitySpec:
        """The same entity where the connector keeps its defaults: encoded decimals, times in microseconds."""
        return replace(self, decimals=dict(decimals or {}), micros=tuple(micros))

    def derived(self) -> dict[str, Column]:
        return {name: rule.build() for name, rule in self.rules.items()}

    def business(self) -> list[str]:
        """Columns that make up the row's content: source columns, derived ones, and the live flag."""
        return [*self.columns, *self.rules, "is_active"]

    def silver_types(self) -> dict[str, str]:
        derived = {name: "string" for name in self.rules}
        return {**self.columns, **derived, "is_active": "boolean", **AUDIT_TYPES, **HISTORY_TYPES}


def _lenient(text: Column, type_name: str) -> Column:
    """Cast without raising; '12.7' read as an integer truncates instead of turning NULL."""
    if type_name == "string":
        return text
    if type_name in _INTEGRAL:
        return F.coalesce(text.try_cast(type_name), text.try_cast("double").try_cast(type_name))
    value = text.try_cast(type_name)
    if type_name in ("double", "float"):  # the source's numbers may be NaN or infinite: no amounts
        value = F.when(~F.isnan(value) & (F.abs(value) != F.lit(float("inf"))), value)
    return value


def from_connector_decimal(text: Column, scale: int) -> Column:
    """A decimal as connectors encode it by default: base64 of the unscaled big-endian two's complement.

    Up to eight bytes (18 digits); NULL for longer and for malformed text.
    """
    raw = F.try_to_binary(text, F.lit("base64"))
    size = F.octet_length(raw)
    sign = F.when(F.substring(F.hex(raw), 1, 1) >= "8", F.lit("F")).otherwise(F.lit("0"))
    value = F.conv(F.lpad(F.hex(raw), 16, sign), 16, -10).try_cast("bigint")
    return F.when((size >= 1) & (size <= 8), value / F.lit(float(10**scale)))


# The three source tables, their types and their category bounds.
USERS = EntitySpec(
    "users",
    {"id": "bigint", "name": "string", "email": "string", "created_at": "bigint", "updated_at": "bigint"},
    {"email_domain": RegexGroup("email", "@(.+)$", 1)},
)

PRODUCTS = EntitySpec(
    "products",
    {
        "id": "bigint",
        "name": "string",
        "price": "double",
        "category": "string",
        "created_at": "bigint",
        "updated_at": "bigint",
    },
    {"price_category": Buckets((Case("price", "<", 50, "Low"), Case("price", "<", 200, "Medium")), "High")},
)

ORDERS = EntitySpec(
    "orders",
    {
        "id": "bigint",
        "user_id": "bigint",
        "product_id": "bigint",
        "quantity": "int",
        "total_amount": "double",
        "status": "string",
        "created_at": "bigint",
        "updated_at": "bigint",
    },
    {
        "order_value_category": Buckets(
            (Case("total_amount", "<", 100, "Small"), Case("total_amount", "<", 500, "Medium")), "Large"
        )
    },
)

ENTITIES = {spec.name: spec for spec in (USERS, PRODUCTS, ORDERS)}

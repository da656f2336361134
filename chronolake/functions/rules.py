"""Derived-column rules: declarative, compiled to built-in column expressions."""

from __future__ import annotations

import operator
from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

_COMPARE = {"<": operator.lt, ">": operator.gt, "==": operator.eq}


@dataclass(frozen=True)
class RegexGroup:
    """Group ``group`` of ``pattern`` in ``column``; '' without a match, NULL for NULL."""

    column: str
    pattern: str
    group: int = 1

    def build(self) -> Column:
        return F.regexp_extract(F.col(self.column), self.pattern, self.group)


@dataclass(frozen=True)
class Case:
    column: str
    compare: str
    bound: Any
    label: str

    def __post_init__(self) -> None:
        if self.compare not in _COMPARE:
            raise ValueError(f"comparison must be one of {sorted(_COMPARE)}, not {self.compare!r}")

    def condition(self) -> Column:
        return _COMPARE[self.compare](F.col(self.column), F.lit(self.bound))


@dataclass(frozen=True)
class Buckets:
    """Label of the first case that holds, else ``otherwise`` (also for a NULL input, as SQL CASE)."""

    cases: tuple[Case, ...]
    otherwise: str | None = None

    def __post_init__(self) -> None:
        if not self.cases:
            raise ValueError("a bucket rule needs at least one case")

    def build(self) -> Column:
        first, *rest = self.cases
        chain = F.when(first.condition(), first.label)
        for case in rest:
            chain = chain.when(case.condition(), case.label)
        return chain.otherwise(self.otherwise)


Rule = RegexGroup | Buckets


def rule_from_config(config: Mapping[str, Any]) -> Rule:
    """Read the dictionary form: ``{"expr": "regexp_extract" | "when", "params": [...]}``."""
    kind, params = config.get("expr"), list(config.get("params", ()))
    if kind == "regexp_extract":
        return RegexGroup(*params)
    if kind == "when":
        fallback = [p["else"] for p in params if "else" in p]
        cases = tuple(Case(p["col"], p["expr"], p["val"], p["then"]) for p in params if "else" not in p)
        return Buckets(cases, fallback[-1] if fallback else None)
    raise ValueError(f"unknown rule kind {kind!r}")

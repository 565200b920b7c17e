"""Cleaned tables: typed, one row per key, rules applied, in that order.

Of the copies of a key one that breaks no dropping rule survives if there is one,
so a key is gone only where every copy of it breaks a rule.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation

from lapwright.operators import conform, enforce, keep_first, observed, passes
from lapwright.schemas import TABLES, TableSpec


def distinct_typed(raw: DataFrame, spec: TableSpec) -> DataFrame:
    """Typed rows, one per key, before any rule."""
    typed = conform(raw, spec)
    if not spec.key:
        return typed
    arrived = set(raw.columns)
    return keep_first(typed, spec.key, [c for c in spec.schema.names if c in arrived], prefer=passes(spec))


def clean(raw: DataFrame, endpoint: str, watch: str | Observation | None = None) -> DataFrame:
    """Silver table of an endpoint; ``watch`` receives or names the metrics that count violations."""
    spec = TABLES[endpoint]
    rows = distinct_typed(raw, spec)
    if watch:
        rows = observed(rows, spec, watch)
    return enforce(rows, spec)


def builders(raw: Mapping[str, DataFrame]) -> dict:
    """Builders of all silver tables over a mapping of raw tables."""

    def build(endpoint: str):
        return lambda _tables: clean(raw[endpoint], endpoint)

    return {spec.silver: build(endpoint) for endpoint, spec in TABLES.items()}

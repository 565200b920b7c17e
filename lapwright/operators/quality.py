"""Data-quality rules: drop rows, watch rows, count violations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lapwright.schemas import Rule, TableSpec


def _holds(rule: Rule) -> Column:
    # A rule must be TRUE; an unknown outcome counts as a violation.
    return F.coalesce(F.expr(rule.predicate), F.lit(False))


def passes(spec: TableSpec) -> Column | None:
    """Whether a row breaks no dropping rule; None for a table without such rules."""
    dropping = [F.expr(f"({r.predicate})") for r in spec.rules if r.drops]
    return reduce(lambda a, b: a & b, dropping) if dropping else None


def enforce(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Drop rows that break any dropping rule of the table."""
    kept = passes(spec)
    return df if kept is None else df.where(kept)


def broken_rules(spec: TableSpec) -> Column:
    """The rules that a row breaks, as a number with one bit per rule, the first rule lowest."""
    bits = [F.when(~_holds(r), F.lit(1 << i)).otherwise(F.lit(0)) for i, r in enumerate(spec.rules)]
    return reduce(lambda a, b: a + b, bits) if bits else F.lit(0)


def dropping_bits(spec: TableSpec) -> int:
    """The bits of the rules that drop a row."""
    return sum(1 << i for i, r in enumerate(spec.rules) if r.drops)


def rule_names(broken: Column, spec: TableSpec) -> Column:
    """Names of the rules in a number of `broken_rules`, in their order, joined by commas."""
    return F.concat_ws(",", *[F.when(broken.bitwiseAND(1 << i) != 0, F.lit(r.name)) for i, r in enumerate(spec.rules)])


def observed(df: DataFrame, spec: TableSpec, name: str | Observation) -> DataFrame:
    """Attach row and violation counts to the job that reads ``df``; rows pass unchanged.

    The counts arrive with the query's own metrics, at no extra pass.
    """
    counts = [F.count_if(~_holds(r)).alias(r.name) for r in spec.rules]
    return df.observe(name, F.count(F.lit(1)).alias("rows"), *counts)


def violations(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Passed and failed rows per rule, from one pass over the table."""
    if not spec.rules:
        raise ValueError(f"{spec.endpoint} has no rules")
    names = [f"failed_{i}" for i in range(len(spec.rules))]
    totals = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(~_holds(r)).alias(n) for r, n in zip(spec.rules, names)],
    )
    lines = F.array(
        *[
            F.struct(
                F.lit(r.name).alias("rule"),
                F.lit("drop" if r.drops else "warn").alias("action"),
                (F.col("rows") - F.col(n)).alias("passed"),
                F.col(n).alias("failed"),
            )
            for r, n in zip(spec.rules, names)
        ]
    )
    return totals.select(F.inline(lines)).select(F.lit(spec.silver).alias("table_name"), "*")

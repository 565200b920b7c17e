"""Which tables there are and how many records they hold."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _records(tables: Mapping[str, DataFrame], name: str) -> DataFrame:
    """``records`` of a table; stored tables that know how to count themselves are not read."""
    counted = getattr(tables, "records", None)
    return counted(name) if counted else tables[name].agg(F.count(F.lit(1)).alias("records"))


def row_counts(tables: Mapping[str, DataFrame], names: Sequence[str]) -> DataFrame:
    """Records per table, one line each."""
    lines = [
        _records(tables, n).select(F.lit(n).alias("table_name"), "records")
        for n in names
    ]
    return reduce(DataFrame.unionByName, lines)


def table_audit(spark: SparkSession, tables: Mapping[str, DataFrame], names: Sequence[str]) -> DataFrame:
    """Presence and records of expected tables; a missing table has no record count."""
    lines = []
    for name in names:
        if name in tables:
            counted = _records(tables, name)
        else:
            counted = spark.range(1).select(F.lit(None).cast("bigint").alias("records"))
        lines.append(counted.select(F.lit(name).alias("table_name"), F.lit(name in tables).alias("exists"), "records"))
    return reduce(DataFrame.unionByName, lines)

"""Rows that a dropping rule keeps out of the cleaned tables, and lines that were no records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapwright.operators import rule_names
from lapwright.plans.cascade import BROKEN, Update
from lapwright.schemas import RESCUED, TABLES
from lapwright.sources.bucketed import KEPT

_COLUMNS = "table_name string, rules string, record string"


def quarantine(done: Update) -> DataFrame:
    """table_name, the rules that a row breaks, and the row as JSON text.

    A cleaned table stores kept and refused rows in folders of their own, so that this reads refused ones only. Lines that were no records come
    from the raw tables, with ``malformed`` for a rule.
    """
    stored, parts = done.stored, []
    for endpoint, spec in TABLES.items():
        if any(r.drops for r in spec.rules) and spec.silver in stored:
            rows = stored.rows(spec.silver).where(~F.col(KEPT))
            parts.append(rows.select(
                F.lit(spec.silver).alias("table_name"), rule_names(F.col(BROKEN), spec).alias("rules"),
                F.to_json(F.struct(*spec.schema.names)).alias("record"),
            ))
        if endpoint in done.bronze:
            parts.append(done.bronze.malformed(endpoint).select(
                F.lit(spec.silver).alias("table_name"), F.lit("malformed").alias("rules"), F.col(RESCUED).alias("record")
            ))
    return reduce(DataFrame.unionByName, parts) if parts else stored.spark.createDataFrame([], _COLUMNS)

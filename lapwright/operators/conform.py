"""Typed projection of raw columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import StructField

from lapwright.schemas import RESCUED, TableSpec


_LARGEST = "1.7976931348623157E308D"


def _typed(field: StructField, present: bool, rescued: bool) -> str:
    kind = field.dataType.simpleString()
    if not present:
        return f"cast(null as {kind}) as `{field.name}`"
    value = f"try_cast(`{field.name}` as {kind})"
    if rescued:
        text = f"get_json_object(`{RESCUED}`, '$.{field.name}')"
        value = f"coalesce({value}, try_cast({text} as {kind}))"
    if kind in ("double", "float"):
        # Neither NaN nor an infinity is a measure.
        value = f"case when {value} between -{_LARGEST} and {_LARGEST} then {value} end"
    return f"{value} as `{field.name}`"


def conform(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Cast raw columns to the table's types.

    A value that cannot be cast becomes NULL rather than failing the job, and a
    column that no file has carried yet is NULL. A value that did not fit its raw column
    is taken from the record's rescued text, where there is one. Open tables keep further
    columns.
    """
    arrived, fields = df.columns, spec.schema.fields
    listed = [_typed(f, f.name in arrived, RESCUED in arrived) for f in fields]
    if spec.open_schema:
        known = {*spec.schema.names, RESCUED}
        listed += [f"`{c}`" for c in arrived if c not in known]
    return df.selectExpr(*listed)

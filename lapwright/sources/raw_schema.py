"""Schema of raw JSON: found in the records, overridden by hints, remembered, and only ever widened.

Raw tables keep every record as one VARIANT value. The schema says which columns are taken out of it and with which
types when it is read, so a column that grows wider later changes the reading of earlier records, too, and loses nothing.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    NullType,
    StringType,
    StructField,
    StructType,
    VariantType,
)

from lapwright.schemas import RESCUED
from lapwright.sources import files
from lapwright.sources.landing import DATA

# Beside the type that a column is read with, the type that its values were found to have.
SEEN = "seen"


def json_files(reader: DataFrameReader) -> DataFrameReader:
    """Reader of the JSON files anywhere below a folder."""
    return reader.option("recursiveFileLookup", "true").option("pathGlobFilter", DATA)


def found_in(shape: str | None) -> StructType:
    """Columns and types of records, from what ``schema_of_variant_agg`` says about them."""
    if not shape or not shape.startswith("OBJECT<"):
        return StructType()
    return _plain(DataType.fromDDL(shape.replace("OBJECT<", "STRUCT<")))


def _plain(kind: DataType) -> DataType:
    """Decimals are read as doubles; values of several kinds, which stay variants, as text."""
    if isinstance(kind, DecimalType):
        return DoubleType()
    if isinstance(kind, VariantType):
        return StringType()
    if isinstance(kind, ArrayType):
        return ArrayType(_plain(kind.elementType))
    if isinstance(kind, StructType):
        return StructType([StructField(f.name, _plain(f.dataType)) for f in kind])
    return kind


def widened(a: DataType, b: DataType) -> DataType:
    """The narrowest type that holds values of both; in the end that is text."""
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    numbers = (IntegerType, LongType, DoubleType)
    if isinstance(a, numbers) and isinstance(b, numbers):
        return DoubleType() if DoubleType() in (a, b) else LongType()
    if isinstance(a, ArrayType) and isinstance(b, ArrayType):
        return ArrayType(widened(a.elementType, b.elementType))
    if isinstance(a, StructType) and isinstance(b, StructType):
        kinds = {f.name: f.dataType for f in a}
        for f in b:
            kinds[f.name] = widened(kinds.get(f.name, NullType()), f.dataType)
        return StructType([StructField(n, k) for n, k in kinds.items()])
    return StringType()


def merge(known: StructType, found: StructType, hints: StructType, listed: StructType | None = None) -> StructType:
    """Known columns keep their place, new ones follow, hinted types win.

    A column whose ``listed`` type is double starts as one, even if all values so far are whole numbers. The type of
    a listed column widens among numbers; a value of another kind stays in the record's rescued text, from where the cleaned
    table takes it. Any other column widens to whatever holds all its values.
    """
    hinted = {f.name: f.dataType for f in hints}
    fixed = {f.name: f.dataType for f in listed or ()}
    merged = {f.name.lower(): f for f in known}
    for field, seen in [*((f, NullType()) for f in hints), *((f, f.dataType) for f in found)]:
        name, old = field.name, merged.get(field.name.lower())
        if name == RESCUED or old is not None and old.name != name or "'" in name and '"' in name:
            continue  # names that differ in case only, or that no path can name: values stay in the record
        if old is not None:
            seen = widened(_seen(old), seen)
        if name in hinted:
            kind = hinted[name]
        elif old is None or isinstance(old.dataType, NullType):
            kind = field.dataType
            if isinstance(fixed.get(name), DoubleType) and isinstance(kind, LongType):
                kind = DoubleType()
        else:
            kind = widened(old.dataType, field.dataType)
            if name in fixed and isinstance(kind, StringType):
                kind = old.dataType
        merged[name.lower()] = StructField(name, kind, True, {SEEN: seen.json()})
    return StructType(list(merged.values()))


def _seen(field: StructField) -> DataType:
    said = (field.metadata or {}).get(SEEN)
    return StructType.fromJson({"fields": [{"name": "x", "type": json.loads(said), "nullable": True, "metadata": {}}]})["x"].dataType if said else field.dataType


def _ddl(kind: DataType) -> str:
    if isinstance(kind, NullType):
        return "string"
    if isinstance(kind, ArrayType):
        return f"array<{_ddl(kind.elementType)}>"
    if isinstance(kind, StructType):
        quoted = [f"`{f.name.replace('`', '``')}`: {_ddl(f.dataType)}" for f in kind]
        return f"struct<{', '.join(quoted)}>"
    return kind.simpleString()


def _path(name: str) -> str:
    quote = '"' if "'" in name else "'"
    return f"$[{quote}{name}{quote}]"


def read_as(record: Column, schema: StructType) -> list[Column]:
    """The columns of a schema, taken out of a record, and the text of the record if a value did not fit its column."""
    columns, misfits = [], F.lit(False)
    for field in schema:
        path, kind = _path(field.name), field.dataType
        value, seen = F.try_variant_get(record, path, _ddl(kind)), _seen(field)
        if isinstance(kind, (IntegerType, LongType)) and not isinstance(seen, (IntegerType, LongType, NullType)):
            number = F.try_variant_get(record, path, "double")
            value = F.when(number == F.floor(number), value)
        columns.append(value.alias(field.name))
        same = seen == kind or isinstance(kind, (StringType, NullType)) or isinstance(seen, NullType)
        if not same and not (isinstance(kind, DoubleType) and isinstance(seen, LongType)):
            raw = F.try_variant_get(record, path, "variant")
            misfits = misfits | (value.isNull() & raw.isNotNull() & ~F.is_variant_null(raw))
    return [*columns, F.coalesce(F.col(RESCUED), F.when(misfits, F.to_json(record))).alias(RESCUED)]


class SchemaStore:
    """Schemas per endpoint, one small text file per change, kept beside the tables."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _versions(self, endpoint: str) -> list[int]:
        names = files.child_names(self.spark, f"{self.root}/{endpoint}")
        return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))

    def load(self, endpoint: str) -> StructType | None:
        """Newest schema; None if no record was seen yet."""
        versions = self._versions(endpoint)
        if not versions:
            return None
        return StructType.fromJson(json.loads(files.read_text(self.spark, f"{self.root}/{endpoint}/v{versions[-1]}.json")))

    def save(self, endpoint: str, schema: StructType) -> None:
        if schema != self.load(endpoint):
            version = max(self._versions(endpoint), default=0) + 1
            files.write_text(self.spark, f"{self.root}/{endpoint}/v{version}.json", schema.json())

"""Vectors of whole numbers, read from Arrow lists into numpy matrices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import slices

SCALE = 256
LIMIT = 1 << 24  # a component beyond this counts as this, so that sums of products stay within a long
EXACT = 1 << 53  # up to here doubles hold every whole number


def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Row and place of every component, and the components; a null list has none."""
    sizes = np.asarray(pc.fill_null(pc.list_value_length(lists), 0), dtype=np.int64)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    return rows, np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes), lists.flatten()


def matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Rows of `width` components: missing ones are 0, and those behind are left out."""
    rows, places, values = _flat(lists)
    inside = places < width
    out = np.zeros((len(lists), width), dtype=np.int64)
    out[rows[inside], places[inside]] = np.asarray(values, dtype=np.int64)[inside]
    return out


def quantised(rows: DataFrame, vector_col: str = "vector") -> DataFrame:
    """Replace a vector by q, its components as floor(256 * x) held within LIMIT.

    Rows whose vector is null, or has a null or non-finite component, are left out; an empty vector stays.
    """
    others = rows.drop(vector_col)
    names = others.columns

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 4096):
                lists = part.column(vector_col)
                row, _, values = _flat(lists)
                x = np.asarray(pc.cast(values, pa.float64()).fill_null(np.nan), dtype=np.float64)
                keep = np.asarray(lists.is_valid()).copy()
                keep[row[~np.isfinite(x)]] = False
                with np.errstate(invalid="ignore", over="ignore"):
                    whole = np.clip(np.nan_to_num(np.floor(SCALE * x)), -LIMIT, LIMIT).astype(np.int32)
                sizes = np.bincount(row[keep[row]], minlength=len(lists))[keep]
                q = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(whole[keep[row]]))
                kept = part.filter(pa.array(keep))
                yield pa.RecordBatch.from_arrays([*map(kept.column, names), q], [*names, "q"])

    return rows.mapInArrow(task, T.StructType([*others.schema.fields, T.StructField("q", T.ArrayType(T.IntegerType()))]))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two integer matrices of one width."""
    high = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    if high < EXACT:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared Euclidean distances of the rows of two integer matrices of one width."""
    return (a * a).sum(axis=1)[:, None] - 2 * products(a, b) + (b * b).sum(axis=1)[None, :]

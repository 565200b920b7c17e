"""Helpers that several operators share."""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapwright.session import shared_folder
from lapwright.sources.files import delete


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table of the test data."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def whole_text(name: str = "text") -> Column:
    """The text, where a null counts as an empty one."""
    return F.coalesce(F.col(name), F.lit(""))


def identity(id_col: str = "doc_id", text_col: str = "text") -> list[Column]:
    """Columns that stand for a row: its id and two independent 64-bit hashes of its text.

    Rows with the same id and text are the same document and get the same result.
    """
    text = whole_text(text_col)
    return [F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2")]


def on_identity(left: DataFrame, right: DataFrame, how: str = "left") -> DataFrame:
    """Join on the columns of `identity`, where two null ids are equal; `right` has one row per identity."""
    keys = {c: f"other {c}" for c in ("doc_id", "h1", "h2")}
    same = F.col("doc_id").eqNullSafe(F.col("`other doc_id`"))
    for c in ("h1", "h2"):
        same = same & (F.col(c) == F.col(f"`other {c}`"))
    return left.join(right.withColumnsRenamed(keys), same, how).drop(*keys.values())


def scratch(spark: SparkSession) -> str:
    """A new folder name below the folder that driver and executors share."""
    return f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder and read them back, which cuts the lineage.

    A lost executor costs no recomputation of what was written.
    """
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back._stored_at = path
    return back


def shuffled(df: DataFrame) -> DataFrame:
    """The rows for a join that shuffles both sides and sorts them, and so sends no table through the driver.

    For tables that grow with the input. Spark takes their size from compressed files and does not count what an explode
    adds, so that it may broadcast one that is many times larger than its threshold.
    """
    return df.hint("merge")


def discard(*frames: DataFrame) -> None:
    """Delete what `stored` wrote, once nothing reads it any more."""
    for df in frames:
        delete(df.sparkSession, df._stored_at)


class _Sent:
    """Pickles an object together with its classes and comes back as the object itself."""

    def __init__(self, value: object):
        self.value = value

    def __reduce__(self):
        return pickle.loads, (cloudpickle.dumps(self.value),)


class Built:
    """Pickles as a call and comes back as what the call returns, so that the object is made where it is loaded."""

    def __init__(self, make: Callable, *args: object):
        self.make, self.args = make, args

    def __reduce__(self):
        return _built, (cloudpickle.dumps((self.make, self.args)),)


def _built(call: bytes) -> object:
    make, args = pickle.loads(call)
    return make(*args)


def sent_built(spark: SparkSession, make: Callable, *args: object) -> Broadcast:
    """Send the arguments to all tasks, where a Python worker makes the object once; the driver never holds it."""
    return spark.sparkContext.broadcast(Built(make, *args))


def sent(spark: SparkSession, value: object) -> Broadcast:
    """Send an object of proven size to all tasks. A Python worker loads it once, for all its tasks."""
    return spark.sparkContext.broadcast(_Sent(value))


def slices(batch: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    """A batch in parts, so that a task holds the Python objects of few rows at a time."""
    for k in range(0, batch.num_rows, rows):
        yield batch.slice(k, rows)

"""Landing zone: one folder of JSON-lines files per endpoint."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Field of a packed record that names its batch.
LANDED_BATCH = "_landed_batch"

# Records of a compressed file: some megabytes.
RECORDS = 200_000
# Names of data files.
DATA = "*.{json,json.gz}"

# UTC, with enough digits for any timestamp Spark holds.
_WRITE_OPTIONS = {
    "timeZone": "UTC",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def endpoint_folder(root: str, endpoint: str) -> str:
    return f"{root.rstrip('/')}/{endpoint}"


def land(df: DataFrame, root: str, endpoint: str, records_per_file: int = 0, compressed: bool = False) -> str:
    """Add records to an endpoint's folder as JSON lines.

    Files appear when the job commits, so a reader never sees half of one. With
    ``records_per_file`` a task closes a file at that many records and opens the next
    (10,000 is the usual telemetry batch). An empty frame leaves no data file. A
    compressed file is read by one task, so that without a number it is closed at `RECORDS`.
    """
    folder = endpoint_folder(root, endpoint)
    writer = df.write.mode("append").options(**_WRITE_OPTIONS, compression="gzip" if compressed else "none")
    if records_per_file or compressed:
        writer = writer.option("maxRecordsPerFile", records_per_file or RECORDS)
    writer.json(folder)
    return folder


def batch_name(by: tuple[str, ...]) -> Column:
    """Name of a batch, such as ``session_key_7_driver_number_44``."""
    return F.concat_ws("_", *[p for c in by for p in (F.lit(c), F.col(c).cast("string"))])


def land_batches(
    df: DataFrame, root: str, endpoint: str, by: tuple[str, ...] = ("session_key", "driver_number"),
    name: Column | None = None, compressed: bool = False,
) -> str:
    """Add records in one sub-folder per batch, such as ``session_key_7_driver_number_44``, or by a given ``name``.

    For endpoints that are fetched piece by piece. Rows of a batch are brought
    together first, so that it makes few files; Spark splits a batch that is too
    large for one task. The records keep all their columns. For very many batches, see `land_packed`.
    """
    folder = endpoint_folder(root, endpoint)
    grouped = df.withColumn("batch", name if name is not None else batch_name(by)).hint("rebalance", "batch")
    writer = grouped.write.mode("append").options(**_WRITE_OPTIONS, compression="gzip" if compressed else "none")
    writer.partitionBy("batch").json(folder)
    return folder


def land_packed(
    df: DataFrame, root: str, endpoint: str, by: tuple[str, ...] = ("session_key", "driver_number"),
) -> str:
    """Add the records of many small batches, any number of batches to a file; every record names its batch in ``_landed_batch``.

    A folder per batch makes as many files as there are batches. Here, files follow the bytes landed:
    rows of a batch are brought together, and Spark fills files with them.
    """
    folder = endpoint_folder(root, endpoint)
    packed = df.withColumn(LANDED_BATCH, batch_name(by)).hint("rebalance", LANDED_BATCH)
    packed.write.mode("append").options(**_WRITE_OPTIONS).json(folder)
    return folder


def replace_endpoint(df: DataFrame, root: str, endpoint: str) -> str:
    """Put records in place of all earlier ones of an endpoint."""
    folder = endpoint_folder(root, endpoint)
    df.write.mode("overwrite").options(**_WRITE_OPTIONS).json(folder)
    return folder


def read_landed(spark: SparkSession, root: str, endpoint: str) -> DataFrame:
    """All landed records of an endpoint in one batch, types inferred."""
    return (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", DATA)
        .json(endpoint_folder(root, endpoint))
    )


def data_files(spark: SparkSession, root: str, endpoint: str) -> DataFrame:
    """Data files of an endpoint; names starting with ``_`` are not data."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", DATA)
        .option("recursiveFileLookup", "true")
        .load(endpoint_folder(root, endpoint))
        .select("path", "length", "modificationTime")
        .where(~F.element_at(F.split("path", "/"), -1).startswith("_"))
    )

"""Tables by name: derived on demand, or stored under a folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lapwright.operators.layout import clustered
from lapwright.sources import files


def empty(spark: SparkSession, schema: StructType | str) -> DataFrame:
    """A frame without rows. Spark knows from its plan that it has none, so that no task is started for them."""
    fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields]).where(F.lit(False))


class LazyTables(Mapping):
    """Name to DataFrame; a frame is declared the first time it is asked for.

    ``counters`` give the number of records of tables that need not be read for it.
    """

    def __init__(
        self,
        builders: Mapping[str, Callable[[Mapping[str, DataFrame]], DataFrame]],
        counters: Mapping[str, Callable[[], DataFrame]] | None = None,
    ):
        self._builders = dict(builders)
        self._counters = dict(counters or {})
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self._builders[name](self)
        return self._frames[name]

    def records(self, name: str) -> DataFrame:
        """One row with the number of ``records`` of a table."""
        if name in self._counters:
            return self._counters[name]()
        return self[name].agg(F.count(F.lit(1)).alias("records"))

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)

    def __contains__(self, name: object) -> bool:
        return name in self._builders


class StoredTables(Mapping):
    """Parquet tables under ``root``, each fully rewritten on every update.

    A rewrite goes to a new version folder. Readers take the newest folder that
    Spark marked as complete, so a job that dies half-way changes nothing and a
    running reader keeps its files.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _versions(self, name: str) -> list[int]:
        folder = f"{self.root}/{name}"
        found = [n for n in files.child_names(self.spark, folder) if n.startswith("v=")]
        return sorted(int(n[2:]) for n in found)

    def location(self, name: str) -> str | None:
        """Folder of the newest complete version."""
        for version in reversed(self._versions(name)):
            folder = f"{self.root}/{name}/v={version}"
            if files.exists(self.spark, f"{folder}/_SUCCESS"):
                return folder
        return None

    def written(self, name: str) -> int:
        """When the newest complete version was finished, in milliseconds; 0 if there is none."""
        folder = self.location(name)
        return files.newest(self.spark, folder) if folder else 0

    def overwrite(self, name: str, df: DataFrame, layout: tuple[str, ...] = ()) -> str:
        """Write the whole table anew; ``layout`` names the columns to cluster by."""
        version = max(self._versions(name), default=0) + 1
        folder = f"{self.root}/{name}/v={version}"
        clustered(df, layout).write.mode("error").parquet(folder)
        return folder

    def prune(self, name: str, keep: int = 2) -> None:
        """Delete all but the newest complete versions, and remains of failed writes before them."""
        complete = [v for v in self._versions(name) if files.exists(self.spark, f"{self.root}/{name}/v={v}/_SUCCESS")]
        if len(complete) > keep:
            for version in self._versions(name):
                if version < complete[-keep]:
                    files.delete(self.spark, f"{self.root}/{name}/v={version}")

    def __getitem__(self, name: str) -> DataFrame:
        folder = self.location(name)
        if folder is None:
            raise KeyError(name)
        return self.spark.read.parquet(folder)

    def __iter__(self) -> Iterator[str]:
        names = files.child_names(self.spark, self.root)
        return iter(sorted(n for n in names if self.location(n)))

    def __len__(self) -> int:
        return sum(1 for _ in self)

    def __contains__(self, name: object) -> bool:
        return isinstance(name, str) and self.location(name) is not None


def register(tables: Mapping[str, DataFrame], names: list[str] | None = None) -> list[str]:
    """Make tables visible to ``spark.sql`` under their names, for this session."""
    chosen = list(names if names is not None else tables)
    for name in chosen:
        tables[name].createOrReplaceTempView(name)
    return chosen


def save_as_table(df: DataFrame, name: str, location: str | None = None) -> None:
    """Keep an answer as a catalog table, replacing an earlier one; its files go to ``location`` if one is given."""
    writer = df.write.mode("overwrite")
    if location:
        writer = writer.option("path", location)
    writer.saveAsTable(name)


def table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table or registered view."""
    return spark.table(name)


def preview(df: DataFrame, rows: int = 10) -> DataFrame:
    """A few rows to look at, whichever come first."""
    return df.limit(rows)


def list_tables(spark: SparkSession, database: str | None = None) -> list[str]:
    """Names in the catalog, views included."""
    return sorted(t.name for t in spark.catalog.listTables(database))

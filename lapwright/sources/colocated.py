"""Tables in the same buckets of the same keys, which Spark joins and groups without a shuffle.

Only tables with at most a row per session and driver are kept this way: drivers, sessions, states and aggregate tables. Rows of
a hot session are many laps, but not many drivers. Raw rows stay in ordinary tables, whose joins adaptive execution can split;
a scan of buckets cannot be split.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapwright.sources import files
from lapwright.sources.tables import LazyTables, table

ENTRY, SESSION = ("session_key", "driver_number"), ("session_key",)
# What a table is most often joined on. States meet drivers; aggregate tables meet sessions and each other.
KEYS = {
    "silver_drivers": ENTRY, "state_pace": ENTRY, "state_pit": ENTRY, "state_best_lap": ENTRY,
    "silver_sessions": SESSION, "state_race_laps": SESSION, "state_messages": SESSION, "state_weather": SESSION,
    "gold_driver_performance": SESSION, "gold_fastest_laps": SESSION, "gold_team_performance": SESSION, "gold_race_summary": SESSION,
}
BUCKETS = 64
UNEVEN, FEW = 4, 100_000  # a bucket of more rows than FEW may have UNEVEN even shares at most


def is_even(df: DataFrame, keys: Sequence[str], buckets: int = BUCKETS, uneven: int = UNEVEN, few: int = FEW) -> bool:
    """Whether no bucket is much larger than the others; reads the keys only. An empty table is even."""
    sizes = df.groupBy(F.pmod(F.hash(*keys), F.lit(buckets)).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    found = sizes.agg(F.max("n").alias("most"), F.sum("n").alias("total")).first()
    return not found["total"] or found["most"] <= max(few, uneven * found["total"] / buckets)


class Colocated:
    """Bucketed tables below ``root``, registered in the catalog under ``prefix``.

    Every write goes to a new version folder and the catalog entry moves there when it is complete. The version before
    stays for running readers.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS, prefix: str | None = None):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets
        self.prefix = prefix if prefix is not None else f"colocated_{uuid.uuid4().hex}_"

    def _versions(self, name: str) -> list[int]:
        return sorted(int(n[2:]) for n in files.child_names(self.spark, f"{self.root}/{name}") if n.startswith("v="))

    def write(self, name: str, df: DataFrame, keys: Sequence[str] | None = None) -> bool:
        """Write a table anew; False if its keys are so uneven that it is stored without buckets.

        Rows with a null key are kept, in one bucket, and match nothing, as in any join.
        """
        keys = list(keys or KEYS[name])
        earlier = self._versions(name)
        folder = f"{self.root}/{name}/v={max(earlier, default=0) + 1}"
        even = is_even(df, keys, self.buckets)
        # Spark's shuffle and its buckets place a row by the same hash, so that every bucket becomes one file.
        rows = df.repartition(self.buckets, *keys) if even else df
        writer = rows.write.mode("overwrite").option("path", folder)
        if even:
            writer = writer.bucketBy(self.buckets, *keys).sortBy(*keys)
        writer.saveAsTable(self.prefix + name)
        for version in earlier[:-1]:
            files.delete(self.spark, f"{self.root}/{name}/v={version}")
        return even

    def tables(self, names: Sequence[str]) -> LazyTables:
        """Tables by name, as plans take them."""
        return LazyTables({n: (lambda _t, n=n: table(self.spark, self.prefix + n)) for n in names})

    def drop(self) -> None:
        """Take the tables out of the catalog; their files stay."""
        for name in files.child_names(self.spark, self.root):
            self.spark.sql(f"drop table if exists `{self.prefix}{name}`")

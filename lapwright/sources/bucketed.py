"""Stored tables in buckets of one key, so that an update rewrites the buckets that it concerns and no others."""

from __future__ import annotations

import json
import time
from collections.abc import Iterable, Iterator, Mapping
from contextlib import contextmanager, nullcontext
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StructField, StructType

from lapwright.sources import files
from lapwright.sources.tables import empty

BUCKET, KEPT, WRITE = "_bucket", "_kept", "_write"
BUCKETS = 64


def bucket_of(key: Column, buckets: int) -> Column:
    """Bucket of a key of any whole-number type; rows without key share one."""
    return F.pmod(F.xxhash64(key.cast("long")), F.lit(buckets)).cast("int")


@contextmanager
def reads_footers(spark: SparkSession) -> Iterator[None]:
    """Parquet files named inside are opened by the reader that takes counts from file footers."""
    listed = spark.conf.get("spark.sql.sources.useV1SourceList")
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")  # looked at when a query is planned; others do not use it
    spark.conf.set("spark.sql.sources.useV1SourceList", ",".join(n for n in listed.split(",") if n != "parquet"))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.sources.useV1SourceList", listed)


@dataclass
class Manifest:
    """One version of a table: for each bucket, the writes whose files make it up."""

    version: int
    schema: str
    sets: dict[str, list[int]]
    split: bool
    # The last version that was written as a whole; what was derived from older ones has to be derived anew.
    base: int
    # Up to where the inputs had been read: batches of a stream, versions of other tables.
    read: dict[str, int] = field(default_factory=dict)
    # Totals per bucket, by name.
    counts: dict[str, dict[str, int]] = field(default_factory=dict)
    written: int = 0

    def totals(self) -> dict[str, int]:
        names = {n for c in self.counts.values() for n in c}
        return {n: sum(c.get(n, 0) for c in self.counts.values()) for n in names}


class BucketedTables(Mapping):
    """Parquet tables under ``root``, whose rows carry a bucket number in ``_bucket``.

    A write puts files into a new folder, one sub-folder per bucket, and then adds a manifest that names the folders
    of every bucket. A manifest appears as a whole, so a job that dies half-way changes nothing and a running reader
    keeps its files. A manifest lists buckets, not rows or files; its size does not grow with the data.

    Rows of a table that is ``split`` carry ``_kept``: readers by name see the kept ones, `rows` has all.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def versions(self, name: str) -> list[int]:
        """Numbers of the complete versions."""
        found = [n for n in files.child_names(self.spark, f"{self.root}/{name}") if n.startswith("manifest-")]
        return sorted(int(n[9:-5]) for n in found)

    def manifest(self, name: str, version: int | None = None) -> Manifest | None:
        """A version of a table, by default the newest; None if it is not there."""
        known = self.versions(name)
        if not known or version is not None and version not in known:
            return None
        at = f"{self.root}/{name}/manifest-{known[-1] if version is None else version}.json"
        return Manifest(**json.loads(files.read_text(self.spark, at)))

    def next_version(self, name: str) -> int:
        return max([*self.versions(name), *self._writes(name)], default=0) + 1

    def _writes(self, name: str) -> list[int]:
        """Numbers of the folders of files, complete or not."""
        found = files.child_names(self.spark, f"{self.root}/{name}")
        return sorted(int(n.partition("=")[2]) for n in found if n.startswith(f"{WRITE}="))

    def write(
        self,
        name: str,
        df: DataFrame,
        buckets: Iterable[int] | None = None,
        add: bool = False,
        layout: tuple[str, ...] = (),
        read: Mapping[str, int] | None = None,
        count: Mapping[str, Column] | None = None,
    ) -> Manifest:
        """Write ``df`` in place of the whole table, or in place of the given buckets; with ``add``, beside what they hold.

        Rows are clustered by bucket and sorted by ``layout``; a large bucket makes several files. ``count`` names
        aggregates that are kept per bucket with the manifest.
        """
        before = self.manifest(name)
        version = self.next_version(name)
        folder = f"{self.root}/{name}/{WRITE}={version}"
        split = KEPT in df.columns
        parts = [BUCKET, KEPT] if split else [BUCKET]
        rows = df.hint("rebalance", BUCKET).sortWithinPartitions(*parts, *layout)
        rows.write.mode("error").partitionBy(*parts).parquet(folder)
        written = sorted(int(n.partition("=")[2]) for n in files.child_names(self.spark, folder) if n.startswith(f"{BUCKET}="))

        schema = StructType([f for f in df.schema if f.name not in (BUCKET, KEPT)])
        whole = buckets is None or before is None
        sets = {} if whole else {b: s for b, s in before.sets.items() if add or int(b) not in set(buckets)}
        for b in written:
            sets[str(b)] = [*sets.get(str(b), []), version]
        counts = {} if whole else {b: dict(c) for b, c in before.counts.items() if b in sets and (add or int(b) not in set(buckets))}
        if count and written:
            new = self._read(name, [folder], schema, split, None).groupBy(BUCKET).agg(*[c.alias(n) for n, c in count.items()])
            for r in new.collect():  # one row per bucket
                old = counts.get(str(r[BUCKET]), {}) if add else {}
                counts[str(r[BUCKET])] = {n: r[n] + old.get(n, 0) for n in count}
        made = Manifest(
            version, schema.json(), sets, split, version if whole else before.base, dict(read or {}), counts, int(time.time() * 1000)
        )
        files.write_text(self.spark, f"{self.root}/{name}/manifest-{version}.json", json.dumps(asdict(made)))
        return made

    def mark(self, name: str, read: Mapping[str, int]) -> Manifest:
        """Note how far the inputs have been read where that changed no row; the files stay."""
        made = self.manifest(name)
        made.version, made.read = self.next_version(name), dict(read)
        files.write_text(self.spark, f"{self.root}/{name}/manifest-{made.version}.json", json.dumps(asdict(made)))
        return made

    def _read(
        self, name: str, paths: list[str], schema: StructType, split: bool, kept: bool | None, footers: bool = False
    ) -> DataFrame:
        more = [StructField(WRITE, IntegerType()), StructField(BUCKET, IntegerType()), *([StructField(KEPT, BooleanType())] if split else [])]
        full = StructType([*schema, *more])
        if not paths:
            return empty(self.spark, full).drop(WRITE)
        reader = self.spark.read.schema(full).option("basePath", f"{self.root}/{name}")
        with reads_footers(self.spark) if footers else nullcontext():
            rows = reader.parquet(*paths).drop(WRITE)
        return rows.where(F.col(KEPT) == kept) if split and kept is not None else rows

    def rows(
        self, name: str, buckets: Iterable[int] | None = None, version: int | None = None, kept: bool | None = None
    ) -> DataFrame:
        """All rows of a version with their bucket, in some buckets or all; of a split table also with ``_kept``."""
        return self._rows(name, buckets, version, kept)

    def records(self, name: str, by_bucket: bool = False) -> DataFrame:
        """``records`` of the newest version as readers see it, in all or per ``_bucket``, from the footers of its files.

        Counts are pushed into the reader, so no column is read and the work grows with files, not rows.
        """
        rows = self._rows(name, kept=True, footers=True)
        return rows.groupBy(*[BUCKET] * by_bucket).agg(F.count(F.lit(1)).alias("records"))

    def _rows(
        self, name: str, buckets: Iterable[int] | None = None, version: int | None = None, kept: bool | None = None,
        footers: bool = False,
    ) -> DataFrame:
        made = self.manifest(name, version)
        if made is None:
            raise KeyError(name)
        wanted = set(made.sets) if buckets is None else {str(b) for b in buckets} & set(made.sets)
        by_write: dict[int, list[str]] = {}
        for b in sorted(wanted, key=int):
            for number in made.sets[b]:
                by_write.setdefault(number, []).append(b)
        paths = []
        for number, alive in sorted(by_write.items()):
            base = f"{self.root}/{name}/{WRITE}={number}"
            there = {n.partition("=")[2] for n in files.child_names(self.spark, base) if n.startswith(f"{BUCKET}=")}
            paths += [base] if there == set(alive) else [f"{base}/{BUCKET}={b}" for b in alive]
        return self._read(name, paths, StructType.fromJson(json.loads(made.schema)), made.split, kept, footers)

    def changed_buckets(self, name: str, since: int) -> set[int] | None:
        """Buckets that differ between an earlier version and the newest; None if that version is gone or was replaced as a whole."""
        old, new = self.manifest(name, since), self.manifest(name)
        if old is None or old.version < new.base:
            return None
        return {int(b) for b in {*old.sets, *new.sets} if old.sets.get(b) != new.sets.get(b)}

    def prune(self, name: str, keep: int = 2) -> None:
        """Delete all but the newest versions, and the files that none of these names."""
        known = self.versions(name)
        used: set[tuple[int, str]] = set()
        for version in known[-keep:]:
            used |= {(number, b) for b, s in self.manifest(name, version).sets.items() for number in s}
        for version in known[:-keep]:
            files.delete(self.spark, f"{self.root}/{name}/manifest-{version}.json")
        for number in self._writes(name):
            if number > known[-1]:
                continue
            at = f"{self.root}/{name}/{WRITE}={number}"
            if number not in {n for n, _ in used}:
                files.delete(self.spark, at)
                continue
            for part in files.child_names(self.spark, at):
                if part.startswith(f"{BUCKET}=") and (number, part.partition("=")[2]) not in used:
                    files.delete(self.spark, f"{at}/{part}")

    def __getitem__(self, name: str) -> DataFrame:
        hidden = [f.name for f in self._schema(name) if f.name.startswith("__")]
        rows = self.rows(name, kept=True)
        return rows.drop(BUCKET, KEPT, *hidden)

    def _schema(self, name: str) -> StructType:
        made = self.manifest(name)
        if made is None:
            raise KeyError(name)
        return StructType.fromJson(json.loads(made.schema))

    def __iter__(self) -> Iterator[str]:
        return iter(sorted(n for n in files.child_names(self.spark, self.root) if self.versions(n)))

    def __len__(self) -> int:
        return sum(1 for _ in self)

    def __contains__(self, name: object) -> bool:
        return isinstance(name, str) and bool(self.versions(name))


class InBuckets(Mapping):
    """Stored tables, of which only some buckets are read."""

    def __init__(self, tables: BucketedTables, buckets: Iterable[int] | None):
        self.tables = tables
        self.buckets = None if buckets is None else sorted(buckets)

    def __getitem__(self, name: str) -> DataFrame:
        rows = self.tables.rows(name, self.buckets, kept=True)
        return rows.drop(BUCKET, KEPT, *[c for c in rows.columns if c.startswith("__")])

    def __iter__(self) -> Iterator[str]:
        return iter(self.tables)

    def __len__(self) -> int:
        return len(self.tables)

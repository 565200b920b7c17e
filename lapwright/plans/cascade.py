"""One update of all tables: landing, raw, cleaned, aggregated. It costs what has changed.

Cleaned tables are stored in buckets of the session. An update types the new records only, finds the buckets they fall in,
and puts them beside the stored rows of those buckets: of a key, the first of all copies is the first of the stored row
and the new ones. All other buckets keep their files. States and aggregate tables then follow in the buckets whose files
have changed since they were written.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lapwright.operators import broken_rules, conform, dropping_bits, keep_first, passes
from lapwright.plans.gold import GOLD, SOURCES
from lapwright.plans.states import STATES, advanced
from lapwright.schemas import GOLD_FROM_GOLD, GOLD_FROM_SILVER, GOLD_LAYOUT, TABLES, TableSpec
from lapwright.session import without_broadcasts
from lapwright.sources import files
from lapwright.sources.bucketed import BUCKET, BUCKETS, KEPT, BucketedTables, InBuckets, bucket_of
from lapwright.sources.tables import LazyTables, empty
from lapwright.streaming.bronze import Bronze

PROCESSED_AT = "_processed_timestamp"
# Hidden columns of cleaned tables: the rules that a row breaks, and the version of the table that first had it.
BROKEN, VERSION = "__broken", "__version"


@dataclass
class Update:
    """What an update read and wrote."""

    bronze: Bronze
    tables: Mapping[str, DataFrame]
    stored: BucketedTables
    ingested: dict[str, int] = field(default_factory=dict)
    written: list[str] = field(default_factory=list)
    # Rows and violations per rule of every rewritten silver table as a whole, and lines that were no records, per endpoint.
    metrics: dict[str, dict[str, int]] = field(default_factory=dict)
    malformed: dict[str, int] = field(default_factory=dict)
    failed: dict[str, Exception] = field(default_factory=dict)


class PartlyFailed(RuntimeError):
    """Some streams failed; ``done`` is what was updated without them, and holds their errors."""

    def __init__(self, done: Update):
        super().__init__("; ".join(f"{e}: {error}" for e, error in sorted(done.failed.items())))
        self.done = done


def _stamped(df: DataFrame) -> DataFrame:
    return df.withColumn(PROCESSED_AT, F.current_timestamp())


def _bucket_key(spec: TableSpec) -> str:
    return "session_key" if "session_key" in spec.schema.names else spec.key[0]


def all_tables(bronze: Bronze, stored: BucketedTables) -> LazyTables:
    """Bronze, silver and gold tables under their usual names, read from storage."""
    known = {TABLES[e].bronze: (lambda _t, e=e: bronze[e]) for e in bronze if e in TABLES}
    known.update({n: (lambda _t, n=n: stored[n]) for n in stored})
    return LazyTables(known, {n: (lambda n=n: stored.records(n)) for n in stored})


def _number_of_buckets(spark: SparkSession, root: str, wanted: int) -> int:
    """Buckets of the tables under ``root``: fixed by the first update."""
    at = f"{root}/buckets.txt"
    if not files.exists(spark, at):
        files.write_text(spark, at, str(wanted))
    return int(files.read_text(spark, at))


class _Refresh:
    """The steps of one update."""

    def __init__(self, bronze: Bronze, stored: BucketedTables, buckets: int, rebuild: bool):
        self.bronze, self.stored, self.buckets, self.rebuild = bronze, stored, buckets, rebuild
        self.ingested = set(bronze)

    def _typed(self, endpoint: str, since: int) -> DataFrame:
        spec = TABLES[endpoint]
        if endpoint in self.ingested:
            raw = self.bronze.arrived(endpoint, since)
        else:
            raw = empty(self.bronze.spark, spec.schema)
        rows = _stamped(conform(raw, spec)).withColumn(VERSION, F.lit(self.stored.next_version(spec.silver)))
        return rows.withColumn(BUCKET, bucket_of(F.col(_bucket_key(spec)), self.buckets))

    def silver(self, endpoint: str) -> str | None:
        """Bring a cleaned table up to the newest batch; its name if that changed it."""
        spec, stored = TABLES[endpoint], self.stored
        name, mine, last = spec.silver, stored.manifest(spec.silver), self.bronze.last_batch(endpoint)
        if mine is not None and endpoint not in self.ingested:
            return None
        read = {"generation": self.bronze.generation, "batch": last}
        whole = mine is None or self.rebuild or mine.read["generation"] != self.bronze.generation
        if not whole and mine.read["batch"] >= last:
            return None
        rows, touched = self._typed(endpoint, -1 if whole else mine.read["batch"]), None
        if not whole and _other_types(StructType.fromJson(json.loads(mine.schema)), rows.schema):
            whole, rows = True, self._typed(endpoint, -1)  # a further column of an open table has become wider
        if not whole:
            touched = {r[0] for r in rows.select(BUCKET).distinct().collect()}
        if spec.key:
            if touched is not None:
                rows = stored.rows(name, touched).drop(KEPT, BROKEN).unionByName(rows, allowMissingColumns=True)
            order = [c for c in spec.schema.names if c not in spec.key]
            rows = keep_first(rows, spec.key, [*order, VERSION], prefer=passes(spec))
        rows = rows.withColumn(BROKEN, broken_rules(spec))
        rows = rows.withColumn(KEPT, F.col(BROKEN).bitwiseAND(dropping_bits(spec)) == 0)
        count = {"rows": F.count(F.lit(1))}
        count |= {r.name: F.count_if(F.col(BROKEN).bitwiseAND(1 << i) != 0) for i, r in enumerate(spec.rules)}
        stored.write(name, rows, touched, add=not whole and not spec.key, layout=spec.layout, read=read, count=count)
        return name

    def state(self, name: str) -> str | None:
        """Bring the partial aggregates of a cleaned table up to its newest version."""
        kind, stored = STATES[name], self.stored
        now, mine, more = stored.manifest(kind.silver), stored.manifest(name), [BUCKET]
        read = {kind.silver: now.version}
        since = mine.read[kind.silver] if mine else -1
        changed = None if mine is None or self.rebuild else stored.changed_buckets(kind.silver, since)
        if changed is None:
            stored.write(name, kind.of(stored.rows(kind.silver, kept=True), more), read=read)
            return name
        if not changed:
            if since != now.version:
                stored.mark(name, read)
            return None
        rows = stored.rows(kind.silver, changed, kept=True)
        if TABLES[kind.endpoint].key:
            made = kind.of(rows, more)  # a corrected copy may have replaced a row
        else:
            made = advanced(kind, stored.rows(name, changed), rows, rows.where(F.col(VERSION) > since), None, more)
        stored.write(name, made, changed, read=read)
        return name

    def gold(self, name: str) -> str | None:
        """Work an aggregate table out again in the buckets in which its sources have changed."""
        stored, mine = self.stored, self.stored.manifest(name)
        read = {source: stored.manifest(source).version for source in SOURCES[name]}
        changed: set[int] | None = None if mine is None or self.rebuild else set()
        for source in SOURCES[name]:
            found = stored.changed_buckets(source, mine.read[source]) if changed is not None else None
            changed = None if found is None else changed | found
        if changed is not None and not changed:
            if mine.read != read:
                stored.mark(name, read)
            return None
        rows = _stamped(GOLD[name](InBuckets(stored, changed)))
        rows = rows.withColumn(BUCKET, bucket_of(F.col("session_key"), self.buckets))
        stored.write(name, rows, changed, layout=GOLD_LAYOUT[name], read=read)
        return name


def _other_types(old: StructType, new: StructType) -> bool:
    kinds = {f.name: f.dataType for f in old}
    return any(f.name in kinds and kinds[f.name] != f.dataType for f in new)


def update(
    spark: SparkSession,
    landing: str,
    root: str,
    endpoints: Iterable[str] | None = None,
    full_refresh: bool = False,
    keep_versions: int = 2,
    rebuild: bool = False,
    buckets: int = BUCKETS,
) -> Update:
    """Ingest new files, then bring the cleaned and aggregated tables up to them.

    A table changes only in the buckets of the sessions that new records concern; their number is fixed by the first update.
    ``rebuild`` makes all tables anew, for changed definitions. ``full_refresh`` reads all landed files again
    into a new generation of raw tables; with ``endpoints``, tables of other endpoints stay as they are. Of each table the newest ``keep_versions``
    are kept, so that those who still read the version before can finish. A session that stops half-way leaves the
    earlier versions in place; the next update goes on from the checkpoints, and every table from the versions that it was
    made from. If the stream of an endpoint fails, everything else is still updated, and ``PartlyFailed`` tells of both.
    """
    home = root.rstrip("/")
    bronze = Bronze(spark, landing, f"{home}/bronze")
    if full_refresh:
        bronze = bronze.restarted()
    stored = BucketedTables(spark, f"{home}/tables")
    done = Update(bronze, {}, stored)
    done.ingested = bronze.ingest(endpoints or TABLES, done.failed)

    # Tables of one step do not read each other: small ones run beside large ones.
    steps = _Refresh(bronze, stored, _number_of_buckets(spark, home, buckets), rebuild)
    with without_broadcasts(spark), ThreadPoolExecutor(max_workers=8) as pool:
        for step, names in (
            (steps.silver, TABLES), (steps.state, STATES), (steps.gold, GOLD_FROM_SILVER), (steps.gold, GOLD_FROM_GOLD)
        ):
            done.written += [n for n in pool.map(step, names) if n]
    for endpoint, spec in TABLES.items():
        if spec.silver in done.written:
            found = stored.manifest(spec.silver).totals()
            done.metrics[spec.silver] = {n: found.get(n, 0) for n in ("rows", *(r.name for r in spec.rules))}
            if endpoint in steps.ingested:
                done.malformed[endpoint] = bronze.files(endpoint).agg(F.coalesce(F.sum("malformed"), F.lit(0))).first()[0]
    _note(spark, home, done.metrics)
    if full_refresh and steps.ingested.issuperset(e for e in TABLES if bronze.landed(e)):
        bronze.prune()
    for name in done.written:
        stored.prune(name, keep_versions)
    done.tables = all_tables(bronze, stored)
    if done.failed:
        raise PartlyFailed(done)
    return done


_HISTORY = "run long, at timestamp, table_name string, rule string, action string, passed long, failed long"


def _note(spark: SparkSession, home: str, metrics: Mapping[str, Mapping[str, int]]) -> None:
    """Keep the counts per rule of the tables that a run has changed."""
    specs = {spec.silver: spec for spec in TABLES.values() if spec.rules and spec.silver in metrics}
    runs = [int(n[4:-5]) for n in files.child_names(spark, f"{home}/history") if n.startswith("run-")]
    run, at = max(runs, default=0) + 1, dt.datetime.now(dt.timezone.utc).isoformat()
    lines = [
        json.dumps({
            "run": run, "at": at, "table_name": name, "rule": r.name, "action": "drop" if r.drops else "warn",
            "passed": metrics[name]["rows"] - metrics[name][r.name], "failed": metrics[name][r.name],
        })
        for name, spec in specs.items() for r in spec.rules
    ]
    if lines:
        files.write_text(spark, f"{home}/history/run-{run}.json", "\n".join(lines) + "\n")


def rule_history(spark: SparkSession, root: str) -> DataFrame:
    """Passed and failed rows per rule after each update, for the tables that the update changed."""
    at = f"{root.rstrip('/')}/history"
    if not files.exists(spark, at):
        return spark.createDataFrame([], _HISTORY)
    return spark.read.schema(_HISTORY).json(at)

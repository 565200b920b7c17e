"""Landing files to raw tables, each file once, with a ledger of the files read."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lapwright.schemas import TABLES
from lapwright.sources import files, raw_schema
from lapwright.sources.landing import LANDED_BATCH, endpoint_folder
from lapwright.sources.tables import empty

INGESTED_AT, SOURCE_FILE = "_ingestion_timestamp", "_source_file"
# The source passes over files older than this against the newest one: a hundred years.
FILE_AGE = "36500d"
RECORD, BATCH = "record", "_batch"
_RAW = (
    f"{RECORD} variant, {raw_schema.RESCUED} string, {INGESTED_AT} timestamp, {SOURCE_FILE} string, "
    f"_source_bytes long, _source_time timestamp, {BATCH} long"
)
_LEDGER = f"{SOURCE_FILE} string, bytes long, modified timestamp, records long, malformed long, {BATCH} long"
# A folder of a raw table or of its ledger: one batch, or the batches from one to another brought together.
_FOLDER = re.compile(r"batch=(\d+)$|span=(\d+)-(\d+)$")


class Bronze(Mapping):
    """Raw tables fed by one file stream per endpoint.

    Every batch of a stream makes a folder of records, each one VARIANT value, and a folder of the ledger with the files of
    the batch. A batch that is run again after a failure replaces its folders. Columns are taken out of the records
    when a table is read, by the schema found so far. ``generation`` names checkpoint and table folders. Starting a new
    generation forgets which files were read, and so reads all of them again. A backlog is read in batches of about
    ``batch_bytes``, each committed on its own.
    """

    def __init__(
        self,
        spark: SparkSession,
        landing: str,
        root: str,
        generation: int | None = None,
        batch_bytes: int = 1 << 40,
    ):
        self.spark = spark
        self.batch_bytes = batch_bytes
        self.landing = landing.rstrip("/")
        self.root = root.rstrip("/")
        if generation is None:
            names = files.child_names(spark, self.root)
            generation = max((int(n[2:]) for n in names if n.startswith("g=")), default=1)
        self.generation = generation
        self._home = f"{self.root}/g={generation}"
        self._schemas = raw_schema.SchemaStore(spark, f"{self._home}/_schemas")

    def restarted(self) -> Bronze:
        """An empty next generation over the same landing zone."""
        return Bronze(self.spark, self.landing, self.root, self.generation + 1, self.batch_bytes)

    def stream(self, endpoint: str) -> DataFrame:
        """Unbounded frame of an endpoint's records with file and time of ingestion; the text of what is no record."""
        lines = (
            raw_schema.json_files(self.spark.readStream.format("text"))
            .option("maxBytesPerTrigger", self.batch_bytes)
            .option("maxFileAge", FILE_AGE)
            .load(endpoint_folder(self.landing, endpoint))
        )
        record = F.when(F.ltrim("value").startswith("{"), F.try_parse_json("value"))
        file = {SOURCE_FILE: "file_path", "_source_bytes": "file_size", "_source_time": "file_modification_time"}
        read = lines.where(F.trim("value") != "").select(
            record.alias(RECORD), "value", F.current_timestamp().alias(INGESTED_AT),
            *[F.col(f"_metadata.{part}").alias(name) for name, part in file.items()],
        )
        return read.withColumn(raw_schema.RESCUED, F.when(F.col(RECORD).isNull(), F.col("value"))).drop("value")

    def start(self, endpoint: str, added: list[int] | None = None) -> StreamingQuery:
        """Read what has landed since the last run, then stop; ``added`` receives the rows of each batch."""

        def store(batch: DataFrame, number: int) -> None:
            seen = Observation(f"bronze_{endpoint}_{self.generation}_{number}")
            rows = batch.withColumn(BATCH, F.lit(number).cast("long"))
            rows = rows.observe(seen, F.schema_of_variant_agg(RECORD).alias("shape"), F.count(F.lit(1)).alias("rows"))
            rows.write.mode("overwrite").parquet(f"{self._home}/{endpoint}/batch={number}")
            found = _observed(seen)
            self._log(endpoint, number)
            spec = TABLES.get(endpoint)
            self._schemas.save(
                endpoint,
                raw_schema.merge(
                    self._schemas.load(endpoint) or StructType(), raw_schema.found_in(found.get("shape")),
                    spec.hint_schema if spec else StructType(), spec.schema if spec else None,
                ),
            )
            if added is not None:
                added.append(found.get("rows", 0))

        return (
            self.stream(endpoint).writeStream.foreachBatch(store)
            .option("checkpointLocation", f"{self._home}/_checkpoints/{endpoint}")
            .trigger(availableNow=True)
            .queryName(f"bronze_{endpoint}_{self.generation}")
            .start()
        )

    def _log(self, endpoint: str, number: int) -> None:
        """Write the files of a batch into the ledger. Reads four small columns of the batch."""
        rows = self.spark.read.schema(_RAW).parquet(f"{self._home}/{endpoint}/batch={number}")
        by_file = rows.groupBy(SOURCE_FILE).agg(
            F.max("_source_bytes").alias("bytes"), F.max("_source_time").alias("modified"),
            (F.count(F.lit(1)) - F.count(raw_schema.RESCUED)).alias("records"), F.count(raw_schema.RESCUED).alias("malformed"),
            F.max(BATCH).alias(BATCH),
        )
        by_file.write.mode("overwrite").parquet(f"{self._ledger_of(endpoint)}/batch={number}")

    def _log_blank(self, endpoint: str, before: dt.datetime) -> None:
        """Add the files without any line: those that were there when a finished run began and that no batch has brought."""
        blank = self.unread(endpoint).where(F.col("modified") < F.lit(before)).select(
            SOURCE_FILE, "bytes", "modified", F.lit(0).cast("long").alias("records"), F.lit(0).cast("long").alias("malformed"),
            F.lit(None).cast("long").alias(BATCH),
        )
        if not blank.isEmpty():
            blank.write.parquet(f"{self._ledger_of(endpoint)}/blank={int(before.timestamp() * 1000)}")

    def ingest(self, endpoints: Iterable[str], failed: dict[str, Exception] | None = None) -> dict[str, int]:
        """Run the streams of several endpoints side by side; rows added by endpoint.

        Endpoints without landed files are left out. If a stream fails, the others
        still finish, and the failed one goes on from its checkpoint next time. Its error is
        put into ``failed`` where that is given, and raised otherwise.
        """
        landed = [e for e in endpoints if self.landed(e)]
        with ThreadPoolExecutor(max_workers=8) as pool:
            waiting = {e: pool.submit(self._run, e) for e in landed}
        counts = {}
        for endpoint, added in waiting.items():
            error = added.exception()
            if error is None:
                counts[endpoint] = added.result()
            elif failed is None:
                raise error
            else:
                failed[endpoint] = error
        return counts

    def landed(self, endpoint: str) -> bool:
        """Whether an endpoint has landed files."""
        return files.has_visible_files(self.spark, endpoint_folder(self.landing, endpoint))

    def _run(self, endpoint: str) -> int:
        # A file's time may be that of its copy's origin; what lands during the run is the next run's.
        began, added = dt.datetime.now(dt.timezone.utc) - dt.timedelta(seconds=2), []
        query = self.start(endpoint, added)
        query.awaitTermination()
        self._log_blank(endpoint, began)
        return sum(added)

    def listing(self, endpoint: str) -> DataFrame:
        """Landed files that hold anything: ``_source_file``, ``bytes`` and ``modified``."""
        found = raw_schema.json_files(self.spark.read.format("binaryFile")).load(endpoint_folder(self.landing, endpoint))
        return found.where("length > 0").select(
            F.col("_metadata.file_path").alias(SOURCE_FILE), F.col("length").alias("bytes"), F.col("modificationTime").alias("modified")
        )

    def files(self, endpoint: str) -> DataFrame:
        """The ledger: every file that was read, its size and time, its records and lines that were none, its batch."""
        folders = [f"{self._ledger_of(endpoint)}/{n}" for n in _complete(self.spark, self._ledger_of(endpoint))]
        if not folders:
            return empty(self.spark, _LEDGER)
        return self.spark.read.schema(_LEDGER).parquet(*folders)

    def unread(self, endpoint: str) -> DataFrame:
        """Landed files that are not in the ledger: ``_source_file``, ``bytes`` and ``modified``."""
        return self.listing(endpoint).join(self.files(endpoint).select(SOURCE_FILE), SOURCE_FILE, "left_anti")

    def _ledger_of(self, endpoint: str) -> str:
        return f"{self._home}/_ledger/{endpoint}"

    def last_batch(self, endpoint: str) -> int:
        """Number of the newest complete batch; -1 if there is none."""
        return max((b for _, _, b in self._folders(endpoint)), default=-1)

    def _folders(self, endpoint: str) -> list[tuple[str, int, int]]:
        """Complete folders that make up the table, with their first and last batch, in order.

        Where batches have been brought together, the wider folder stands for those in it.
        """
        spans = []
        for name in _complete(self.spark, f"{self._home}/{endpoint}"):
            one, first, last = _FOLDER.match(name).groups()
            spans.append((int(one or first or 0), -int(one or last or 0), name))
        chosen: list[tuple[str, int, int]] = []
        for first, minus_last, name in sorted(spans):
            if not chosen or first > chosen[-1][2]:
                chosen.append((name, first, -minus_last))
        return chosen

    def compact(self, endpoint: str, target_bytes: int = 128 << 20) -> int:
        """Bring neighbouring small batches together into folders of about ``target_bytes``; files that are left.

        A folder counts once it is complete, so readers see the batches before or after, never both, and the stream
        goes on with new batches. Folders that an earlier call has replaced are deleted, so that those who still read
        what this call replaces can finish.
        """
        home, now = f"{self._home}/{endpoint}", self._folders(endpoint)
        for name in _complete(self.spark, home):
            if name not in {n for n, _, _ in now}:
                files.delete(self.spark, f"{home}/{name}")
        packs: list[list[tuple[str, int, int]]] = []
        size = target_bytes
        for folder in now:
            bytes_ = files.usage(self.spark, f"{home}/{folder[0]}")[0]
            if size + bytes_ > target_bytes:
                packs.append([])
                size = 0
            packs[-1].append(folder)
            size += bytes_
        for pack in packs:
            if len(pack) > 1:
                rows = self.spark.read.schema(_RAW).parquet(*[f"{home}/{n}" for n, _, _ in pack])
                rows.hint("rebalance").write.mode("overwrite").parquet(f"{home}/span={pack[0][1]}-{pack[-1][2]}")
        return sum(
            sum(n.startswith("part-") for n in files.child_names(self.spark, f"{home}/{name}")) for name, _, _ in self._folders(endpoint)
        )

    def prune(self) -> None:
        """Delete generations older than the one before this."""
        for name in files.child_names(self.spark, self.root):
            if name.startswith("g=") and int(name[2:]) < self.generation - 1:
                files.delete(self.spark, f"{self.root}/{name}")

    def since(self, endpoint: str, batch: int, broken: bool | None = None) -> DataFrame:
        """The raw table without the batches up to one; of it only the records, or with ``broken`` only the lines that were none.

        Such a line is known by what is stored, so that no column is taken out of a record to tell.
        """
        schema, folders = self._schemas.load(endpoint), self._folders(endpoint)
        if schema is None or not folders:
            raise KeyError(endpoint)
        wanted = [f"{self._home}/{endpoint}/{name}" for name, _, last in folders if last > batch]
        rows = self.spark.read.schema(_RAW).parquet(*wanted) if wanted else empty(self.spark, _RAW)
        if batch >= 0:
            rows = rows.where(F.col(BATCH) > batch)
        if broken is not None:
            text = F.col(raw_schema.RESCUED)
            rows = rows.where(text.isNotNull() if broken else text.isNull())
        return rows.select(*raw_schema.read_as(F.col(RECORD), schema), INGESTED_AT, SOURCE_FILE)

    def arrived(self, endpoint: str, batch: int = -1) -> DataFrame:
        """`arrived` of the raw table without the batches up to one."""
        return _landed(self.since(endpoint, batch, broken=False))

    def malformed(self, endpoint: str) -> DataFrame:
        """`malformed` of the raw table."""
        return _unread(self.since(endpoint, -1, broken=True))

    def __getitem__(self, endpoint: str) -> DataFrame:
        return self.since(endpoint, -1)

    def __iter__(self) -> Iterator[str]:
        names = files.child_names(self.spark, self._home)
        return iter(sorted(n for n in names if not n.startswith(("_", ".")) and self._folders(n)))

    def __len__(self) -> int:
        return sum(1 for _ in self)

    def __contains__(self, endpoint: object) -> bool:
        return isinstance(endpoint, str) and bool(self._folders(endpoint))


def _complete(spark: SparkSession, folder: str) -> list[str]:
    """Names of the folders of batches, or of blank files, that Spark finished writing."""
    names = [n for n in files.child_names(spark, folder) if _FOLDER.match(n) or n.startswith("blank=")]
    return [n for n in names if files.exists(spark, f"{folder}/{n}/_SUCCESS")]


def _observed(seen: Observation) -> dict:
    try:
        return dict(seen.get)
    except Py4JJavaError:  # Spark drops the node that counts from the plan of an empty batch
        return {}


def arrived(bronze_table: DataFrame) -> DataFrame:
    """The landed columns with the rescued text. A line that is no record at all is left out; see `malformed`."""
    return _landed(bronze_table.where(~_broken()))


def malformed(bronze_table: DataFrame) -> DataFrame:
    """Lines of which nothing could be read: their text, file and time."""
    return _unread(bronze_table.where(_broken()))


def _landed(rows: DataFrame) -> DataFrame:
    return rows.drop(INGESTED_AT, SOURCE_FILE, LANDED_BATCH)


def _unread(rows: DataFrame) -> DataFrame:
    return rows.select(raw_schema.RESCUED, SOURCE_FILE, INGESTED_AT)


def _broken() -> Column:
    text = F.col(raw_schema.RESCUED)
    return text.isNotNull() & (~F.ltrim(text).startswith("{") | F.try_parse_json(text).isNull())


def records(bronze_table: DataFrame) -> DataFrame:
    """The landed columns alone, without those added on the way in."""
    return bronze_table.drop(INGESTED_AT, SOURCE_FILE, LANDED_BATCH, raw_schema.RESCUED)


def ingested_files(bronze: Bronze, endpoint: str) -> DataFrame:
    """Files that have been read into a table."""
    return bronze.files(endpoint).select(SOURCE_FILE).distinct()


def ledger(bronze: Bronze, endpoints: Iterable[str]) -> DataFrame:
    """Records, lines that are none, and files per endpoint, from the ledgers alone."""
    none = F.lit(0).cast("long")
    lines = [
        bronze.files(e).agg(
            F.coalesce(F.sum("records"), none).alias("records"), F.coalesce(F.sum("malformed"), none).alias("malformed"),
            F.countDistinct(SOURCE_FILE).alias("files"),
        ).select(F.lit(e).alias("endpoint"), "records", "malformed", "files")
        for e in endpoints
    ]
    return reduce(DataFrame.unionByName, lines)

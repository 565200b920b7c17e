"""Operator 9: a deterministic, sharded WARC writer and a reader that verifies what it reads.

Writing: rows are dealt to shards by ranges of their id, large ids and null ones by ranges of the digest, too. The ranges come from exact counts per id interval, so they, the
files and every byte in them depend on the rows alone, not on partitions or timing. A task sorts one shard, rolls to a new
file when the compressed size is reached, and writes each file under a temporary name before renaming it. The manifest,
one row per file, is written by Spark once all files are in place; the reader opens only files that it lists. A task
that is repeated after a loss writes the same bytes to the same name.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain
from urllib.parse import quote, unquote

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import scratch, slices, table

DATE = "2000-01-01T00:00:00Z"  # capture time of all records; the table has none
SHARD_BYTES = 64 << 20  # payload bytes of one shard, about
FILE_BYTES = 16 << 20  # compressed bytes at which a file is closed
INTERVALS = 4096

RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
FILES = "shard int, file string, records long, bytes long, sha256 string"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def originals(rows: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, digest and first_id of the payloads that have an equal one with a smaller id: `first_id`, the smallest.

    Rows have page_id, digest (SHA-256 of the payload) and size. Payloads below `least_bytes` never refer to another.
    """
    slim = rows.filter(F.col("size") >= least_bytes).select("page_id", "digest")
    first = slim.groupBy(F.col("digest").alias("d")).agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
    met = slim.join(first.filter("n > 1"), F.col("digest") == F.col("d"))
    return met.filter("not (page_id <=> first_id) and first_id is not null").select("page_id", "digest", "first_id").distinct()


def id_ranges(sizes: DataFrame, shard_bytes: int) -> tuple[list[int], dict[int, int], int]:
    """Smallest ids of the ranges but the first, the parts of ids that are too large for a shard, and those of null ids.

    Intervals of ids with their bytes are split further where one is too large; an id that is too large by itself is
    a range of its own. `sizes` has page_id and size. At most INTERVALS sums at a time come to the driver.
    """
    without = F.coalesce(F.sum(F.when(F.col("page_id").isNull(), F.col("size"))), F.lit(0))
    low, high, null_bytes = sizes.agg(F.min("page_id"), F.max("page_id"), without).first()
    starts: list[int] = []
    parts: dict[int, int] = {}
    null_parts = max(1, -(-null_bytes // shard_bytes))
    if low is None:
        return starts, parts, null_parts

    def divide(low: int, high: int, filled: int) -> int:
        width = max(1, -(-(high - low + 1) // INTERVALS))
        inside = sizes.filter(F.col("page_id").between(low, high))
        at = F.expr(f"cast((cast(page_id as decimal(20,0)) - {low}) div {width} as bigint)")
        for i, size in sorted(map(tuple, inside.groupBy(at.alias("i")).agg(F.sum("size")).collect())):
            begin = low + i * width
            if size > shard_bytes and width > 1:
                filled = divide(begin, min(high, begin + width - 1), filled)
                continue
            if filled and filled + size > shard_bytes:
                starts.append(begin)
                filled = 0
            if size > shard_bytes:
                parts[begin] = -(-size // shard_bytes)
            filled += size
        return filled

    divide(low, high, 0)
    return starts, parts, null_parts


def with_shards(rows: DataFrame, sizes: DataFrame, shard_bytes: int) -> tuple[DataFrame, int]:
    """Add `shard` to rows with page_id and digest, and tell how many shards there are.

    A shard is a range of ids, or a range of digests of one id, or of null ids, that is too large for a shard.
    """
    starts, parts, null_parts = id_ranges(sizes, shard_bytes)
    edges = np.array(starts, dtype=np.int64)  # twenty bytes per range
    many = np.ones(len(edges) + 1, dtype=np.int32)
    for page_id, n in parts.items():
        many[np.searchsorted(edges, page_id, side="right")] = n
    first = np.concatenate([[0], np.cumsum(many, dtype=np.int64)])
    of_null = int(first[-1])

    @F.pandas_udf("int")
    def shard(ids: pd.Series, points: pd.Series) -> pd.Series:
        at = np.searchsorted(edges, ids.to_numpy(), side="right")
        return pd.Series(first[at] + (points.to_numpy() * many[at] >> 32))

    point = F.conv(F.substring("digest", 1, 8), 16, 10).cast("long")  # of 2^32
    nulls = F.lit(of_null) + F.shiftright(point * null_parts, 32).cast("int")
    known = shard(F.coalesce("page_id", F.lit(0)), point)
    return rows.withColumn("shard", F.when(F.col("page_id").isNull(), nulls).otherwise(known)), of_null + null_parts


def _header(fields: list[tuple[str, object]]) -> bytes:
    return "".join(f"{k}: {v}\r\n" for k, v in fields).encode("utf-8")


def record(page_id: int | None, url: str | None, payload: bytes, first_id: int | None) -> bytes:
    """One WARC 1.1 record. A revisit keeps the length and digest of its payload and names the page that has it."""
    revisit, digest = first_id is not None, base32_sha1(payload)
    http = b"HTTP/1.1 200 OK\r\n" + _header(
        [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", len(payload))]
    ) + b"\r\n"
    block = http if revisit else http + payload
    name = "" if page_id is None else page_id
    fields: list[tuple[str, object]] = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name} {url} {digest}')}>"),
        ("WARC-Date", DATE),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
    ]
    if page_id is not None:
        fields.append(("Page-Id", page_id))
    if url is not None:  # quoted, as a line break would end the header; the reader takes the quotes off
        fields.append(("WARC-Target-URI", quote(url, safe=":/?#[]@!$&'()*+,;=~")))
    if revisit:
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("Refers-To-Page-Id", first_id),
        ]
    fields.append(("Content-Length", len(block)))
    return b"WARC/1.1\r\n" + _header(fields) + b"\r\n" + block + b"\r\n\r\n"


class _Files:
    """Writes the files of one shard."""

    def __init__(self, root: str, shard: int, roll_bytes: int):
        self.store, self.path = pa.fs.FileSystem.from_uri(root)
        self.shard, self.roll, self.number, self.done = shard, roll_bytes, 0, []
        self.out = None

    def add(self, data: bytes) -> None:
        if self.out is None:
            self.name = f"records-{self.shard:06d}-{self.number:06d}.warc.gz"
            self.temporary = f"{self.path}/_{self.name}.{uuid.uuid4().hex}"
            self.out = self.store.open_output_stream(self.temporary)
            self.records, self.bytes, self.sha = 0, 0, hashlib.sha256()
        member = gzip.compress(data, 6, mtime=0)
        self.out.write(member)
        self.sha.update(member)
        self.records, self.bytes = self.records + 1, self.bytes + len(member)
        if self.bytes >= self.roll:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.store.move(self.temporary, f"{self.path}/{self.name}")
            self.done.append((self.shard, self.name, self.records, self.bytes, self.sha.hexdigest()))
            self.out, self.number = None, self.number + 1


def write(
    pages: DataFrame, root: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    least_bytes: int = 0, shard_bytes: int = SHARD_BYTES, roll_bytes: int = FILE_BYTES,
) -> None:
    """Write the archives and the manifest of a table below `root`, a new folder (URI) that all executors reach.

    A null html is an empty payload. Rows with a null id come last and can be originals only among themselves; a row
    whose id equals that of its original is a response too, so repeated rows are all written. An empty table gives an
    empty manifest. Columns other than the three named are not read. Rows of one id, or without id, that are too many for
    a shard are divided by their digest; only copies of one payload under one id stay together. A very long payload is
    written whole, to a shard of its own.
    """
    spark = pages.sparkSession
    root = root if "://" in root or root.startswith("file:") else f"file://{root}"
    store, path = pa.fs.FileSystem.from_uri(root)
    store.create_dir(path, recursive=True)
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
        F.coalesce(F.col(html_col), F.lit("")).alias("html"),
    )
    rows = rows.withColumn("digest", F.sha2(F.col("html").cast("binary"), 256))
    # What a payload repeats travels as a row of its own and is sorted to the front of its page, so that pages are
    # shuffled once, to their shards.
    refers = originals(rows.withColumn("size", F.octet_length("html")), least_bytes)
    both = rows.select("page_id", "url", "html", "digest", F.lit(None).cast("long").alias("first_id")).unionByName(
        refers.select("page_id", F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("html"), "digest", "first_id")
    )
    placed, shards = with_shards(both, rows.select("page_id", F.octet_length("html").alias("size")), shard_bytes)
    dealt = placed.repartitionById(shards, F.col("shard")).sortWithinPartitions(
        "shard", "page_id", "digest", F.col("first_id").asc_nulls_last(), "url"
    )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, done, known = None, [], None
        for batch in chain.from_iterable(map(slices, batches)):
            for page_id, url, html, digest, first, number in zip(*(c.to_pylist() for c in batch.columns)):
                if html is None:
                    known = page_id, digest, first
                    continue
                if files is None or files.shard != number:
                    if files:
                        files.close()
                        done += files.done
                    files = _Files(root, number, roll_bytes)
                original = known[2] if known and known[:2] == (page_id, digest) else None
                files.add(record(page_id, url, html.encode("utf-8"), original))
        if files:
            files.close()
            done += files.done
        if done:
            yield pa.RecordBatch.from_pandas(pd.DataFrame(done, columns=["shard", "file", "records", "bytes", "sha256"]).astype({"shard": "int32"}), preserve_index=False)

    # Repartitioned, not coalesced, which would make one task write all files.
    dealt.mapInArrow(task, FILES).repartition(1).write.mode("overwrite").json(f"{root}/manifest")


def records_of(data: bytes) -> Iterator[tuple]:
    """Rows of `RECORDS` in one file's bytes; digests are computed again and must agree with the headers."""
    at = 0
    while at < len(data):
        member, parts = zlib.decompressobj(wbits=31), []
        while not member.eof:
            chunk = data[at : at + 65_536]
            parts.append(member.decompress(chunk))
            at += len(chunk) - len(member.unused_data)
        text = b"".join(parts)
        head, _, rest = text.partition(b"\r\n\r\n")
        fields = dict(line.split(": ", 1) for line in head.decode("utf-8").split("\r\n")[1:])
        block = rest[: int(fields["Content-Length"])]
        http, _, payload = block.partition(b"\r\n\r\n")
        length = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        revisit = fields["WARC-Type"] == "revisit"
        if fields["WARC-Block-Digest"] != f"sha1:{base32_sha1(block)}" or not revisit and (
            len(payload) != length or base32_sha1(payload) != digest
        ):
            raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
        page, url, first = map(fields.get, ("Page-Id", "WARC-Target-URI", "Refers-To-Page-Id"))
        yield (
            None if page is None else int(page), None if url is None else unquote(url), length, digest, fields["WARC-Type"],
            None if first is None else int(first), None if revisit else payload,
        )


def read(spark: SparkSession, root: str, payload: bool = True) -> DataFrame:
    """One row per record of the files in the manifest. Without `payload`, it is checked but not returned."""
    root = root if "://" in root or root.startswith("file:") else f"file://{root}"
    names = spark.read.schema(FILES).json(f"{root}/manifest").select(F.col("file").alias("name"), "sha256")
    found = spark.read.format("binaryFile").option("pathGlobFilter", "records-*.warc.gz").load(root)
    files = found.withColumn("name", F.element_at(F.split("path", "/"), -1)).join(names, "name").select("name", "content", "sha256")
    schema = RECORDS if payload else RECORDS.rpartition(",")[0]
    width = 7 if payload else 6

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()][:width]
        heads = [c.split()[0] for c in schema.split(", ")]
        for batch in batches:
            for name, content, sha in zip(*(c.to_pylist() for c in batch.columns)):
                if hashlib.sha256(content).hexdigest() != sha:
                    raise ValueError(f"{name} differs from the manifest")
                rows: list[tuple] = []
                for row in records_of(content):
                    rows.append(row[:width])
                    if len(rows) == 1000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], heads)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], heads)

    return files.mapInArrow(task, schema)


def archive(spark: SparkSession, folder: str) -> DataFrame:
    """The registered query: write all pages, read the archives back."""
    root = scratch(spark)
    write(table(spark, folder, "pages"), root)
    return read(spark, root, payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")

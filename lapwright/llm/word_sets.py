"""Near copies by shared word runs: links between texts whose sets of five-word runs have a Jaccard similarity of 0.8.

Fingerprints a few bits apart find copies that are nearly equal; texts that share four fifths of their word runs are much
further apart than any covering family of masks can reach. Their candidates come from bands of minimum hashes instead: two
texts with similarity s agree in a band of ROWS minima with probability s ** ROWS, so that at 0.8 all BANDS bands miss
a pair once in about 300 times. Every candidate is checked on the sets themselves.

Texts with the same words are one node. In a bucket no two members are paired with each other but each with a
pivot: first every node with the smallest pivot of its buckets, which joins large groups; then, where a bucket still holds
several groups, its members with a few pivots of other groups. What is then left in several groups of a bucket is compared
member by member, so that no pair of a bucket is passed over; members are dealt over slots, and a slot's pairs are told by their minima as
they are made. Parities of the runs, which never tell a similar pair apart, and the minima tell most pairs that are far apart, so that
of a large group whose members are nearly but not quite similar few pairs leave a join; only texts of those are read once more for their sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import accumulate, chain
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, sent, shuffled, slices, stored
from .components import components

RUN, SIMILARITY = 5, 0.8
ROWS, BANDS = 5, 14
BLOCK = 1 << 16  # hashes whose minima are taken at a time; a very long text takes several blocks
TOLD = ("minima", "parities", "size")  # what tells nodes apart without their sets
# Odd factors of the hash functions: multiples of the golden ratio's fraction, in 64 bits.
FACTORS = (np.arange(1, ROWS * BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
FLIPS = (0x5555555555555555, 0x0F0F0F0F0F0F0F0F)
SLOT = 512  # members of a large bucket that are compared in one join
PARITY = 2048  # bits of a set's parities, which tell sets of up to some 3,500 runs; larger ones are told by their minima alone
BITS = 26  # of the largest filter of nodes: 8 MB


def run_hashes(text: str) -> tuple[int, np.ndarray]:
    """Hash of the words of a text, lower-cased A to Z, and the distinct hashes of its runs; a shorter text is one run."""
    words = text.encode("utf-8").lower().split()
    joined = b" ".join(words)
    node = xxhash.xxh64_intdigest(joined)
    if not words:
        return node, np.zeros(0, np.uint64)
    ends = list(accumulate(map(len, words), lambda a, n: a + n + 1))
    starts = [0, *(e + 1 for e in ends[:-1])]
    ends = ends[RUN - 1 :] or ends[-1:]
    digest = xxhash.xxh64_intdigest
    return node, np.unique(np.fromiter((digest(joined[a:b]) for a, b in zip(starts, ends)), np.uint64, len(ends)))


def minima(hashes: np.ndarray) -> np.ndarray:
    """The least value of every hash function."""
    least = np.full(len(FACTORS), np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(hashes), BLOCK):
        block = hashes[k : k + BLOCK]
        for i, factor in enumerate(FACTORS):
            mixed = block * factor
            mixed ^= mixed >> np.uint64(32)
            least[i] = min(least[i], (mixed * factor).min())
    return least


def run_set(hashes: np.ndarray) -> np.ndarray:
    """The runs as numbers of 32 bits, sorted and distinct."""
    return np.unique((hashes >> np.uint64(32)).astype(np.uint32))


def parities(runs: np.ndarray) -> np.ndarray:
    """Whether the number of runs with the same lowest bits is odd, as bits of longs.

    Every run that only one of two sets has changes one bit, so that the parities of two sets never differ in more bits than
    there are such runs.
    """
    odd = np.bincount(runs & np.uint32(PARITY - 1), minlength=PARITY) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.uint64)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.asarray(x, np.uint64).view(np.int64))


def signatures(rows: DataFrame, text_col: str = "text") -> DataFrame:
    """Add to every row node, bands (equal where all minima of a band are), minima, cut to 32 bits, parities and size of the set.

    A text without words has neither bands nor minima nor parities.
    """
    names = rows.columns

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chain.from_iterable(map(slices, batches)):
            found = [run_hashes(t or "") for t in batch.column(text_col).to_pylist()]
            least = [minima(h) if len(h) else h for _, h in found]
            keys = [np.array([xxhash.xxh64_intdigest(b.tobytes()) for b in m.reshape(-1, ROWS)], np.uint64) for m in least]
            runs = [run_set(h) for _, h in found]
            odd = [parities(r) if len(r) else h for r, (_, h) in zip(runs, found)]
            lists = [
                pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(x) for x in xs])]).astype(np.int32)), values)
                for xs, values in (
                    (keys, _signed(np.concatenate(keys))),
                    (least, pa.array(np.concatenate(least).astype(np.uint32).view(np.int32))),
                    (odd, _signed(np.concatenate(odd))),
                )
            ]
            nodes = _signed(np.array([n for n, _ in found], np.uint64))
            sizes = pa.array([len(r) for r in runs], pa.int32())
            yield pa.RecordBatch.from_arrays([*map(batch.column, names), nodes, *lists, sizes], [*names, "node", "bands", *TOLD])

    longs, ints = T.ArrayType(T.LongType()), T.ArrayType(T.IntegerType())
    kinds = [T.StructField(n, t) for n, t in zip(("node", "bands", *TOLD), (T.LongType(), longs, ints, longs, T.IntegerType()))]
    return rows.mapInArrow(task, T.StructType([*rows.schema.fields, *kinds]))


def _pair(a: str, b: str) -> list:
    return [F.least(a, b).alias("u"), F.greatest(a, b).alias("v")]


def first_pairs(members: DataFrame, buckets: DataFrame) -> DataFrame:
    """Every node with the smallest node that it shares a bucket with."""
    met = members.join(shuffled(buckets.select("band", "key", "p0")), ["band", "key"]).groupBy("node").agg(F.min("p0").alias("p"))
    return met.filter("node <> p").select(*_pair("node", "p")).distinct()


def grouped(members: DataFrame, roots: DataFrame) -> DataFrame:
    """The members with the root of their group."""
    return members.join(shuffled(roots.withColumnRenamed("node", "of")), F.col("node") == F.col("of"), "left").select(
        "node", "band", "key", F.coalesce("root", "node").alias("root")
    )


def further_pairs(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Nodes with pivots of their buckets that are in other groups."""
    known = grouped(members, roots)
    flips = [F.min(F.struct(F.col("node").bitwiseXOR(F.lit(c)), "node", "root")).alias(f"m{i}") for i, c in enumerate((0, -1, *FLIPS))]
    mixed = known.groupBy("band", "key").agg(F.min("root").alias("low"), F.max("root").alias("high"), *flips).filter("low <> high")
    pivots = F.array_distinct(F.array(*[F.struct(F.col(f"m{i}.node").alias("p"), F.col(f"m{i}.root").alias("r")) for i in range(4)]))
    met = known.join(shuffled(mixed.select("band", "key", pivots.alias("pivots"))), ["band", "key"])
    each = met.select("node", "root", F.explode("pivots").alias("x")).filter("root <> x.r").select("node", F.col("x.p").alias("p"))
    return each.select(*_pair("node", "p")).distinct()


def remaining_pairs(members: DataFrame, roots: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """All likely pairs of a bucket's members in different groups.

    Members outside a bucket's largest group meet all members. Both sides are dealt over slots of about SLOT members, so that a
    large bucket makes many small joins, and only likely pairs leave the join.
    """
    known = grouped(members, roots)
    sizes = known.groupBy("band", "key", "root").agg(F.count("*").alias("n"))
    mixed = sizes.groupBy("band", "key").agg(F.max(F.struct("n", "root")).alias("main"), F.sum("n").alias("n"), F.count("*").alias("groups"))
    mixed = mixed.filter("groups > 1").select(
        "band", "key", F.col("main.root").alias("main"),
        F.ceil((F.col("n") - F.col("main.n")) / SLOT).alias("few"), F.ceil(F.col("n") / SLOT).alias("many"),
    )
    each = known.join(shuffled(mixed), ["band", "key"]).join(shuffled(_told(nodes, "told")), "node")

    def side(rows: DataFrame, own: str, other: str, names: tuple[str, str, str]) -> DataFrame:
        dealt = rows.withColumns({own: F.pmod(F.xxhash64("node"), F.col(own)), other: F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1))})
        return dealt.select("band", "key", "few", "many", *[F.col(c).alias(n) for c, n in zip(("node", "root", "told"), names)])

    a = side(each.filter("root <> main"), "few", "many", ("u", "ru", "a"))
    b = side(each, "many", "few", ("v", "rv", "b"))
    near = a.join(shuffled(b), ["band", "key", "few", "many"]).filter("ru <> rv").filter(_alike(nodes, least))
    return near.select(*_pair("u", "v")).distinct()


def _told(nodes: DataFrame, name: str) -> DataFrame:
    return nodes.select("node", F.struct(*[c for c in TOLD if c in nodes.columns]).alias(name))


def _alike(nodes: DataFrame, least: float) -> Column:
    """Whether what tells the nodes a and b leaves them a similarity of `least`.

    The parities may differ in as many bits as similar sets of these sizes differ in runs, which is no estimate but a bound. The minima agree as
    often as those of texts with that similarity do, five standard deviations allowed. Nodes may come without parities.
    """
    a, b, n = F.col("a"), F.col("b"), ROWS * BANDS
    agree = F.size(F.filter(F.zip_with(a["minima"], b["minima"], lambda x, y: x == y), lambda same: same))
    alike = agree >= n * least - 5 * (n * least * (1 - least)) ** 0.5
    if "parities" not in nodes.columns:
        return alike
    differ = reduce(add, [F.bit_count(a["parities"][i].bitwiseXOR(b["parities"][i])) for i in range(PARITY // 64)])
    # Of a union of n runs (1 - least) * n at most are in one set only, and the sizes add up to (1 + least) * n then; the rest is for rounding.
    return (differ <= (1 - least) / (1 + least) * (a["size"] + b["size"]) + 1e-6) & alike


def likely(pairs: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """The pairs that are not told apart without their sets."""
    a, b = _told(nodes, "a").withColumnRenamed("node", "u"), _told(nodes, "b").withColumnRenamed("node", "v")
    return pairs.join(shuffled(a), "u").join(shuffled(b), "v").filter(_alike(nodes, least)).select("u", "v")


def _bitmap(nodes: DataFrame, count: int) -> np.ndarray:
    """Bits of the nodes' lowest bits: a filter of at least 32 bits a node, up to a fixed size whatever their number.

    It goes through the driver, which a filter of the full size for few nodes would cost most of its spare memory.
    """
    bits = min(BITS, max(16, count.bit_length() + 5))
    bit = F.col("node").bitwiseAND((1 << bits) - 1) + 1  # bitmaps count from 1, 32,768 bits to a bucket
    parts = nodes.groupBy(F.bitmap_bucket_number(bit).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))
    whole = np.zeros((1 << bits) // 8, np.uint8)
    for r in parts.collect():
        whole[(r.bucket - 1) * 4096 : r.bucket * 4096] = np.frombuffer(r.bits, np.uint8)
    return whole


def sets(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """node and the set of its runs, as sorted numbers of 32 bits, for the wanted nodes and few others."""
    count = nodes.count()
    if not count:
        return rows.sparkSession.createDataFrame([], "node long, runs binary")
    wanted = sent(rows.sparkSession, _bitmap(nodes, count))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, done = wanted.value, set()
        lowest = 8 * len(known) - 1
        for batch in chain.from_iterable(map(slices, batches)):
            found = {}
            for text in batch.column("text").to_pylist():
                words = b" ".join((text or "").encode("utf-8").lower().split())
                node = xxhash.xxh64_intdigest(words)
                bit = node & lowest
                if node not in done and known[bit >> 3] >> (bit & 7) & 1:
                    done.add(node)
                    found[node] = run_set(run_hashes(text or "")[1]).tobytes()
            yield pa.RecordBatch.from_arrays([_signed(np.array(list(found), np.uint64)), pa.array(list(found.values()), pa.binary())], ["node", "runs"])

    return rows.select("text").mapInArrow(task, "node long, runs binary").dropDuplicates(["node"])


def similar(pairs: DataFrame, runs: DataFrame, least: float) -> DataFrame:
    """The pairs whose sets have at least that Jaccard similarity."""
    a = runs.select(F.col("node").alias("u"), F.col("runs").alias("a"))
    b = runs.select(F.col("node").alias("v"), F.col("runs").alias("b"))
    # Sizes alone rule out some pairs.
    met = pairs.join(shuffled(a), "u").join(shuffled(b), "v").filter(
        F.least(F.length("a"), F.length("b")) >= F.lit(least) * F.greatest(F.length("a"), F.length("b"))
    )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chain.from_iterable(map(slices, batches)):
            keep = []
            for x, y in zip(batch.column("a"), batch.column("b")):
                x, y = np.frombuffer(x.as_py(), np.uint32), np.frombuffer(y.as_py(), np.uint32)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both >= least * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("v")], ["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return met.mapInArrow(task, "u long, v long")


def links(rows: DataFrame, signed: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """Links u, v between nodes.

    `rows` has a column text, a null one being empty, and `signed` is what `signatures` makes of it. A text without words is linked to no
    other; shorter ones than a run only to texts with the same words, which are the same node. Very long texts are read whole.
    """
    nodes = stored(signed.groupBy("node").agg(*[F.first(c).alias(c) for c in ("bands", *TOLD)]))
    members = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    buckets = members.groupBy("band", "key").agg(F.count("*").alias("n"), F.min("node").alias("p0")).filter("n > 1")
    members = stored(members.join(shuffled(buckets), ["band", "key"]).select("node", "band", "key"))
    buckets = members.groupBy("band", "key").agg(F.min("node").alias("p0"))

    def checked(pairs: DataFrame) -> DataFrame:
        pairs = stored(likely(pairs, nodes, least))
        runs = stored(sets(rows, pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()))
        found = stored(similar(pairs, runs, least))
        discard(pairs, runs)
        return found

    first = checked(first_pairs(members, buckets))
    roots = stored(components(first))
    further = checked(further_pairs(members, roots))
    discard(roots)
    roots = stored(components(first.unionByName(further)))
    rest = checked(remaining_pairs(members, roots, nodes, least))
    discard(nodes, members, roots)
    return first.unionByName(further).unionByName(rest)

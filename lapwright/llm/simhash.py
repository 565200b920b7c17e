"""Operator 3: near-duplicates by SimHash, with a covering family of bit masks that misses no pair within the radius.

Every bit position is given one of the non-zero vectors of r + 1 bits, and every such vector v makes a mask of the
positions whose vector has an odd product with v. Wherever two fingerprints differ in r positions or fewer, some v has
an even product with the vectors of all of them, as r vectors cannot span r + 1 dimensions. Under that mask the two are
equal, so they meet in that table.

Members of a bucket are not paired all with all. First each is held against a few pivots of its bucket, which joins
dense groups of copies; then only buckets that still hold several components are searched, members outside the
bucket's main component against all, and only links between components are emitted.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import word_sets
from .common import identity, on_identity, shuffled, slices, stored, table
from .components import components

BITS, SHINGLE, RADIUS, SEED = 64, 4, 4, 42
FLIPS = (0x5555555555555555, 0x3333333333333333, 0x0F0F0F0F0F0F0F0F)
BLOCK = 100_000  # shingles whose bits are counted at a time; a very long text takes several blocks


def fingerprint(text: str) -> int:
    """SimHash of a whole text."""
    words = text.encode("utf-8").lower().split()  # bytes: only A-Z change, only the six blanks separate
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(map(len, words), lambda a, n: a + n + 1))
    starts = [0, *(e + 1 for e in ends[:-1])]
    ends = ends[SHINGLE - 1 :] or ends[-1:]
    digest, count, n = xxhash.xxh64_intdigest, np.zeros(BITS, dtype=np.int64), len(ends)
    for k in range(0, n, BLOCK):
        hashes = np.array(
            [digest(joined[a:b], SEED) for a, b in zip(starts[k : k + BLOCK], ends[k : k + BLOCK])], dtype="<u8"
        )
        count += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * count > n, bitorder="little").view("<u8")[0])


def fingerprints(rows: DataFrame, text_col: str = "text") -> DataFrame:
    """Replace the text of every row by fp, its fingerprint as a signed long; a null text has no words."""
    others = rows.drop(text_col)
    names = others.columns

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chain.from_iterable(map(slices, batches)):
            found = np.array([fingerprint(t or "") for t in batch.column(text_col).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, names), pa.array(found.view(np.int64))], [*names, "fp"]
            )

    return rows.mapInArrow(task, T.StructType([*others.schema.fields, T.StructField("fp", T.LongType())]))


def covering_masks(radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """One mask per non-zero vector of radius + 1 bits, as signed longs."""
    tables = (1 << (radius + 1)) - 1
    masks = (
        sum(((1 + i % tables) & v).bit_count() % 2 << i for i in range(bits)) for v in range(1, tables + 1)
    )
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links u, v between distinct fingerprints, enough of them for the components of all pairs within the radius."""
    masks = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(m).alias("m")) for i, m in enumerate(covering_masks(radius))])
    members = prints.select("fp").distinct().select("fp", F.explode(masks).alias("x")).select(
        "fp", F.col("x.i").alias("table"), F.col("fp").bitwiseAND(F.col("x.m")).alias("key")
    )
    # Pivots: the smallest and the largest member, and the smallest after flipping some bits; all plain aggregates.
    found = members.groupBy("table", "key").agg(
        F.count("*").alias("n"), F.min("fp").alias("p0"), F.max("fp").alias("p1"),
        *[F.min(F.col("fp").bitwiseXOR(F.lit(c))).alias(f"m{i}") for i, c in enumerate(FLIPS)],
    )
    buckets = found.filter("n > 1").select(
        "table", "key", "p0", "p1", *[F.col(f"m{i}").bitwiseXOR(F.lit(c)).alias(f"f{i}") for i, c in enumerate(FLIPS)]
    )
    crowded = stored(members.join(shuffled(buckets), ["table", "key"]))
    pivots = F.array("p0", "p1", *[f"f{i}" for i in range(len(FLIPS))])
    near = crowded.select("fp", F.explode(F.array_distinct(pivots)).alias("v")).filter(
        (F.col("fp") != F.col("v")) & (distance(F.col("fp"), F.col("v")) <= radius)
    )
    first = stored(near.select(F.least("fp", "v").alias("u"), F.greatest("fp", "v").alias("v")).distinct())

    roots = components(first)
    known = crowded.select("fp", "table", "key", "p0").join(shuffled(roots), F.col("fp") == F.col("node"), "left").select(
        "fp", "table", "key", "p0", F.coalesce("root", "fp").alias("root")
    )
    known = stored(known)
    mixed_buckets = known.groupBy("table", "key").agg(
        F.min("root").alias("low"), F.max("root").alias("high"),
        F.max(F.when(F.col("fp") == F.col("p0"), F.col("root"))).alias("main"),
    ).filter("low <> high").select("table", "key", "main")
    open_ = known.join(shuffled(mixed_buckets), ["table", "key"])
    a = open_.filter("root <> main").select("table", "key", F.col("fp").alias("u"), F.col("root").alias("ru"))
    b = shuffled(open_.select("table", "key", F.col("fp").alias("v"), F.col("root").alias("rv")))
    cross = a.join(
        b,
        (a["table"] == b["table"]) & (a["key"] == b["key"]) & (a["ru"] != b["rv"])
        & (distance(a["u"], b["v"]) <= radius),
    ).select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    return first.unionByName(cross.distinct())


def _placed(prints: DataFrame, radius: int) -> DataFrame:
    """Add `root`, the same number for all rows of a component."""
    roots = stored(components(links(prints, radius)))
    return prints.join(shuffled(roots), F.col("fp") == F.col("node"), "left").withColumn("root", F.coalesce("root", "fp")).drop("node")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """Per row: doc_id, fp and component_id, the smallest id among the rows that links reach.

    Fingerprints within the radius are linked, equal ones included. A null or blank text has fingerprint zero and is
    linked like any other. Repeated ids and rows keep their rows. A null id takes part; component_id is null only where
    no row of the component has an id. Other columns are not read. An empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    placed = _placed(stored(fingerprints(rows)), radius)
    smallest = placed.groupBy(F.col("root").alias("r")).agg(F.min("doc_id").alias("component_id"))
    return placed.join(shuffled(smallest), F.col("root") == F.col("r")).select("doc_id", "fp", "component_id")


def _placed_with_sets(rows: DataFrame, radius: int, similarity: float) -> DataFrame:
    """fp, and `root` of the components of both kinds of links: near fingerprints, and similar sets of word runs."""
    both = stored(fingerprints(word_sets.signatures(rows)))
    # Everything in terms of nodes: a fingerprint is stood for by the smallest of its nodes.
    prints = stored(both.groupBy("fp").agg(F.min("node").alias("first")))
    same = both.select("fp", "node").distinct().join(shuffled(prints), "fp").select(F.col("first").alias("u"), F.col("node").alias("v"))
    a, b = (prints.toDF(f"{x} fp", x) for x in ("u", "v"))
    near = links(prints, radius).toDF("a", "b")
    near = near.join(shuffled(a), F.col("a") == F.col("u fp")).join(shuffled(b), F.col("b") == F.col("v fp")).select("u", "v")
    similar = word_sets.links(rows, both, similarity)
    roots = stored(components(same.unionByName(near).unionByName(similar))).toDF("of", "root")
    placed = both.drop("bands", *word_sets.TOLD).join(shuffled(roots), F.col("node") == F.col("of"), "left")
    return placed.withColumn("root", F.coalesce("root", "node")).drop("of", "node")


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, similarity: float | None = None
) -> DataFrame:
    """One row of every component, with all its columns: that with the smallest id, null ids last.

    With `similarity`, texts whose sets of five-word runs have that Jaccard similarity are linked, too. Among rows with that id the text hashes decide; rows equal in id and text are one document, of which any row stays.
    """
    rows = docs.select(*identity(id_col, text_col), F.col(text_col).alias("text"))
    placed = _placed(stored(fingerprints(rows)), radius) if similarity is None else _placed_with_sets(rows, radius, similarity)
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id").alias("doc_id"), F.col("h1").alias("h1"), F.col("h2").alias("h2"))
    chosen = placed.groupBy("root").agg(F.min(order).alias("k"))
    copies = placed.groupBy("doc_id", "h1", "h2").agg(F.count("*").alias("n"))
    chosen = on_identity(chosen.select("k.doc_id", "k.h1", "k.h2"), shuffled(copies), "inner")

    names, mine = docs.columns, [f"kept {c}" for c in ("doc_id", "h1", "h2", "n")]
    keys = [c.alias(n) for c, n in zip(identity(id_col, text_col), mine)]
    met = docs.select("*", *keys).join(
        shuffled(chosen.toDF("doc_id 2", "h1 2", "h2 2", mine[3])),
        F.col(f"`{mine[0]}`").eqNullSafe(F.col("`doc_id 2`"))
        & (F.col(f"`{mine[1]}`") == F.col("`h1 2`")) & (F.col(f"`{mine[2]}`") == F.col("`h2 2`")),
    )
    single, several = met.filter(F.col(f"`{mine[3]}`") == 1), met.filter(F.col(f"`{mine[3]}`") > 1)
    whole = single.unionByName(several.dropDuplicates(mine[:3]))
    return whole.select(*[F.col(f"`{c}`") for c in names])


def groups(spark: SparkSession, folder: str) -> DataFrame:
    """The registered query: fingerprint and component of every document."""
    done = near_duplicates(table(spark, folder, "documents"))
    return done.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")

"""Operator 11: hard negatives by a secondary-sort shuffle.

Anchors are the stated query set. They are taken in blocks of bounded size; a block is sent to all tasks, and every task
scores its rows against it. Pairs are packed into keys (anchor, descending score, id), dealt out by anchor and sorted on
the way (`repartitionAndSortWithinPartitions`), so that one iterator sees the pairs of an anchor best first. A positive
opens a window of scores, a negative is emitted for every open window that it falls in, and nothing of an anchor is held
but its few open windows.

Not every pair is shuffled. A task passes on what can be among the first of an anchor or of one of its windows within the
task's own rows. What is first over all rows is first within its task, so nothing is lost.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import scratch, sent, slices, table
from .vectors import matrix, products, quantised

POSITIVES, NEGATIVES = 5, 10
LOW, HIGH, UNIT = 30, 90, 100  # LOW * positive <= UNIT * negative <= HIGH * positive
BLOCK = 4096  # anchors that are scored together, about; fewer where vectors are wide
BLOCK_NUMBERS = 1 << 20
ROWS, COLUMNS = 4096, 512  # size of a tile of scores

PAIR = "anchor int, score long, id long"
MINED = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


@dataclass
class Anchors:
    """A block of anchors: their ids, labels and vectors, and for each the windows of scores that are wanted."""

    ids: list[int | None]
    labels: np.ndarray
    vectors: np.ndarray
    windows: list[list[tuple[int, int]]]


def _first(scores: np.ndarray, ids: np.ndarray, no_id: np.ndarray, n: int) -> np.ndarray:
    """Places of the first n by descending score, then id, null ids last."""
    if len(scores) > 4 * n:
        near = np.flatnonzero(scores >= np.partition(scores, len(scores) - n)[len(scores) - n])
        return near[_first(scores[near], ids[near], no_id[near], n)] if len(near) < len(scores) else _sorted(scores, ids, no_id, n)
    return _sorted(scores, ids, no_id, n)


def _sorted(scores: np.ndarray, ids: np.ndarray, no_id: np.ndarray, n: int) -> np.ndarray:
    return np.lexsort((ids, no_id, -scores))[:n]


def scored(rows: DataFrame, block, same: bool, n: int) -> DataFrame:
    """Pairs of anchors and rows of the same or of another label: per task, the first n of every window.

    `rows` has id, label and q; `block` is a broadcast of `Anchors`.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, seen = block.value, 0
        best: dict[tuple[int, int], tuple[np.ndarray, ...]] = {}
        for batch in batches:
            for part in slices(batch, ROWS):
                ids = part.column("id")
                no_id = np.asarray(ids.is_null())
                ids = np.asarray(ids.fill_null(0), dtype=np.int64)
                labels = np.asarray(part.column("label"), dtype=np.int64)
                number = seen + np.arange(len(ids))
                seen += len(ids)
                q = matrix(part.column("q"), anchors.vectors.shape[1])
                for at in range(0, len(anchors.labels), COLUMNS):
                    tile = products(anchors.vectors[at : at + COLUMNS], q)
                    for a, line in enumerate(tile, at):
                        fits = (labels == anchors.labels[a]) == same
                        for w, (low, high) in enumerate(anchors.windows[a]):
                            known = best.get((a, w))
                            least = max(low, int(known[0][-1])) if known and len(known[0]) == n else low
                            found = np.flatnonzero(fits & (line >= least) & (line <= high))
                            if len(found):
                                new = (line[found], ids[found], no_id[found], number[found])
                                if known:
                                    new = tuple(map(np.concatenate, zip(known, new)))
                                chosen = _first(*new[:3], n)
                                best[a, w] = tuple(x[chosen] for x in new)
        yield from _listed(best)

    return rows.mapInArrow(task, PAIR)


def _listed(best: dict[tuple[int, int], tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
    """The pairs of all windows; a row that is in several windows of an anchor is listed once."""
    merged: dict[int, dict[int, tuple]] = {}
    for (a, _), found in best.items():
        one = merged.setdefault(a, {})
        for score, id_, none, number in zip(*(x.tolist() for x in found)):
            one[number] = (a, score, None if none else id_)
    pairs = [p for one in merged.values() for p in one.values()]
    for k in range(0, len(pairs), 10_000):
        a, score, id_ = zip(*pairs[k : k + 10_000])
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int32()), pa.array(score, pa.int64()), pa.array(id_, pa.int64())], ["anchor", "score", "id"])


def _sorted_keys(keys: RDD, tasks: int) -> RDD:
    """Keys (anchor, -score, kind, id is null, id), those of an anchor in one task and in order."""
    return keys.map(lambda k: (k, None)).repartitionAndSortWithinPartitions(tasks, partitionFunc=lambda k: k[0]).keys()


def _key(kind: int):
    return lambda r: (r[0], -r[1], kind, r[2] is None, r[2] or 0)


def first_positives(keys: Iterable[tuple], selves: dict[int, tuple], n: int) -> Iterator[tuple[int, int, int | None]]:
    """(anchor, score, id) of the first n pairs of every anchor but the one that is the anchor itself."""
    now, left, self_ = None, 0, None
    for anchor, minus, _, none, id_ in keys:
        if anchor != now:
            now, left, self_ = anchor, n, selves[anchor]
        if (minus, none, id_) == self_:
            self_ = None
        elif left:
            left -= 1
            yield anchor, -minus, None if none else id_


def windowed(keys: Iterable[tuple], ids: list[int | None], low: int, high: int, n: int) -> Iterator[tuple]:
    """Rows of the result, from keys in order. A positive opens a window, which closes when it is full or passed."""
    now, windows = None, []
    for anchor, minus, negative, none, id_ in keys:
        if anchor != now:
            now, windows = anchor, []
        score, id_ = -minus, None if none else id_
        if not negative:
            windows.append([score, id_, 0])
            continue
        for w in windows:
            if low * w[0] <= UNIT * score <= high * w[0]:
                w[2] += 1
                yield ids[anchor], w[1], w[2], id_, w[0], score
        windows = [w for w in windows if w[2] < n and low * w[0] <= UNIT * score]


def _blocks(asked: DataFrame) -> Iterator[tuple[list[int | None], np.ndarray, np.ndarray]]:
    """Distinct anchors in blocks of about BLOCK: ids, labels, vectors. One block at a time is on the driver."""
    spark, at = asked.sparkSession, scratch(asked.sparkSession)
    asked = asked.distinct()
    asked.write.parquet(at)
    asked = spark.read.schema(asked.schema).parquet(at)
    n, width = asked.agg(F.count("*"), F.coalesce(F.max(F.size("q")), F.lit(0))).first()
    if not n:
        return
    blocks = -(-n // max(1, min(BLOCK, BLOCK_NUMBERS // max(width, 1))))
    dealt = scratch(spark)
    number = F.pmod(F.xxhash64("id", "label", "q"), F.lit(blocks)).alias("block")
    asked.select("*", number).repartition("block").write.partitionBy("block").parquet(dealt)
    schema = T.StructType([*asked.schema, T.StructField("block", T.LongType())])
    for b in range(blocks):
        found = spark.read.schema(schema).parquet(dealt).filter(f"block = {b}").select("id", "label", "q").collect()
        if found:
            found.sort(key=lambda r: (r.id is None, r.id or 0, r.label, r.q))
            vectors = np.zeros((len(found), max(width, 1)), dtype=np.int64)
            for i, r in enumerate(found):
                vectors[i, : len(r.q)] = r.q
            yield [r.id for r in found], np.array([r.label for r in found], dtype=np.int64), vectors


def mine(
    vectors: DataFrame, anchors: Column, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding",
    positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
) -> DataFrame:
    """Hard negatives of the rows for which `anchors` holds: a row per anchor, positive and negative, as in MINED.

    A score is the inner product of vectors whose components became floor(256 * x); components that one of two vectors
    lacks are 0, and those beyond 65,536 count as that. Rows without label, vector or with a null or non-finite component take no part.
    A null id comes after all ids among equal scores. Repeated rows and ids count as often as they occur, but anchors equal in
    id, label and vector are one anchor, and one row of an anchor's kind is the anchor itself. Positives of zero or below have no
    negatives but those of score 0. Columns that are not named are not read. An empty table, or none with an anchor, gives an empty result. A vector may be of any length.
    """
    spark = vectors.sparkSession
    kept = vectors.filter(F.col(label_col).isNotNull())
    chosen = [F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).alias("vector")]
    rows = quantised(kept.select(*chosen))
    out = scratch(spark)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.createDataFrame([], MINED).write.parquet(out)
    for ids, labels, matrix_ in _blocks(quantised(kept.filter(anchors).select(*chosen))):
        everything = [(-(1 << 63), (1 << 63) - 1)]
        block = sent(spark, Anchors(ids, labels, matrix_, [everything] * len(ids)))
        norms = (matrix_ * matrix_).sum(axis=1).tolist()
        selves = {i: (-norm, id_ is None, id_ or 0) for i, (id_, norm) in enumerate(zip(ids, norms))}
        near = _sorted_keys(scored(rows, block, True, positives + 1).rdd.map(_key(0)), tasks)
        # Five a anchor, of a block of bounded size.
        first = near.mapPartitions(lambda keys, s=selves: first_positives(keys, s, positives)).collect()

        windows: list[list[tuple[int, int]]] = [[] for _ in ids]
        for a, score, _ in first:
            window = (-(-low * score // UNIT), high * score // UNIT)
            if window[0] <= window[1] and window not in windows[a]:
                windows[a].append(window)
        wide = sent(spark, Anchors(ids, labels, matrix_, windows))
        keys = scored(rows, wide, False, negatives).rdd.map(_key(1)).union(spark.sparkContext.parallelize(first, 8).map(_key(0)))
        mined = _sorted_keys(keys, tasks).mapPartitions(lambda ks, i=ids: windowed(ks, i, low, high, negatives))
        spark.createDataFrame(mined, MINED, verifySchema=False).write.mode("append").parquet(out)
        block.destroy()
        wide.destroy()
    return spark.read.schema(MINED).parquet(out)


def negatives(spark: SparkSession, folder: str) -> DataFrame:
    """The registered query: anchors are the vectors whose id is divisible by 100, and every seventh label is moved on."""
    rows = table(spark, folder, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    return mine(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)

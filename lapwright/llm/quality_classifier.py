"""Operator 10: a document classifier by Naive Bayes support vectors.

Features are indicators of n-grams: byte trigrams, and bigrams of word shapes that make up any, a twentieth or a quarter
of a text. Each indicator is scaled by the log ratio of its smoothed counts in the two classes, and a linear model with
hinge loss is fitted to the scaled indicators by dual coordinate descent. Margins become scores through a logistic curve
that is fitted on sampled documents which the model has not seen.

The model is fitted in one task on a bounded sample of labelled rows (`sample`); every document is scored in place by all
executors, from weights of fixed size.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import sent, slices, table

BUCKETS = 1 << 18  # hashed indicators
SAMPLE = 10_000  # labelled rows that the model is fitted on, at most
CAPACITY = 40_000_000  # indicators of these rows in all, at most: 0.5 GB in the one task that fits
SHARES = (0.0, 0.05, 0.25)  # a shape bigram has an indicator for each share that it exceeds
SMOOTHING, COST, ROUNDS = 1.0, 0.1, 12
BLOCK = 1 << 22  # bytes of a text handled at a time

# Letters in either case, digits, and whatever else: what is left of a word's characters in its shape.
SHAPE = bytes(
    97 if 97 <= c <= 122 or c >= 128 else 65 if 65 <= c <= 90 else 48 if 48 <= c <= 57 else c for c in range(256)
)


def indicators(text: str, seen: np.ndarray) -> np.ndarray:
    """Bucket numbers of a whole text, ascending; `seen` is a cleared table of BUCKETS flags and is left cleared."""
    raw = text.encode("utf-8")
    for k in range(0, len(raw), BLOCK):
        b = np.frombuffer(raw, dtype=np.uint8, count=min(BLOCK + 2, len(raw) - k), offset=k).astype(np.uint32)
        if len(b) > 2:
            code = b[:-2] << np.uint32(16) | b[1:-1] << np.uint32(8) | b[2:]
            seen[(code * np.uint32(2654435761)) >> np.uint32(14)] = True
    words = raw.split()
    if words:
        flat = np.frombuffer(raw.translate(SHAPE), dtype=np.uint8)
        shapes = flat[np.concatenate(([True], flat[1:] != flat[:-1]))].tobytes().split()
        pairs = Counter(zip(shapes, shapes[1:]))
        pairs[b"=", b"="] = sum(map(eq, words, words[1:]))  # a word and itself again
        for (a, b), n in pairs.items():
            for i, share in enumerate(SHARES):
                if n > share * len(words):
                    seen[zlib.crc32(b"%d %s %s" % (i, a, b)) % BUCKETS] = True
    found = np.flatnonzero(seen)
    seen[found] = False
    return found.astype(np.int32)


def _descend(rows: list[np.ndarray], scale: np.ndarray, y: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """Weights of the hinge-loss model (with a bias at the end), by dual coordinate descent over the rows."""
    weights, alpha = np.zeros(BUCKETS + 1), np.zeros(len(rows))
    values = [scale[r] for r in rows]
    norms = np.array([v @ v + 1 for v in values])
    order, shuffled = np.arange(len(rows)), np.random.default_rng(7)
    for _ in range(ROUNDS):
        shuffled.shuffle(order)
        for i in order:
            gradient = y[i] * (values[i] @ weights[rows[i]] + weights[-1]) - 1
            new = min(max(alpha[i] - gradient / norms[i], 0), cost[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                weights[rows[i]] += step * values[i]
                weights[-1] += step
                alpha[i] = new
    return weights


def _logistic(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the curve, by Newton steps on smoothed targets."""
    n1, n0 = labels.sum(), (1 - labels).sum()
    target = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
        w, d = p * (1 - p) + 1e-9, p - target
        ga, gb = d @ margins, d.sum()
        haa, hab, hbb = w @ (margins**2) + 1e-6, w @ margins, w.sum() + 1e-6
        det = haa * hbb - hab * hab
        if det <= 1e-12:
            break
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        a, b = a - da, b - db
        if abs(da) + abs(db) < 1e-8:
            break
    return max(a, 1e-3), b


def fit_rows(rows: list[np.ndarray], labels: np.ndarray) -> tuple[np.ndarray, float, float]:
    """Weights per bucket with the bias at the end, slope and offset. Of one class alone the score is constant."""
    positive = labels == 1
    if not len(rows) or positive.all() or not positive.any():
        share = (positive.sum() + 1) / (len(rows) + 2)
        return np.zeros(BUCKETS + 1, dtype=np.float32), 1.0, float(np.log(share / (1 - share)))
    p, q = (np.full(BUCKETS, SMOOTHING) for _ in range(2))
    for r, one in zip(rows, positive):
        (p if one else q)[r] += 1
    scale = np.log(p / p.sum()) - np.log(q / q.sum())
    y = np.where(positive, 1.0, -1.0)
    cost = COST * np.where(positive, len(rows) / (2 * positive.sum()), len(rows) / (2 * (~positive).sum()))
    held = np.arange(len(rows)) % 5 == 4  # rows come in hash order
    if len(set(y[held])) < 2 or len(set(y[~held])) < 2:
        held = np.zeros(len(rows), dtype=bool)
    train = np.flatnonzero(~held)
    weights = _descend([rows[i] for i in train], scale, y[train], cost[train])
    final = np.append(weights[:-1] * scale, weights[-1])
    judged = np.flatnonzero(held) if held.any() else train
    margins = np.array([final[rows[i]].sum() + final[-1] for i in judged])
    return final.astype(np.float32), *_logistic(margins, labels[judged].astype(float))


def fit(samples: DataFrame, capacity: int = CAPACITY) -> tuple[np.ndarray, float, float]:
    """Fit on rows of key, text and label (0 or 1), with few enough keys for one task.

    Of each key one row counts, that with the smallest `place`. Rows are taken by place until they have `capacity` indicators, one row at least.
    """

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(BUCKETS, dtype=bool)
        for batch in chain.from_iterable(map(slices, batches)):
            found = [indicators(t or "", seen) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, names), pa.array([f.tobytes() for f in found], pa.binary())], [*names, "found"]
            )

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, labels, held = [], [], 0
        for batch in batches:
            for label, found in zip(batch.column("label"), batch.column("found")):
                row = np.frombuffer(found.as_py(), dtype=np.int32)
                held += len(row)
                if held <= capacity or not rows:
                    rows.append(row)
                    labels.append(label.as_py())
        if not rows:
            return
        weights, a, b = fit_rows(rows, np.array(labels))
        yield pa.RecordBatch.from_arrays(
            [pa.array([weights.tobytes()], pa.binary()), pa.array([float(a)]), pa.array([float(b)])], ["w", "a", "b"]
        )

    names = ["key", "place", "label"]
    chosen = samples.select(*names, "text")
    found = chosen.mapInArrow(extract, T.StructType([*chosen.drop("text").schema.fields, T.StructField("found", T.BinaryType())]))
    one = found.groupBy("key").agg(F.min(F.struct("place", "label", "found")).alias("x")).select("x.*")
    model = one.repartition(1).sortWithinPartitions("place", "label", "found").mapInArrow(learn, "w binary, a double, b double").collect()
    if not model:
        return fit_rows([], np.array([]))
    return np.frombuffer(model[0]["w"], dtype=np.float32), model[0]["a"], model[0]["b"]


def held_out(id_col: str = "doc_id") -> F.Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def classify(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    threshold: float = 0.3, sample: int = SAMPLE,
) -> DataFrame:
    """All rows of `docs` with `held_out`, `score` (0 to 1) and `predicted` added, replacing columns of these names.

    Labels are learned only where crc32 of the id, as text, is not divisible by 5; of those, the `sample` ids with the
    smallest hash, and of several documents with such an id that with the smallest hash of id and text. A label whose id repeats
    counts once, the smaller value; null ids and labels are not learned from. A null text is scored as empty, a null id is not
    held out. Very long texts are read whole, in blocks. Without labels every score is 0.5; an empty table gives an empty result.
    """
    learned = (
        labels.select(F.col(id_col).alias("key"), F.col(label_col).cast("int").alias("label"))
        .filter("key is not null and label is not null")
        .filter(~held_out("key"))
        .groupBy("key").agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("key"), "key").limit(sample)
    )
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    samples = texts.join(learned, F.col("id") == F.col("key")).select("key", F.xxhash64("id", "text").alias("place"), "label", "text")
    model = sent(docs.sparkSession, fit(samples))  # one number per bucket

    others = docs.drop("held_out", "score", "predicted")
    names = others.columns

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, a, b = model.value
        seen = np.zeros(BUCKETS, dtype=bool)
        for batch in chain.from_iterable(map(slices, batches)):
            margins = np.array(
                [weights[indicators(t or "", seen)].sum(dtype=np.float64) for t in batch.column(text_col).to_pylist()]
            )
            z = np.clip(a * (margins + float(weights[-1])) + b, -30, 30)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(1 / (1 + np.exp(-z)), pa.float64())], [*names, "score"])

    scored = others.mapInArrow(task, T.StructType([*others.schema.fields, T.StructField("score", T.DoubleType())]))
    return scored.withColumn("held_out", held_out(id_col)).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def scores(spark: SparkSession, folder: str) -> DataFrame:
    """The registered query."""
    done = classify(table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "labels"))
    return done.select("doc_id", "held_out", "score", "predicted")

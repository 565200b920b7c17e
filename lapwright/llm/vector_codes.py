"""Operator 13: vector code compression, a codebook per part learned with adaptive distance bounds.

Vectors are cut into parts, and every part has a codebook whose entries move to the mean of the parts they stand for. With
each part of each vector are kept its nearest entry with an upper bound of its distance, the b next entries in order with
lower bounds, and one outer bound for all others. When entries have moved, the bounds move by as much. Where the upper bound stays
below the first lower bound, the nearest entry is the same and no distance is computed. Elsewhere the bounds tell how
far down the list an entry can be that has come nearer, and those are compared by exact integer distances; if even the outer
bound is reached, all are. b starts at a quarter of the entries and shrinks to the depth that was needed, an eighth at least.

Bounds are distances in single precision, rounded to the safe side; a margin sends all doubtful cases, ties among them, to
the integer comparison. So codes are those of plain exact search.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, sent, slices, stored, table
from .vectors import matrix, quantised, squared_distances

PARTS, ENTRIES, ROUNDS = 16, 64, 2
MARGIN = 1e-5  # of a bound, and as much in absolute terms: far above the rounding of single precision
STATE = ("code", "upper", "near", "lower", "outer")
STATE_FIELDS = [T.StructField(n, T.BinaryType()) for n in STATE]


def _below(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype(np.float32), np.float32(-np.inf))


def _above(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype(np.float32), np.float32(np.inf))


def start(x: np.ndarray, entries: np.ndarray, b: int) -> tuple[np.ndarray, ...]:
    """Code and bounds of the rows of one part: code (n), upper (n), near (n, b), lower (n, b), outer (n)."""
    d = squared_distances(x, entries)
    order = np.argsort(d, axis=1, kind="stable")[:, : b + 2]
    far = np.sqrt(np.take_along_axis(d, order, axis=1).astype(np.float64))
    outer = far[:, b + 1] if order.shape[1] > b + 1 else np.full(len(x), np.inf)
    return order[:, 0].astype(np.uint8), _above(far[:, 0]), order[:, 1 : b + 1].astype(np.uint8), _below(far[:, 1 : b + 1]), _below(outer)


def advance(
    x: np.ndarray, state: tuple[np.ndarray, ...], before: np.ndarray, entries: np.ndarray
) -> tuple[tuple[np.ndarray, ...], int]:
    """Code and bounds of the rows of one part after its entries moved, and the depth of the lists that was needed."""
    code, upper, near, lower, outer = (s.copy() for s in state)
    b, drift = near.shape[1], np.sqrt(((entries - before).astype(np.float64) ** 2).sum(axis=1)) * (1 + MARGIN)
    upper = _above(upper + drift[code])
    outer = _below(outer - drift.max(initial=0.0))
    lower = _below(lower - drift[near])
    # A bound holds for all that stand behind it, too.
    lower = np.minimum.accumulate(np.column_stack([lower, outer])[:, ::-1], axis=1)[:, ::-1][:, :b]

    certain = lambda u, low: u * (1 + MARGIN) + MARGIN < low
    next_ = lower[:, 0] if b else outer
    open_ = np.flatnonzero(~certain(upper, next_))
    if not len(open_):
        return (code, upper, near, lower, outer), 0
    own = ((x[open_] - entries[code[open_]]) ** 2).sum(axis=1)
    upper[open_] = _above(np.sqrt(own.astype(np.float64)))
    still = ~certain(upper[open_], next_[open_])
    open_, own = open_[still], own[still]
    depth = (~certain(upper[open_, None], lower[open_])).sum(axis=1)
    whole = ~certain(upper[open_], outer[open_])

    part = ~whole & (depth > 0)
    rows, needed = open_[part], int(depth[part].max(initial=0))
    if len(rows):
        listed = near[rows, :needed]
        checked = np.arange(needed)[None, :] < depth[part][:, None]
        d = ((x[rows, None, :] - entries[listed]) ** 2).sum(axis=2)
        # The nearest entry so far takes part; what was not checked stays where it is, behind the others.
        all_d = np.column_stack([own[part], np.where(checked, d, np.iinfo(np.int64).max)])
        all_e = np.column_stack([code[rows], listed]).astype(np.int64)
        order = np.lexsort((np.where(np.column_stack([checked[:, :1] | True, checked]), all_e, np.arange(needed + 1)[None, :]), all_d), axis=1)
        sorted_d, sorted_e = np.take_along_axis(all_d, order, axis=1), np.take_along_axis(all_e, order, axis=1)
        code[rows] = sorted_e[:, 0]
        upper[rows] = _above(np.sqrt(sorted_d[:, 0].astype(np.float64)))
        near[rows, :needed] = sorted_e[:, 1:]
        exact = _below(np.sqrt(sorted_d[:, 1:].astype(np.float64)))
        lower[rows, :needed] = np.where(checked, exact, lower[rows, :needed])
        lower[rows] = np.minimum.accumulate(np.column_stack([lower[rows], outer[rows]])[:, ::-1], axis=1)[:, ::-1][:, :b]
    if whole.any():
        rows = open_[whole]
        for s, new in zip((code, upper, near, lower, outer), start(x[rows], entries, b)):
            s[rows] = new
        needed = b
    return (code, upper, near, lower, outer), needed


def shrunk(state: tuple[np.ndarray, ...], b: int) -> tuple[np.ndarray, ...]:
    """The same with lists of b entries; the first bound that goes becomes the outer bound."""
    code, upper, near, lower, outer = state
    if b >= near.shape[1]:
        return state
    return code, upper, near[:, :b], lower[:, :b], np.minimum(outer, lower[:, b])


def _packed(states: list[tuple[np.ndarray, ...]]) -> list[pa.Array]:
    """Per row and kind of state, the bytes of all parts."""
    columns = []
    for kind in zip(*states):
        flat = np.ascontiguousarray(np.concatenate([k.reshape(len(k), -1) for k in kind], axis=1))
        columns.append(pa.array([row.tobytes() for row in flat], pa.binary()))
    return columns


def _unpacked(batch: pa.RecordBatch, parts: int) -> list[tuple[np.ndarray, ...]]:
    n = batch.num_rows
    read = lambda name, kind: np.frombuffer(b"".join(batch.column(name).to_pylist()), dtype=kind).reshape(n, parts, -1)
    code, upper, near = read("code", np.uint8), read("upper", np.float32), read("near", np.uint8)
    lower, outer = read("lower", np.float32), read("outer", np.float32)
    return [(code[:, p, 0], upper[:, p, 0], near[:, p], lower[:, p], outer[:, p, 0]) for p in range(parts)]


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices in which all lists have one length; a file may hold rows of slices that shrank differently."""
    for part in chain.from_iterable(map(slices, batches)):
        sizes = np.array([len(x) for x in part.column("near").to_pylist()])
        cuts = [0, *(np.flatnonzero(np.diff(sizes)) + 1).tolist(), part.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield part.slice(a, b - a)


def _cut(x: np.ndarray, parts: int) -> np.ndarray:
    """Parts of the rows of a matrix: (part, row, place)."""
    return x.reshape(len(x), parts, -1).transpose(1, 0, 2)


def _first_state(rows: DataFrame, books: np.ndarray, b: int) -> DataFrame:
    parts, _, m = books.shape
    at = sent(rows.sparkSession, books)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chain.from_iterable(map(slices, batches)):
            x = _cut(matrix(part.column("q"), parts * m), parts)
            states = [start(x[p], at.value[p], b) for p in range(parts)]
            yield pa.RecordBatch.from_arrays([*part.columns, *_packed(states)], [*part.schema.names, *STATE])

    return rows.mapInArrow(task, T.StructType([*rows.schema.fields, *STATE_FIELDS]))


def _next_state(rows: DataFrame, before: np.ndarray, books: np.ndarray, least: int) -> DataFrame:
    parts, _, m = books.shape
    at = sent(rows.sparkSession, (before, books))
    names = [c for c in rows.columns if c not in STATE]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        old, new = at.value
        for part in _alike(batches):
            x = _cut(matrix(part.column("q"), parts * m), parts)
            moved = [advance(x[p], s, old[p], new[p]) for p, s in enumerate(_unpacked(part, parts))]
            b = max(least, max(depth for _, depth in moved))
            yield pa.RecordBatch.from_arrays([*map(part.column, names), *_packed([shrunk(s, b) for s, _ in moved])], [*names, *STATE])

    return rows.mapInArrow(task, rows.schema)


def _moved(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """Entries as the means of their parts, rounded down; an entry without parts stays.

    Every task adds up its rows, so a sum per entry and place is shuffled for each task, whatever the number of rows.
    """
    parts, k, m = books.shape

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros((parts, k), np.int64), np.zeros((parts, k, m), np.int64)
        for part in chain.from_iterable(map(slices, batches)):
            x = _cut(matrix(part.column("q"), parts * m), parts)
            codes = np.frombuffer(b"".join(part.column("code").to_pylist()), np.uint8).reshape(-1, parts)
            for p in range(parts):
                count[p] += np.bincount(codes[:, p], minlength=k)
                np.add.at(total[p], codes[:, p], x[p])
        part, entry, place = (i.ravel() for i in np.indices(total.shape))
        used = count[part, entry] > 0
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(i[used], pa.int64()) for i in (part, entry, place)), pa.array(count[part, entry][used]), pa.array(total.ravel()[used])],
            ["part", "entry", "place", "n", "total"],
        )

    sums = rows.select("q", "code").mapInArrow(task, "part long, entry long, place long, n long, total long")
    books = books.copy()
    # One row per number of the codebooks.
    for r in sums.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
        books[r.part, r.entry, r.place] = r.total // r.n
    return books


def _finished(rows: DataFrame, before: np.ndarray, books: np.ndarray) -> DataFrame:
    """Replace vector and state by the final code and its error."""
    parts, _, m = books.shape
    at = sent(rows.sparkSession, (before, books))
    names = [c for c in rows.columns if c not in STATE and c != "q"]
    fields = [f for f in rows.schema if f.name in names]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        old, new = at.value
        for part in _alike(batches):
            x = _cut(matrix(part.column("q"), parts * m), parts)
            codes = [advance(x[p], s, old[p], new[p])[0][0] for p, s in enumerate(_unpacked(part, parts))]
            error = sum(((x[p] - new[p][c]) ** 2).sum(axis=1) for p, c in enumerate(codes))
            hexes = [row.tobytes().hex() for row in np.ascontiguousarray(np.column_stack(codes))]
            yield pa.RecordBatch.from_arrays([*map(part.column, names), pa.array(hexes), pa.array(error, pa.int64())], [*names, "code", "error"])

    return rows.mapInArrow(task, T.StructType([*fields, T.StructField("code", T.StringType()), T.StructField("error", T.LongType())]))


def compress(
    vectors: DataFrame, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
) -> tuple[DataFrame, np.ndarray]:
    """vec_id, label, code and error per kept row, and the codebooks (part, entry, place).

    Components become floor(256 * x), held within 2**24 of 0. Rows whose vector is null or holds a null or non-finite
    component are dropped. All vectors are as wide as the longest, made up to a multiple of the parts; missing
    components are 0. The first entries are the first rows by id (null ids last), then by components, so repeated ids are rows of
    their own; with fewer rows than entries the codebooks are smaller. Ties go to the lower entry. `entries` is at most 256. Columns that are not named
    are not read. An empty table gives an empty result and empty codebooks.
    """
    chosen = vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector"))
    kept = stored(quantised(chosen))
    width = kept.agg(F.max(F.size("q"))).first()[0]
    if width is None:
        empty = kept.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
        return empty, np.zeros((parts, 0, 0), np.int64)
    m = max(1, -(-width // parts))
    first = kept.select("vec_id", "q").orderBy(F.col("vec_id").asc_nulls_last(), "q").limit(entries).collect()
    table_ = np.zeros((len(first), parts * m), np.int64)
    for i, r in enumerate(first):
        table_[i, : len(r.q)] = r.q
    books = _cut(table_, parts).copy()

    k = books.shape[1]
    before, state = books, stored(_first_state(kept, books, min(k - 1, max(1, entries // 4))))
    discard(kept)
    for n in range(rounds):
        if n:
            next_ = stored(_next_state(state, before, books, min(k - 1, max(1, entries // 8))))
            discard(state)
            before, state = books, next_
        books = _moved(state, books)
    done = stored(_finished(state, before, books))
    discard(state)
    return done, books


def digest(books: np.ndarray) -> str:
    """SHA-256 of all numbers by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def codes(spark: SparkSession, folder: str) -> DataFrame:
    """The registered query: codes with their errors, and the errors of equal labels (null ones together) summed."""
    done, books = compress(table(spark, folder, "embeddings"))
    by_label = done.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return done.join(by_label, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")
    )

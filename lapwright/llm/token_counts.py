"""Operator 5: numbers of tokens per document, without a list of token ids.

1. Every task counts the pre-tokens of its documents and emits each about once; their sums are the corpus vocabulary.
2. The pieces of every distinct pre-token are counted once and the result is stored.
3. Per-document pre-token frequencies meet these counts and are summed. The most frequent pre-tokens, a bounded number,
   are sent to all tasks; only the remaining rows are shuffled for a join, and none of those is a hot key.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import sent, slices, stored, table
from .pieces import WordPieces

SENT = 100_000  # most pre-tokens that are sent to all tasks; the others are joined
HELD = 300_000  # distinct pre-tokens that a task holds before it emits their counts


def vocabulary_counts(docs: DataFrame, pieces: WordPieces, text_col: str = "text") -> DataFrame:
    """Distinct pre-tokens of all texts: word, n (occurrences), n_pieces."""
    shared = sent(docs.sparkSession, pieces)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, seen = shared.value, Counter()
        for batch in chain.from_iterable(map(slices, batches)):
            for text in batch.column(0).to_pylist():
                for i, part in enumerate(v.split(text or "")):
                    if not i % 2:
                        seen.update(v.words(v.plain(part)))
                if len(seen) >= HELD:
                    yield _counted(seen)
                    seen = Counter()
        yield _counted(seen)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        for batch in chain.from_iterable(map(slices, batches)):
            sizes = [len(v.pieces(w)) for w in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sizes, pa.int32())], ["word", "n", "n_pieces"])

    words = docs.select(text_col).mapInArrow(found, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return words.mapInArrow(measured, "word string, n bigint, n_pieces int")


def _counted(seen: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], ["word", "n"]
    )


def most_frequent(words: DataFrame, at_most: int) -> dict[str, int]:
    """Pieces of the pre-tokens above the lowest frequency class that leaves no more than `at_most` of them."""
    classes = F.length(F.bin("n")).alias("class")  # doublings of the frequency: at most 64 rows come to the driver
    left, floor = at_most, None
    for size, n in sorted(map(tuple, words.groupBy(classes).count().collect()), reverse=True):
        if n > left:
            break
        left, floor = left - n, size
    if floor is None:
        return {}
    return dict(map(tuple, words.filter(F.length(F.bin("n")) >= floor).select("word", "n_pieces").collect()))


def count_tokens(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", most_sent: int = SENT
) -> DataFrame:
    """Per row: the id, `n_bytes` (UTF-8) and `n_tokens`.

    A null text is empty and has none of either; a null id is kept. Rows with equal ids or texts are counted one by one.
    A special string of the vocabulary inside a text is one token. Only the two named columns are read, so others may
    have any name. An empty table gives an empty result. `most_sent` changes the way, not the result.
    """
    spark = docs.sparkSession
    pieces = WordPieces(vocabulary)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    words = stored(vocabulary_counts(rows, pieces))
    # The dictionary has `most_sent` entries at most; the tokenizer's has a fixed size.
    shared = sent(spark, (pieces.marks, tuple(pieces.special), pieces.words, most_frequent(words, most_sent)))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, special, find, known = shared.value
        for batch in chain.from_iterable(map(slices, batches)):
            sizes, sums, rare, times = [], [], [], []
            for text in batch.column("text").to_pylist():
                text, n = text or "", 0
                if any(map(text.__contains__, special)):
                    parts = marks.split(text)
                    n, seen = len(parts) // 2, Counter(w for part in parts[::2] for w in find(part))
                else:
                    seen = Counter(find(text))
                other = [w for w in seen if w not in known]
                times.append([seen.pop(w) for w in other])
                sums.append(n + sum(map(int.__mul__, map(known.__getitem__, seen), seen.values())))
                sizes.append(len(text.encode("utf-8")))
                rare.append(other)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(sums, pa.int64()),
                    pa.array(rare, pa.list_(pa.string())),
                    pa.array(times, pa.list_(pa.int32())),
                ],
                ["doc_id", "n_bytes", "known", "rare", "times"],
            )

    kind = dict(rows.dtypes)["doc_id"]
    per_doc = rows.mapInArrow(
        frequencies, f"doc_id {kind}, n_bytes bigint, known bigint, rare array<string>, times array<int>"
    ).withColumn("row", F.monotonically_increasing_id())
    spread = per_doc.select(
        "row", "doc_id", "n_bytes", "known", F.posexplode_outer(F.arrays_zip("rare", "times")).alias("at", "w")
    ).select(
        "row", "doc_id", "n_bytes",
        F.when(F.coalesce("at", F.lit(0)) == 0, F.col("known")).otherwise(0).alias("known"),
        F.col("w.rare").alias("word"), F.col("w.times").alias("times"),
    )
    met = spread.join(words.select("word", "n_pieces"), "word", "left")
    return (
        met.groupBy("row", "doc_id", "n_bytes")
        .agg(F.sum(F.col("known") + F.coalesce(F.col("times").cast("long") * F.col("n_pieces"), F.lit(0))).alias("n_tokens"))
        .drop("row")
    )


def counts(spark: SparkSession, folder: str, vocabulary: str, limit: int = 512) -> DataFrame:
    """The registered query: tokens per document and whether they exceed the limit."""
    done = count_tokens(table(spark, folder, "documents"), vocabulary)
    return done.withColumn("over_limit", F.col("n_tokens") > limit)

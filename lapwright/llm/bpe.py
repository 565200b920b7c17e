"""Operator 2: byte-pair encoding of whole texts and decoding of their ids.

A word is encoded by the contiguous rank array of `pieces.merge_short`. Tasks keep the ids of words they have met in a
bounded table, as most words of a corpus are repeats; a word that is not in it is merged again.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import sent_built, slices, table
from .pieces import WordPieces, file_text, told_apart

REMEMBERED = 400_000  # words whose ids a task keeps; memory only, no effect on results


class Encoder:
    """Texts to ids, with a bounded memory of words: when the newer half is full, the older one is forgotten."""

    def __init__(self, vocabulary: WordPieces, remembered: int = REMEMBERED):
        self.vocabulary, self.half, self.known, self.older = vocabulary, remembered // 2, {}, {}

    def word(self, word: str) -> bytes:
        ids = self.older.get(word) or array("I", self.vocabulary.pieces(word)).tobytes()
        if len(word) <= 64:
            if len(self.known) >= self.half:
                self.known, self.older = {}, self.known
            self.known[word] = ids
        return ids

    def __call__(self, text: str) -> bytes:
        """Ids as packed little-endian unsigned 32-bit integers."""
        v, out = self.vocabulary, []
        for i, part in enumerate(v.split(text)):
            if i % 2:
                out.append(array("I", [v.special[part]]).tobytes())
            else:
                known, word = self.known, self.word
                out += [known.get(w) or word(w) for w in v.words(v.plain(part))]
        return b"".join(out)


def _encoder(text: str, odd: frozenset[str]) -> Encoder:
    return Encoder(WordPieces.of(text, odd))


def _names(text: str, odd: frozenset[str]) -> dict[int, str]:
    return WordPieces.of(text, odd).names


def encode(docs: DataFrame, vocabulary: str, text_col: str = "text") -> DataFrame:
    """Add `ids` (binary: little-endian unsigned 32-bit integers) and `n_tokens` (long) to every row.

    A null text counts as empty and has no ids. Rows are independent, so repeated rows and ids get equal results; other
    columns pass through, and columns already named `ids` or `n_tokens` are replaced. An empty table gives an empty one.
    """
    # The tables of some 50,000 entries are made by the workers; the driver holds the text of the file alone.
    shared = sent_built(docs.sparkSession, _encoder, file_text(vocabulary), told_apart())
    kept = docs.drop("ids", "n_tokens")
    fields = kept.schema.fields + [T.StructField("ids", T.BinaryType()), T.StructField("n_tokens", T.LongType())]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared.value
        for batch in chain.from_iterable(map(slices, batches)):
            ids = [encoder(text or "") for text in batch.column(text_col).to_pylist()]
            yield _with(batch, {"ids": pa.array(ids, pa.binary()), "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64())})

    return kept.mapInArrow(task, T.StructType(fields))


def decode(rows: DataFrame, vocabulary: str) -> DataFrame:
    """Add `decoded`, the text of `ids`: the pieces by name, with a blank between two.

    Null ids give a null. Unknown ids cannot come from `encode` and raise an error.
    """
    shared = sent_built(rows.sparkSession, _names, file_text(vocabulary), told_apart())
    kept = rows.drop("decoded")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = shared.value.__getitem__
        for batch in chain.from_iterable(map(slices, batches)):
            texts = [
                None if x is None else " ".join(map(name, array("I", x))) for x in batch.column("ids").to_pylist()
            ]
            yield _with(batch, {"decoded": pa.array(texts, pa.string())})

    return kept.mapInArrow(task, T.StructType(kept.schema.fields + [T.StructField("decoded", T.StringType())]))


def _with(batch: pa.RecordBatch, more: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, *more.values()], [*batch.schema.names, *more])


def round_trip(spark: SparkSession, folder: str, vocabulary: str) -> DataFrame:
    """The registered query: digests of ids and of the decoded text of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    done = decode(encode(docs, vocabulary).drop("text"), vocabulary)
    return done.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )

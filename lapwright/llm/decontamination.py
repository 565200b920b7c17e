"""Operator 7: passages of benchmark items in documents, by winnowing. DataFrame functions only.

A text keeps the smallest hash of every window of 7 successive 4-word grams, so two texts that share any 10 words in
a row keep a hash in common. Fingerprints of documents are joined with those of the items; documents that share one are
searched word by word, and a hit is an exact equality of all words of a window. Items too short for a window are
searched as a whole, by the grams of their own length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import identity, on_identity, stored, table, whole_text

SPAN, GRAM = 10, 4
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # either case; A-Z are lower-cased word by word


def words(text: Column) -> Column:
    """Words of a text with A-Z, and no other letter, in lower case."""
    found = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    return F.transform(found, lambda w: F.when(F.lower(w) == w, w).otherwise(F.translate(w, UPPER, LOWER)))


def _shifted(a: Column, by: int, f) -> Column:
    """f of every element and the one `by` places on; as many results as there are such pairs."""
    n = F.greatest(F.size(a) - by, F.lit(0))
    return F.zip_with(F.slice(a, 1, n), F.slice(a, by + 1, n), f)


def _joined(hashes: Column, by: int) -> Column:
    return _shifted(hashes, by, lambda x, y: F.xxhash64(x, y))


def _smaller(x: Column, y: Column) -> Column:
    return F.least(x, y)


def with_fingerprints(rows: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """Add `prints`, the distinct winnowed hashes of `words`. Built step by step, so that no array is computed twice."""
    if (gram, span) != (4, 10):
        raise ValueError("the steps below are those of 4-word grams and spans of 10")
    hashes = F.transform("words", lambda w: F.xxhash64(w))
    return (
        rows.withColumn("step", hashes)
        .withColumn("step", _joined(F.col("step"), 1))
        .withColumn("step", _joined(F.col("step"), 2))  # grams of 4 words
        .withColumn("step", _shifted(F.col("step"), 1, _smaller))
        .withColumn("step", _shifted(F.col("step"), 2, _smaller))  # minima of 4 grams
        .withColumn("step", _shifted(F.col("step"), 3, _smaller))  # minima of 7 grams: 10 words
        .withColumn("prints", F.array_distinct("step"))
        .drop("step")
    )


def distinct_prints(rows: DataFrame) -> DataFrame:
    """The fingerprints of all rows.

    A plain explode has Spark test the array beforehand. The test is pushed below all steps, each of which names the one
    before twice, so it would repeat the first step dozens of times.
    """
    return with_fingerprints(rows).select(F.explode_outer("prints").alias("print")).where("print is not null").distinct()


def _grams(rows: DataFrame, lengths: Column, keep: list[str]) -> DataFrame:
    """Every run of words of the given lengths: keep, at (0-based), len, gram (its text)."""
    return (
        rows.select(*keep, "words", F.explode(lengths).alias("len"))
        .filter(F.size("words") >= F.col("len"))
        .select(*keep, "words", "len", F.explode(F.expr("sequence(0, size(words) - len)")).alias("at"))
        .select(*keep, "at", "len", F.array_join(F.slice("words", F.col("at") + 1, F.col("len")), " ").alias("gram"))
    )


def benchmark_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct windows of the items: item_id, len, gram."""
    split = items.select(F.col(id_col).alias("item_id"), words(whole_text(text_col)).alias("words"))
    length = F.array(F.least(F.size("words"), F.lit(SPAN)))
    return _grams(split.filter(F.size("words") > 0), length, ["item_id"]).select("item_id", "len", "gram").distinct()


def hits(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Per distinct document (`identity`): its n_words; and the windows found in it, as (identity, at, len, gram)."""
    windows = stored(benchmark_windows(items))
    short = [r[0] for r in windows.filter(F.col("len") < SPAN).select("len").distinct().collect()]  # 9 at most
    item_words = windows.filter(F.col("len") == SPAN).select(F.split("gram", " ").alias("words"))
    # Stored, so that Spark knows its size: a small benchmark is broadcast, a large one is joined by shuffling.
    targets = stored(distinct_prints(item_words))

    rows = docs.select(*identity(id_col, text_col), words(whole_text(text_col)).alias("words"))
    keys = ["doc_id", "h1", "h2"]
    marked = with_fingerprints(rows).select(*keys, F.size("words").alias("n_words"), F.explode_outer("prints").alias("print"))
    marked = marked.join(targets.withColumn("found", F.lit(True)), "print", "left")
    # Rows of a document are side by side, so partial sums leave a row per document before the shuffle.
    seen = stored(marked.groupBy(*keys, "n_words").agg(F.coalesce(F.max("found"), F.lit(False)).alias("found")))

    again = docs.select(*identity(id_col, text_col), F.col(text_col).alias("text"))
    suspects = on_identity(again, seen.filter("found").select(*keys), "left_semi")
    spans = _found(suspects, windows.filter(F.col("len") == SPAN), [SPAN], keys)
    if short:
        spans = spans.unionByName(_found(again, windows.filter(F.col("len") < SPAN), sorted(short), keys))
    return seen.drop("found"), stored(spans.distinct())


def _found(rows: DataFrame, windows: DataFrame, lengths: list[int], keys: list[str]) -> DataFrame:
    split = rows.select(*keys, words(F.coalesce("text", F.lit(""))).alias("words"))
    grams = _grams(split, F.array(*map(F.lit, lengths)), keys)
    return grams.join(windows.select("len", "gram").distinct(), ["len", "gram"], "left_semi")


def covered(spans: Column) -> Column:
    """Words inside the spans, an array of (at, len) in order of place."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    end = lambda s: (s["at"] + s["len"]).cast("int")
    return F.aggregate(
        spans, start,
        lambda a, s: F.struct(
            F.greatest(a["end"], end(s)).alias("end"),
            (a["n"] + F.greatest(end(s) - F.greatest(a["end"], s["at"]), F.lit(0))).cast("long").alias("n"),
        ),
    )["n"]


def contamination(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Per row of `docs`: doc_id, h1, h2, n_words, n_hit (words inside found windows), items (sorted ids, as strings) and spans.

    `items` has item_id and text. A null text has no words, an item without words has no window, and an item with a
    null id is found but not listed. Rows equal in id and text get equal results; columns that are not named are not
    read. With an empty table on either side nothing is hit.
    """
    keys = ["doc_id", "h1", "h2"]
    seen, spans = hits(docs, items, id_col, text_col)
    ranges = F.sort_array(F.collect_set(F.struct("at", "len")))
    by_doc = spans.groupBy(*keys).agg(ranges.alias("spans")).withColumn("n_hit", covered(F.col("spans")))
    pairs = spans.select(*keys, "len", "gram").distinct().join(benchmark_windows(items), ["len", "gram"])
    by_item = pairs.select(*keys, F.col("item_id").cast("string").alias("item")).distinct()
    listed = by_item.groupBy(*keys).agg(F.array_sort(F.collect_list("item")).alias("items"))
    result = on_identity(on_identity(seen, by_doc), listed)
    return on_identity(docs.select(*identity(id_col, text_col)), result).select(
        *keys, "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("spans", F.array().cast("array<struct<at:int,len:int>>")).alias("spans"),
    )


def keep_clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs`, with all columns, in which no window of an item occurs."""
    _, spans = hits(docs, items, id_col, text_col)
    names = [f"hit {c}" for c in ("doc_id", "h1", "h2")]
    hit = spans.select("doc_id", "h1", "h2").distinct().toDF(*names)
    i, a, b = (c for c in identity(id_col, text_col))
    same = i.eqNullSafe(F.col(f"`{names[0]}`")) & (a == F.col(f"`{names[1]}`")) & (b == F.col(f"`{names[2]}`"))
    return docs.join(hit, same, "left_anti")


def report(spark: SparkSession, folder: str) -> DataFrame:
    """The registered query."""
    done = contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return done.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )

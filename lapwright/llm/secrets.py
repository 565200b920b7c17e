"""Operator 1: secrets in whole texts. DataFrame functions only.

Three patterns give the base spans. Further spans are long runs of key characters that read like random strings rather
than identifiers: two character Markov models, one per class, are trained on labelled strings, and a run is taken where
its log-likelihood ratio per transition is high enough. The models are tables over pairs of 64 characters, so they are
of fixed size whatever the input.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import identity, on_identity, table

# The patterns and least lengths of the base rules. The least lengths of access and hex can stand in the
# pattern, as a run of those characters is matched from its start.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
ASSIGNED = 12

RUN = r"[A-Za-z0-9+/_-]{16,}"  # what may be a random string,
PART = r"[A-Za-z0-9+]{16,}"  # and what may be one that is joined to other words
KINDS = ("assign", "access", "hex", "random")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
SAMPLE = 20_000  # strings of either class that the models are trained on, at most
RATIO = 0.5  # least mean log-likelihood ratio of a transition
VARIETY = 8  # least number of distinct characters


def place(c: Column) -> Column:
    """Number of a character in the alphabet, from 1; 0 for any other."""
    return F.instr(F.lit(ALPHABET), F.translate(c, "-_", "+/"))


def _at(s: Column, i: Column) -> Column:
    return F.substring(s, i, 1)


def labelled_strings(docs: DataFrame, text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """value and label: 1 for random strings (digests in base 64 and 16, and what the base rules find), 0 for words.

    Words are the runs of 8 and more letters of documents without a base finding, of a tenth of `sample` such documents at
    most. Each class has `sample` strings at most, cut to 256 characters. The smallest hashes are taken, so the choice
    does not depend on how the rows are dealt out.
    """
    spark = docs.sparkSession
    text = F.col(text_col)
    digest = F.sha2(F.concat(F.lit("sample "), F.col("id").cast("string")), 256)
    made = spark.range(sample // 4).select(
        F.explode(F.array(F.regexp_replace(F.base64(F.unhex(digest)), "=", ""), F.substring(digest, 1, 40))).alias("value")
    )
    secret = docs.filter(text.rlike(ASSIGN) | text.rlike(ACCESS) | text.rlike(HEX)).select(
        F.explode(F.array_union(
            F.array_union(F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2)), F.regexp_extract_all(text, F.lit(ACCESS), F.lit(0))),
            F.regexp_extract_all(text, F.lit(HEX), F.lit(0)),
        )).alias("value")
    ).filter(F.length("value") >= ASSIGNED)
    without = docs.filter(text.isNotNull() & ~(text.rlike(ASSIGN) | text.rlike(ACCESS) | text.rlike(HEX)))
    hashed = without.select(text.alias("text"), F.xxhash64(text).alias("h"))
    # Chosen by hash alone: whole texts would meet in one task.
    chosen = hashed.select("h").distinct().orderBy("h").limit(sample // 10)
    plain = hashed.join(chosen, "h", "left_semi").dropDuplicates(["h"])
    word = plain.select(F.explode(F.regexp_extract_all(F.col("text"), F.lit(r"[A-Za-z_-]{8,}"), F.lit(0))).alias("value"))

    def bounded(rows: DataFrame, label: int) -> DataFrame:
        few = rows.select(F.substring("value", 1, 256).alias("value")).distinct()
        return few.orderBy(F.xxhash64("value"), "value").limit(sample).withColumn("label", F.lit(label))

    return bounded(made, 1).unionByName(bounded(secret, 1)).unionByName(bounded(word, 0))


def transition_ratios(strings: DataFrame) -> list[float]:
    """Log ratio, random to ordinary, of every transition, row by row of the alphabet (with 0 for other characters)."""
    n = len(ALPHABET) + 1
    pairs = strings.filter(F.length("value") > 1).select(
        "label", "value", F.explode(F.expr("sequence(1, length(value) - 1)")).alias("i")
    ).select("label", place(_at(F.col("value"), F.col("i"))).alias("a"), place(_at(F.col("value"), F.col("i") + 1)).alias("b"))
    counts = [[[0.1] * n for _ in range(n)] for _ in range(2)]
    for label, a, b, times in pairs.groupBy("label", "a", "b").count().collect():  # n * n rows per class at most
        counts[label][a][b] += times
    return [
        math.log(counts[1][a][b] / sum(counts[1][a])) - math.log(counts[0][a][b] / sum(counts[0][a]))
        for a in range(n)
        for b in range(n)
    ]


def mean_ratio(value: Column, ratios: list[float]) -> Column:
    """Mean log-likelihood ratio of a string's transitions."""
    known = F.split(F.lit(",".join(f"{r:.6f}" for r in ratios)), ",").cast("array<double>")
    n = len(ALPHABET) + 1
    steps = F.sequence(F.lit(1), F.length(value) - 1)
    total = F.aggregate(
        steps, F.lit(0.0),
        lambda s, i: s + F.element_at(known, place(_at(value, i)) * n + place(_at(value, i + 1)) + 1),
    )
    return F.when(F.length(value) > 1, total / (F.length(value) - 1)).otherwise(F.lit(0.0))


def _matches(text: Column, kind: int, pattern: str, group: int = 0) -> Column:
    """Array of (kind, i, before, size, value): the i-th match and the number of characters between it and the last."""
    found = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("whole"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"),
    )
    rows = F.transform(
        F.filter(found, lambda x: x["whole"].isNotNull()),
        lambda x, i: F.struct(
            F.lit(kind).alias("kind"), i.alias("i"), F.length(x["gap"]).alias("before"), F.length(x["whole"]).alias("size"),
            x["value"].alias("value"),
        ),
    )
    kind_of = "array<struct<kind:int,i:int,before:int,size:int,value:string>>"
    return F.when(text.rlike(pattern), rows.cast(kind_of)).otherwise(F.array().cast(kind_of))


def _outside(x: Column, spans: Column) -> Column:
    """The parts of a span that lie in none of the sorted `spans`."""
    kind_of = "array<struct<start:int,kind:int,end:int,ratio:double>>"

    def part(start: Column, end: Column) -> Column:
        one = F.array(F.struct(start.alias("start"), F.lit(3).alias("kind"), end.alias("end"), x["ratio"].alias("ratio")))
        return F.when(start < end, one).otherwise(F.array()).cast(kind_of)

    def cut(done: Column, b: Column) -> Column:
        return F.struct(
            F.greatest(done["at"], b["end"]).alias("at"),
            F.concat(done["parts"], part(done["at"], F.least(b["start"], x["end"]))).alias("parts"),
        )

    none = F.struct(x["start"].alias("at"), F.array().cast(kind_of).alias("parts"))
    met = F.filter(spans, lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"]))
    return F.aggregate(met, none, cut, lambda done: F.concat(done["parts"], part(done["at"], x["end"])))


def find(docs: DataFrame, ratios: list[float], id_col: str = "doc_id", text_col: str = "text", ratio: float = RATIO) -> DataFrame:
    """Per row: doc_id, h1, h2 and `found`, an array of (start, kind, end, ratio) by start and kind.

    Places count code points, the end is exclusive, kinds are numbers into KINDS. A run is scored whole, and if that is
    too low, by its parts between slashes, underscores and hyphens. Spans of the models never overlap base spans: what
    lies outside them is reported. A null text is empty. Rows equal in id and text get equal results; columns that are not named are not read.
    An empty table gives an empty result.
    """
    keys = ["doc_id", "h1", "h2"]
    text = F.coalesce(F.col(text_col), F.lit(""))
    every = F.concat(
        _matches(text, 0, ASSIGN, 2), _matches(text, 1, ACCESS), _matches(text, 2, HEX), _matches(text, 3, RUN),
        _matches(text, 4, PART),
    )
    rows = docs.select(*identity(id_col, text_col), every.alias("m")).filter(F.size("m") > 0).dropDuplicates(keys)
    rows = rows.select(*keys, F.inline("m"))
    end = F.sum(F.col("before") + F.col("size")).over(Window.partitionBy(*keys, "kind").orderBy("i"))
    placed = rows.withColumn("end", end.cast("int")).withColumn("start", (F.col("end") - F.col("size")).cast("int"))
    judged = placed.withColumn("ratio", F.when(F.col("kind") >= 3, mean_ratio(F.col("value"), ratios)))
    varied = F.size(F.array_distinct(F.split("value", ""))) >= VARIETY
    held = (
        ((F.col("kind") == 0) & (F.length("value") >= ASSIGNED))
        | F.col("kind").isin(1, 2)
        | ((F.col("kind") >= 3) & (F.col("ratio") >= ratio) & varied)
    )
    grouped = judged.filter(held).groupBy(*keys).agg(F.collect_list(F.struct("start", "kind", "end", "ratio")).alias("all"))
    overlaps = lambda x: lambda y: (y["start"] < x["end"]) & (x["start"] < y["end"])
    split = grouped.select(
        *keys, F.array_sort(F.filter("all", lambda x: x["kind"] < 3)).alias("base"),
        F.filter("all", lambda x: x["kind"] == 3).alias("whole"), F.filter("all", lambda x: x["kind"] == 4).alias("parts"),
    )
    more = F.concat("whole", F.filter("parts", lambda x: ~F.exists("whole", overlaps(x))))
    left = F.flatten(F.transform(more, lambda x: _outside(x, F.col("base"))))
    done = split.select(*keys, F.array_sort(F.concat("base", left)).alias("found"))
    return on_identity(docs.select(*identity(id_col, text_col)), done).select(
        *keys, F.coalesce("found", F.array().cast("array<struct<start:int,kind:int,end:int,ratio:double>>")).alias("found")
    )


def scan(spark: SparkSession, folder: str) -> DataFrame:
    """The registered query: models from the documents themselves, then all spans of every document."""
    docs = table(spark, folder, "documents")
    done = find(docs, transition_ratios(labelled_strings(docs)))
    names = F.array(*map(F.lit, KINDS))
    listed = lambda spans: F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"], x["end"])), ","
    )
    of = lambda k: F.size(F.filter("found", lambda x: x["kind"] == k)).cast("long")
    return done.select(
        "doc_id", of(0).alias("n_assign"), of(1).alias("n_access"), of(2).alias("n_hex"), of(3).alias("n_random"),
        F.sha2(listed(F.filter("found", lambda x: x["kind"] < 3)), 256).alias("base_sha256"), listed(F.col("found")).alias("spans"),
    )

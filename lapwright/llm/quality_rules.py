"""Operator 6: quality rules whose thresholds come from the documents of the same language and source.

Each measure of a document is a whole number. A group's sketch is the number of its documents per step of a scale that
is exact below 16 and has 16 steps per doubling above, so a quantile is off by a sixteenth at most. Sketches of two sets
are merged by adding counts: Spark builds them with partial sums per task. The thresholds of a source come from its own sketch
and the merged ones of its language and of everything, which weigh the less the more documents the source has.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, stored, table

BLANKS, SYMBOLS = " \t\n\v\f\r", "#*$%&|<>"
WINDOW = 8
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_echoes"]

# measure -> (numerator, factor, denominator, whether low values are judged, too)
MEASURES = {
    "word_length": ("word_chars", 100, "n_words", True),
    "symbol_share": ("n_symbols", 10_000, "word_chars", False),
    "copied_line_share": ("n_dup_lines", 10_000, "n_lines", False),
    "echo_share": ("n_echoes", 10_000, "n_words", False),
}
LEVELS = {"q10": 10, "q50": 50, "q90": 90}
REACH = 3  # a fence stands so many spreads beyond the outer quantile
NOISE = 3.0  # standard deviations of a count that a document is allowed
WEIGHT = 200  # documents that the wider sketch counts for beside a group's own


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows that occur twice or more. Windows get a class number by pairing classes of half the width."""
    n, numbers = len(words), {}
    ids = [numbers.setdefault(w, len(numbers)) for w in words]
    if n < WINDOW or len(numbers) == n:
        return 0
    classes, width = np.array(ids, dtype=np.int64), 1
    while width < WINDOW:
        pairs = classes[:-width] * (int(classes.max()) + 1) + classes[width:]
        distinct, classes = np.unique(pairs, return_inverse=True)
        if len(distinct) == len(pairs):
            return 0
        width *= 2
    starts = np.flatnonzero(np.bincount(classes)[classes] > 1)
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + WINDOW, -1)
    return int(np.count_nonzero(np.cumsum(edge[:-1])))


def measure(text: str) -> tuple[int, ...]:
    """COUNTS of a whole text; an echo is a word equal to the one before it."""
    words = text.encode("utf-8").split()  # splits bytes at the six blanks only
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    return (
        len(words),
        len(text) - sum(map(text.count, BLANKS)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        sum(map(eq, words, words[1:])),
    )


def counted(docs: DataFrame, id_col: str, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"),
        F.col(text_col).alias("text"),
    )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chain.from_iterable(map(slices, batches)):
            found = [measure(t or "") for t in batch.column(3).to_pylist()]
            columns = [pa.array(c, pa.int64()) for c in zip(*found)] if found else [pa.array([], pa.int64())] * len(COUNTS)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *columns], ["doc_id", "lang", "source", *COUNTS])

    kinds = dict(rows.dtypes)
    head = ", ".join(f"{c} {kinds[c]}" for c in ("doc_id", "lang", "source"))
    return rows.mapInArrow(task, head + "".join(f", {c} bigint" for c in COUNTS))


def step_of(value: Column) -> Column:
    """Step of the scale that holds a whole number."""
    shift = F.length(F.bin(value)) - 5
    return F.when(value < 16, value).otherwise(
        (shift + 1) * 16 + F.floor(value / F.pow(F.lit(2.0), shift)).cast("long") - 16
    )


def step_start(step: Column) -> Column:
    """Smallest number on a step."""
    return F.when(step < 32, step).otherwise(
        ((step % 16 + 16) * F.pow(F.lit(2.0), F.floor(step / 16) - 1)).cast("long")
    )


def sketches(measured: DataFrame, groups: list[str]) -> DataFrame:
    """Documents per step, measure and group."""
    long = measured.select(
        *groups, F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).alias("v")) for m in MEASURES])).alias("x")
    ).select(*groups, "x.measure", step_of(F.col("x.v")).alias("step"))
    return long.groupBy(*groups, "measure", "step").agg(F.count("*").alias("n"))


def levels(sketch: DataFrame, groups: list[str]) -> DataFrame:
    """docs, the quantiles of LEVELS and the mean distance from the median, per measure and group.

    Each group has a few hundred steps at most, so one task can order them.
    """
    keys = [*groups, "measure"]
    steps = F.sort_array(F.collect_list(F.struct("step", "n")))
    grouped = sketch.groupBy(*keys).agg(F.sum("n").alias("docs"), steps.alias("steps"))

    def at(percent: int) -> Column:
        """Start of the first step with at least that percentage of the documents at or below it."""
        walk = F.aggregate(
            "steps",
            F.struct(F.lit(0).cast("long").alias("below"), F.lit(None).cast("long").alias("step")),
            lambda a, s: F.struct(
                (a["below"] + s["n"]).alias("below"),
                F.coalesce(
                    a["step"], F.when((a["below"] + s["n"]) * 100 >= F.col("docs") * percent, s["step"].cast("long"))
                ).alias("step"),
            ),
        )
        return step_start(walk["step"])

    found = grouped.select(*keys, "docs", "steps", *[at(p).alias(q) for q, p in LEVELS.items()])
    distance = F.aggregate(
        "steps", F.lit(0.0), lambda a, s: a + s["n"].cast("double") * F.abs(step_start(s["step"].cast("long")) - F.col("q50"))
    )
    return found.select(*keys, "docs", *LEVELS, F.floor(distance / F.col("docs")).cast("long").alias("off"))


def fences(measured: DataFrame, weight: int = WEIGHT) -> DataFrame:
    """Per language and source: low and high fence of every measure.

    Quantiles of a source are drawn towards those of its language, and these towards those of all documents, as if the wider set
    had added `weight` documents. The spread is the distance from the median to the outer quantile or the mean distance from the median,
    whichever is larger; most documents may share one value. The high fence of a share is never beyond the middle between
    the median and the whole, so that a source in which many documents are bad still has one. Only word lengths have a low fence.
    """
    figures = [*LEVELS, "off"]
    by_source = sketches(measured, ["lang", "source"])
    merged = lambda keys: by_source.groupBy(*keys, "measure", "step").agg(F.sum("n").alias("n"))
    own = levels(by_source, ["lang", "source"])
    of_lang = levels(merged(["lang"]), ["lang"]).select(
        F.col("lang").alias("l"), F.col("measure").alias("lm"), *[F.col(c).alias(f"l_{c}") for c in ("docs", *figures)]
    )
    of_all = levels(merged([]), []).select(F.col("measure").alias("am"), *[F.col(c).alias(f"a_{c}") for c in figures])
    joined = own.join(of_lang, own["lang"].eqNullSafe(of_lang["l"]) & (own["measure"] == of_lang["lm"])).join(
        of_all, own["measure"] == of_all["am"]
    )

    def drawn(docs: str, figure: str, towards: str) -> Column:
        n = F.col(docs).cast("double")
        return F.floor((n * F.col(figure) + weight * F.col(towards)) / (n + weight)).cast("long")

    of_language = joined.withColumns({f"l_{c}": drawn("l_docs", f"l_{c}", f"a_{c}") for c in figures})
    final = of_language.withColumns({c: drawn("docs", c, f"l_{c}") for c in figures})
    both_sides = F.col("measure").isin([m for m, v in MEASURES.items() if v[3]])
    high = F.col("q90") + REACH * F.greatest(F.col("q90") - F.col("q50"), F.col("off"))
    low = F.col("q10") - REACH * F.greatest(F.col("q50") - F.col("q10"), F.col("off"))
    bound = F.expr("(q50 + 10000) div 2")
    return (
        final.select(
            "lang", "source", "measure", F.when(both_sides, low).alias("low"),
            F.when(both_sides, high).otherwise(F.least(high, bound)).alias("high"),
        )
        .groupBy("lang", "source")
        .agg(F.map_from_entries(F.collect_list(F.struct("measure", F.struct("low", "high")))).alias("fence"))
    )


def outside(measure: str) -> Column:
    """Whether a document's count is beyond a fence by more than the noise of a count of that size."""
    count, factor, size, _ = MEASURES[measure]
    n, slack = F.col(count).cast("double"), NOISE * F.sqrt(F.col(count).cast("double"))
    at = lambda side: F.col("fence")[measure][side] * F.col(size).cast("double") / float(factor)
    return (F.col(size) > 0) & ((n - slack > at("high")) | F.coalesce(n + slack < at("low"), F.lit(False)))


def judge(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
    weight: int = WEIGHT,
) -> DataFrame:
    """Per row: the counts, `base_failed`, the measures, `failed` (names of measures outside their fences) and `kept`.

    A document is judged by the end of its count's range of noise that lies nearer to the group, so one symbol or one copied
    line never decides. Very long texts are counted whole. A null text has no words and fails the base rules. A null language or source is a group of its own. Repeated rows
    are judged, and counted in the sketches, one by one. Other columns of the input are not read. An empty table gives an
    empty result.
    """
    counts = counted(docs, id_col, text_col, lang_col, source_col)
    ratio = lambda a, f, b: F.expr(f"case when {b} = 0 then 0 else ({f} * {a}) div {b} end")
    measured = stored(counts.withColumns({m: ratio(*v[:3]) for m, v in MEASURES.items()}))
    limits = fences(measured, weight)
    met = measured.join(
        limits.select(F.col("lang").alias("l"), F.col("source").alias("s"), "fence"),
        measured["lang"].eqNullSafe(F.col("l")) & measured["source"].eqNullSafe(F.col("s")),
    ).drop("l", "s")
    base = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return (
        met.withColumn("base_failed", base)
        .withColumn("failed", F.concat_ws(",", *[F.when(outside(m), F.lit(m)) for m in MEASURES]))
        .withColumn("kept", ~F.col("base_failed") & (F.col("failed") == ""))
        .drop("fence")
    )


def verdicts(spark: SparkSession, folder: str) -> DataFrame:
    """The registered query."""
    done = judge(table(spark, folder, "documents"))
    return done.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed"
    )

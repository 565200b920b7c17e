"""Operator 4: later copies of repeated runs of lines. DataFrame functions only.

Documents are sequences of line numbers, and their suffixes are sorted by prefix doubling: a suffix starts with the rank
of its first line; ranks by 2k lines come from sorting pairs (rank by k lines, rank by k lines of the suffix k lines
on). The rank of a suffix is the number of suffixes that sort before it, so it is a place in the suffix array, and the
suffixes with a prefix of m lines in common are one interval of it. Doubling stops when intervals are as deep as the
shortest run that counts: `MIN_WORDS` words, at most so many lines, as lines without a word are left out.

A run of lines is deleted where it has that many words and the same run starts somewhere earlier, in another document or
in the same one. Longer repeats are the union of the runs that start at each of their lines.

Before sorting, lines that occur once and stretches of repeated lines with too few words are left out; no run can cross
or lie in them. Ranks are counted per distinct pair, in sections of the value range, so neither a hot line nor a hot pair
puts its rows into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import discard, identity, shuffled, stored, table, whole_text

MIN_WORDS = 50
SECTIONS = 4096
WORD = r"[^\x20\x09-\x0D]+"
# Of a line that is words with single blanks between, and no other one, the blanks tell the words.
UNEVEN = r"[\x09-\x0D]|\x20\x20|^\x20|\x20$"
KEYS = ["doc_id", "h1", "h2"]


def words_in(line: Column) -> Column:
    """Number of words of a line that has some; the pattern, which is slow, is for lines with other blanks."""
    return F.when(line.rlike(UNEVEN), F.regexp_count(line, F.lit(WORD))).otherwise(F.size(F.split(line, " ", -1)))


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Lines with a word, of distinct documents: keys, i (number among these), pos (number among all), words, a, b (hashes).

    Words and hashes are taken row by row, where Spark compiles them; functions inside arrays are interpreted.
    """
    text = whole_text(text_col)
    numbered = F.filter(
        F.transform(F.split(text, "\n", -1), lambda x, p: F.struct(p.alias("pos"), x.alias("line"))),
        lambda x: x["line"].rlike(r"[^\x20\x09-\x0D]"),
    )
    # A plain explode has Spark test the array beforehand, and so make it once more for each test.
    rows = docs.select(*identity(id_col, text_col), numbered.alias("l")).select(*KEYS, F.posexplode_outer("l").alias("i", "x"))
    line = F.col("x.line")
    return rows.where(F.col("x").isNotNull()).select(
        *KEYS, "i", "x.pos", words_in(line).alias("words"), F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b")
    )


def _candidates(lines: DataFrame, min_words: int) -> DataFrame:
    """Lines in stretches of repeated lines with enough words, with `block`, the number of the stretch."""
    repeated = lines.groupBy("a", "b").agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    some = lines.join(shuffled(repeated), ["a", "b"]).dropDuplicates([*KEYS, "i"])  # rows that repeat a document are one
    in_doc = Window.partitionBy(*KEYS).orderBy("i")
    blocks = some.withColumn("block", F.col("i") - F.row_number().over(in_doc))
    total = F.sum("words").over(Window.partitionBy(*KEYS, "block"))
    return blocks.withColumn("total", total).filter(F.col("total") >= min_words).drop("total")


def _refined(rows: DataFrame, by: str, section: Column) -> DataFrame:
    """Replace `rank` by the rank after sorting on (rank, by): the old rank plus the rows of its class with a smaller `by`."""
    pairs = rows.groupBy("rank", by).agg(F.count("*").alias("n")).withColumn("section", section)
    sums = pairs.groupBy("rank", "section").agg(F.sum("n").alias("s"))
    before = Window.partitionBy("rank").orderBy("section").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("rank", "section", F.coalesce(F.sum("s").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("rank", "section").orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    ranked = pairs.join(shuffled(offsets), ["rank", "section"]).select(
        "rank", by, (F.col("rank") + F.col("offset") + F.coalesce(F.sum("n").over(inside), F.lit(0))).alias("next"),
    )
    return rows.join(shuffled(ranked), ["rank", by]).drop("rank", by).withColumnRenamed("next", "rank")


def suffix_ranks(
    rows: DataFrame, depth: int, keys: list[str], hashes: list[str], every_level: bool = True
) -> DataFrame:
    """Add r0, r1, ..: ranks of the suffixes of sequences by their first 1, 2, 4, .. elements, up to `depth` elements.

    Without `every_level` only the last is added, as `rank`. Rows are elements: `keys` name their sequence, i is their number in it, and `hashes` (64-bit) say which are equal.
    """
    now = rows.withColumn("rank", F.lit(1).cast("long"))
    for h in hashes:
        now = _refined(now, h, F.shiftright(h, 52))
    now = stored(now.withColumn("r0", F.col("rank")) if every_level else now)
    width = max(1, -(-(now.count() + 1) // SECTIONS))
    in_order = Window.partitionBy(*keys).orderBy("i")
    level, length = 0, 1
    while 2 * length <= depth:
        # Past the end of a sequence stands 0, which sorts before every rank.
        ahead = now.withColumn("ahead", F.coalesce(F.lead("rank", length).over(in_order), F.lit(0).cast("long")))
        level, length = level + 1, 2 * length
        finer = _refined(ahead, "ahead", F.expr(f"ahead div {width}"))
        next_ = stored(finer.withColumn(f"r{level}", F.col("rank")) if every_level else finer)
        discard(now)
        now = next_
    return now.drop("rank") if every_level else now


def _starts(rows: DataFrame, min_words: int) -> DataFrame:
    """Runs that decide: i and len. At each line the shortest run with enough words, and longer ones whose rest is too short.

    A longer run whose rest has enough words is the union of this line's shortest run and of runs at the next line.
    """
    block = Window.partitionBy(*KEYS, "block")
    upto = F.sum("words").over(block.orderBy("i"))
    sums = rows.withColumn("before", upto - F.col("words")).withColumn("total", F.sum("words").over(block))
    # Lines that begin within min_words words from here: exactly those of the shortest run.
    least = F.count("*").over(block.orderBy("before").rangeBetween(Window.currentRow, min_words - 1)).cast("int")
    # From the next line: so many lines have just enough words, or all that are left have too few.
    rest_is_short = F.col("total") - F.col("before") - F.col("words") < min_words
    next_ = F.lead("least").over(block.orderBy("before")) + rest_is_short.cast("int")
    runs = sums.withColumn("least", least).withColumn("next", next_)
    runs = runs.filter(F.col("total") - F.col("before") >= min_words)
    return runs.withColumn(
        "len", F.explode(F.sequence("least", F.greatest("least", F.coalesce("next", "least"))))
    ).drop("before", "total", "least", "next")


def removed_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """Per distinct document with a deletion (`identity`): `removed`, an array of (first, last) line numbers from 0."""
    lines = stored(_lines(docs, id_col, text_col))  # counted first, then joined: the texts are read once
    rows = stored(_candidates(lines, min_words))
    discard(lines)
    ranks = suffix_ranks(rows, min_words, [*KEYS, "block"], ["a", "b"])
    levels = [c for c in ranks.columns if c.startswith("r") and c[1:].isdigit()]

    def of_level(k: Column) -> Column:
        return F.element_at(F.array(*levels), k + 1)

    runs = _starts(ranks, min_words).withColumn("k", F.length(F.bin("len")) - 1)
    runs = runs.select(
        *KEYS, "block", "i", "len", "k", of_level(F.col("k")).alias("head"),
        (F.col("i") + F.col("len") - F.expr("shiftleft(1, k)").cast("int")).alias("j"),
    )
    # A run of len lines is named by the ranks of its first and its last 2^k lines, which overlap or touch.
    tails = ranks.select(
        *[F.col(c).alias(f"t_{c}") for c in KEYS], F.col("i").alias("j"),
        F.posexplode(F.array(*levels)).alias("k", "tail"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("t_doc_id")) & (F.col("h1") == F.col("t_h1")) & (F.col("h2") == F.col("t_h2"))
    named = stored(
        runs.withColumnsRenamed({"j": "rj", "k": "rk"})
        .join(shuffled(tails), same & (F.col("rj") == F.col("j")) & (F.col("rk") == F.col("k")))
        .select(*KEYS, "i", "len", "head", "tail")
    )
    place = F.struct(F.col("doc_id").isNull().alias("z"), *[F.col(c) for c in KEYS], F.col("i"))
    first = named.groupBy("len", "head", "tail").agg(F.min(place).alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    copies = named.join(shuffled(first), ["len", "head", "tail"]).filter(place > F.col("first")).groupBy(*KEYS, "i").agg(
        (F.col("i") + F.max("len")).alias("end")
    )
    in_doc = Window.partitionBy(*KEYS).orderBy("i")
    reached = F.max("end").over(in_doc.rowsBetween(Window.unboundedPreceding, -1))
    islands = copies.withColumn("new", (F.col("i") > F.coalesce(reached, F.lit(-1))).cast("int")).withColumn(
        "island", F.sum("new").over(in_doc)
    ).groupBy(*KEYS, "island").agg(F.min("i").alias("i"), (F.max("end") - 1).alias("last"))
    numbers = rows.select(*[F.col(c).alias(f"t_{c}") for c in KEYS], F.col("i").alias("li"), "pos")
    ends = islands.select(*KEYS, "island", F.explode(F.array("i", "last")).alias("at"))
    ranges = ends.join(shuffled(numbers), same & (F.col("at") == F.col("li"))).groupBy(*KEYS, "island").agg(
        F.struct(F.min("pos").alias("first"), F.max("pos").alias("last")).alias("x")
    )
    return stored(ranges.groupBy(*KEYS).agg(F.sort_array(F.collect_list("x")).alias("removed")))


def deduplicate(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """All rows and columns of `docs`, the text without its deleted lines; and `removed`, the array of their ranges.

    The earlier copy is that with the smaller id (null ids last, then by text hashes), then the earlier line. Rows equal
    in id and text are one document and get the same result. Lines without a word count for nothing and go where they
    lie between deleted ones. A null text stays null. A text of one very long line is one line. Columns may have any
    name; a column `removed` is replaced. An empty table gives an empty one.
    """
    runs = removed_runs(docs, id_col, text_col, min_words)
    mine, other = [f"line {c}" for c in KEYS], [f"run {c}" for c in KEYS]
    keyed = docs.drop("removed").select("*", *[c.alias(n) for c, n in zip(identity(id_col, text_col), mine)])
    same = F.col(f"`{mine[0]}`").eqNullSafe(F.col(f"`{other[0]}`"))
    for m, o in zip(mine[1:], other[1:]):
        same = same & (F.col(f"`{m}`") == F.col(f"`{o}`"))
    # Both sides are shuffled at any size: broadcasting would hold only while few documents have copied lines.
    met = keyed.join(shuffled(runs.toDF(*other, "removed")), same, "left").drop(*mine, *other)
    kept = F.filter(
        F.split(F.col(f"`{text_col}`"), "\n", -1),
        lambda x, p: ~F.exists(F.col("removed"), lambda r: p.between(r["first"], r["last"])),
    )
    none = F.array().cast("array<struct<first:int,last:int>>")
    return met.withColumn(text_col, F.when(F.col("removed").isNull(), F.col(f"`{text_col}`")).otherwise(F.array_join(kept, "\n"))).withColumn(
        "removed", F.coalesce("removed", none)
    )


def report(spark: SparkSession, folder: str) -> DataFrame:
    """The registered query: the text that is left of every document, and which of its lines are gone."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    done = deduplicate(docs)
    return done.select(
        "doc_id",
        F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["last"] - r["first"] + 1).alias("n_removed"),
        F.array_join(F.transform("removed", lambda r: F.concat_ws("-", r["first"], r["last"])), ",").alias("removed"),
        F.coalesce("text", F.lit("")).alias("text"),
    )

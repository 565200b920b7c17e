"""Operator 8: main text of web pages.

A page is read as blocks of tokens (see `page_blocks`). Blocks of menus, headers, footers, sidebars, notices, adverts, forms
and comments are never text. All others are judged by the other pages of their host, those inside an article or main element too:
the runs of such blocks, with an element for every block end, are sequences whose suffixes are sorted by prefix doubling
(see `line_dedup.suffix_ranks`), and a stretch of `REPEATED` elements is boilerplate if a share of the host's pages has it.
Pages with the same text count once, so copies of a page do not vanish. What an article or main element encloses is
boilerplate only if a larger share of the host's articles has it inside.

Before sorting, elements are left out that lie in no stretch with enough pages: every stretch falls into one of `BUCKETS`
buckets of its host, and the number of pages in a bucket is at least that of each of its stretches.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import discard, slices, stored, table
from .line_dedup import suffix_ranks
from .page_blocks import ARTICLE_ZONE, CHROME_ZONE, OPEN_ZONE, read_blocks

REPEATED = 6  # elements in a row, tokens and block ends, that make boilerplate if enough pages of the host have them
LEAST = 3  # so many different pages at least,
SHARE, ARTICLE_SHARE = 0.25, 0.5  # and such a share of the host's different pages, or inside articles of its different articles

BUCKETS, PARTS = 1 << 14, 16
HOSTS = 128  # whose buckets a task holds at a time

END = 1  # stands for the end of a block among the numbers of tokens


def read_page(page: str) -> tuple[str | None, list[tuple[str, bool]]]:
    """The text inside articles (None if the page has no article), and the tokens outside with whether they may be text."""
    found, blocks = read_blocks(page)
    main = [t for zone, tokens in blocks if zone == ARTICLE_ZONE for t in tokens]
    outside = [(t, zone == OPEN_ZONE) for zone, tokens in blocks if zone != ARTICLE_ZONE for t in tokens]
    return (" ".join(main) if found else None), outside


def runs(blocks: list[tuple[int, list[str]]]) -> list[tuple[int, list[str | None]]]:
    """Neighbouring blocks of one zone as one sequence of tokens, with None before, between and after blocks."""
    found: list[tuple[int, list[str | None]]] = []
    last = CHROME_ZONE
    for zone, tokens in blocks:
        if zone != CHROME_ZONE:
            if zone != last:
                found.append((zone, [None]))
            found[-1][1].extend(tokens)
            found[-1][1].append(None)
        last = zone
    return found


@lru_cache(1 << 16)
def number(token: str | None) -> int:
    return END if token is None else xxhash.xxh64_intdigest(token)


def numbers(elements: list[str | None]) -> np.ndarray:
    return np.fromiter(map(number, elements), np.uint64, len(elements))


def buckets(of: np.ndarray, repeated: int) -> np.ndarray:
    """The bucket of the stretch that starts at each element."""
    n = max(0, len(of) - repeated + 1)
    mixed = np.zeros(n, np.uint64)
    for k in range(repeated):
        mixed = (mixed ^ of[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return (mixed % np.uint64(BUCKETS)).astype(np.int64)


def content(sequences: list[tuple[int, np.ndarray]]) -> int:
    """A hash of all that is judged on a page, odd if it has an article."""
    h = xxhash.xxh64()
    for zone, of in sequences:
        h.update(bytes([zone]) + of.tobytes() + b"|")
    return h.intdigest() >> 2 << 1 | any(zone == ARTICLE_ZONE for zone, _ in sequences)


def sequences_of(page: str | None) -> list[tuple[int, np.ndarray]]:
    return [(zone, numbers(elements)) for zone, elements in runs(read_blocks(page or "")[1])]


def counted(rows: DataFrame, repeated: int) -> DataFrame:
    """host, part, keys and counts: how many pages of a host have a stretch in a bucket, and (part -1) what contents it has."""

    def flush(counts: dict[int, np.ndarray], contents: dict[int, set[int]]) -> pa.RecordBatch:
        found = [(h, -1, pa.array(c, pa.int64()), np.ones(len(c), np.int32)) for h, c in ((h, sorted(c)) for h, c in contents.items())]
        width = BUCKETS // PARTS
        for h, c in counts.items():
            for p in range(PARTS):
                at = np.flatnonzero(c[p * width : (p + 1) * width]) + p * width
                if len(at):
                    found.append((h, p, at, c[at]))
        counts.clear(), contents.clear()
        columns = zip(*found) if found else [[]] * 4
        types = [pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32())]
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], ["host", "part", "keys", "counts"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, np.ndarray] = {}
        contents: dict[int, set[int]] = defaultdict(set)
        for batch in chain.from_iterable(map(slices, batches)):
            for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
                sequences = sequences_of(page)
                if not sequences or (c := content(sequences)) in contents[host]:
                    continue
                contents[host].add(c)
                if host not in counts:
                    counts[host] = np.zeros(BUCKETS, np.int32)
                # An index that occurs twice adds one.
                counts[host][np.concatenate([buckets(of, repeated) for _, of in sequences])] += 1
                if len(counts) >= HOSTS:
                    yield flush(counts, contents)
        yield flush(counts, contents)

    return rows.select("host", "html").mapInArrow(task, "host long, part int, keys array<long>, counts array<int>")


def frequent(counts: DataFrame) -> DataFrame:
    """host, how many pages make boilerplate outside and inside articles, and the bitmap of buckets that have as many."""
    contents = counts.filter("part < 0").select("host", F.explode("keys").alias("key")).distinct()
    pages = contents.groupBy("host").agg(F.count("*").alias("pages"), F.sum(F.col("key").bitwiseAND(1)).alias("articles"))

    def least(share: float, n: str) -> Column:
        return F.greatest(F.lit(LEAST).cast("long"), F.ceil(F.col(n) * share))

    limits = pages.filter(F.col("pages") >= LEAST).select(
        "host", least(SHARE, "pages").alias("outside"), least(ARTICLE_SHARE, "articles").alias("inside")
    )
    dealt = counts.filter("part >= 0").repartition("host", "part")
    one = dealt.select("host", "part", F.explode(F.arrays_zip("keys", "counts")).alias("x")).select("host", "part", "x.*")
    sums = one.groupBy("host", "part", F.col("keys").alias("bucket")).agg(F.sum("counts").alias("n"))
    many = sums.join(limits, "host").filter(F.col("n") >= F.least("outside", "inside"))
    return many.groupBy("host", "outside", "inside").agg(F.bitmap_construct_agg("bucket").alias("bitmap"))


PAGE = ["host", "k1", "k2"]


def candidates(rows: DataFrame, hot: DataFrame, repeated: int) -> DataFrame:
    """Elements in stretches of frequent buckets: page, its content, seg and i (numbers in the page), inside (an article), a (hash)."""
    names = [*PAGE, "content", "seg", "i", "inside", "a"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chain.from_iterable(map(slices, batches)):
            keys, found = [batch.column(c).to_pylist() for c in PAGE], []
            for *key, page, bitmap in zip(*keys, batch.column("html").to_pylist(), batch.column("bitmap").to_pylist()):
                often = np.unpackbits(np.frombuffer(bitmap, np.uint8), bitorder="little")
                sequences, first, seg = sequences_of(page), 0, 0
                for zone, of in sequences:
                    starts = np.flatnonzero(often[buckets(of, repeated)])
                    near = np.zeros(len(of) + 1, bool)
                    for k in range(repeated if len(starts) else 0):
                        near[starts + k] = True
                    i = np.flatnonzero(near)
                    if len(i):
                        segs = seg + np.cumsum(np.diff(i, prepend=i[0] - 2) > 1)
                        seg = int(segs[-1])
                        ids = [np.full(len(i), k, np.int64) for k in (*key, content(sequences))]
                        found.append((*ids, segs, first + i, np.full(len(i), zone == ARTICLE_ZONE), of[i].view(np.int64)))
                    first += len(of)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found)], names)

    kinds = "host long, k1 long, k2 long, content long, seg long, i long, inside boolean, a long"
    some = rows.select(*PAGE, "html").join(hot.select("host", "bitmap"), "host").select(*PAGE, "html", "bitmap").mapInArrow(task, kinds)
    return some.dropDuplicates([*PAGE, "i"]).withColumn("a", F.xxhash64("host", "a"))  # rows that repeat a page are one


def boilerplate(ranks: DataFrame, hot: DataFrame, repeated: int) -> DataFrame:
    """Per page with boilerplate: `starts`, numbers of the elements at which such a stretch begins."""
    level = repeated.bit_length() - 1
    in_seg = Window.partitionBy(*PAGE, "seg").orderBy("i")
    # A stretch is named by the ranks of its first and its last 2^level elements.
    named = ranks.select(
        *PAGE, "i", "content", "inside", F.col("rank").alias("head"),
        F.lead("rank", repeated - (1 << level)).over(in_seg).alias("tail"), F.lead("i", repeated - 1).over(in_seg).alias("last"),
    ).filter("last is not null")
    stretch = ["host", "head", "tail"]
    votes = named.groupBy(*stretch, "content").agg(F.max("inside").cast("int").alias("article"))
    votes = votes.groupBy(*stretch).agg(F.count("*").alias("pages"), F.sum("article").alias("articles"))
    passed = votes.join(hot.select("host", "outside", F.col("inside").alias("within")), "host").select(
        *stretch, (F.col("pages") >= F.col("outside")).alias("anywhere"), (F.col("articles") >= F.col("within")).alias("articles")
    )
    gone = named.join(passed.filter("anywhere or articles"), stretch).filter("if(inside, articles, anywhere)")
    return gone.groupBy(*PAGE).agg(F.collect_set("i").alias("starts"))


def left_text(page: str | None, starts: list[int] | None, repeated: int) -> str:
    """The tokens outside chrome that lie in no stretch of boilerplate.

    A block of which fewer than `repeated` tokens are reached from a neighbouring block keeps them: its first or last
    words are equal by chance.
    """
    gone = {k for i in starts or () for k in range(i, i + repeated)}
    left: list[str] = []
    at = 0  # number of the element
    for _, elements in runs(read_blocks(page or "")[1]):
        if not gone:
            left.extend(e for e in elements if e is not None)
            continue
        ends = [i for i, e in enumerate(elements) if e is None]
        for begin, end in zip(ends, ends[1:]):
            for is_gone, part in groupby(range(begin + 1, end), lambda i: at + i in gone):  # noqa: B023
                places = list(part)
                if not is_gone or len(places) < min(repeated, end - begin - 1):
                    left.extend(elements[places[0] : places[-1] + 1])
        at += len(elements)
    return " ".join(left)


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", repeated: int = REPEATED
) -> DataFrame:
    """Per row: page_id, url and text, the blocks of the page joined by single blanks.

    A null or empty html has an empty text, and a page keeps what is neither chrome nor repeated on its host; a null url
    is a host of its own kind, shared by all such pages. Rows with equal host and html get the same text and count as one
    page. Very long pages are read whole, in time linear in their length. Columns that are not named are not read. An empty table gives an empty result.
    """
    address = F.lower(F.coalesce(F.col(url_col), F.lit("")))
    host = F.regexp_extract(address, r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    page = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), page.alias("html"), F.xxhash64(host).alias("host"),
        F.xxhash64(page).alias("k1"), F.xxhash64(F.lit(1), page).alias("k2"),
    )
    # Pages are read three times and never stored: for the counts, for the vote and for their text.
    counts = stored(counted(rows, repeated))
    hot = stored(frequent(counts))
    some = stored(candidates(rows, hot, repeated))
    ranks = suffix_ranks(some, repeated, [*PAGE, "seg"], ["a"], every_level=False)
    voted = stored(boilerplate(ranks, hot, repeated))
    discard(counts, hot, some, ranks)
    kind = dict(rows.dtypes)["page_id"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chain.from_iterable(map(slices, batches)):
            both = zip(batch.column("html").to_pylist(), batch.column("starts").to_pylist())
            left = pa.array([left_text(h, s, repeated) for h, s in both], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), left], ["page_id", "url", "text"])

    met = rows.join(voted, PAGE, "left").select("page_id", "url", "html", "starts")
    return met.mapInArrow(task, f"page_id {kind}, url string, text string")


def texts(spark: SparkSession, folder: str) -> DataFrame:
    """The registered query."""
    done = extract(table(spark, folder, "pages"))
    return done.withColumn("n_chars", F.length("text").cast("long"))

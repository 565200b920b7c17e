"""Operator 12: URL filters by rules, and by character language models where no rule fits. DataFrame functions only.

URLs that a rule decides are the examples: two variable-order Markov models, of accepted and of rejected URLs, are
counted over all of them. A context is the longest seen string of up to ORDER characters before a character, and all contexts
are kept, however many. Probabilities of longer contexts are smoothed by those of shorter ones (Witten and Bell).
Both models share their contexts, which make one stored table with the characters after each. The log-likelihood ratio of a character
depends on it and the ORDER characters before it: it is worked out once for each such string of the URLs, in joins with that table
that go from one character to ORDER + 1, and met by all places where the string occurs. Nothing of this passes through the driver.

A URL is accepted if its mean log-likelihood ratio per character reaches a cut, which is calibrated on a fifth of the
examples that the models have not seen.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, shuffled, stored, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALPHABET = LOWER + "0/.-_%~?"  # 0 stands for all digits, ? for all other characters
ORDER = 5
# Of a model that is to fit into one expression: its contexts, and how often each is seen at least. The registered query keeps all.
CONTEXTS, SEEN = 1024, 4
FOLDS = 5
STEP = 1000  # calibration counts scores in steps of a thousandth
EXACT = 1_000_000  # log ratios are summed in whole millionths, whose sum does not depend on the order

# Host and path of every rule, and its verdict. Fixed values.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path of a URL; both are empty where there is no `://`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """The longest rule that fits, of equal ones the first; null where none does."""
    found = F.lit(None).cast("string")
    for text, _ in sorted(rules, key=lambda r: len(r[0])):
        of, slash, rest = text.partition("/")
        fits = ((host == of) | host.endswith(f".{of}")) & path.startswith(slash + rest)
        found = F.when(fits, F.lit(text)).otherwise(found)
    return found


def reading(host: Column, path: Column) -> Column:
    """What the models read: host and path in the characters of the alphabet."""
    plain = F.translate(F.translate(F.concat(host, path), UPPER, LOWER), "123456789", "0" * 9)
    return F.regexp_replace(plain, r"[^a-z0/.\-_%~]", "?")


@dataclass(frozen=True)
class Counts:
    """A model of all contexts: `facts` has per context its examples and different next characters, of both kinds, and `next`.

    `next` has per character how often it follows. A row has at most as many characters as the alphabet.
    """

    facts: DataFrame

    def with_ratio(self, rows: DataFrame) -> DataFrame:
        """Add to rows with `text` the mean log-likelihood ratio of its characters, accepted to rejected; 0 where there are none."""
        texts = stored(rows.select("text").distinct().select(F.monotonically_increasing_id().alias("id"), "text"))
        read = texts.select("id", F.explode(_ends("text")).alias("s"))
        strings = stored(read.select("s").distinct())
        ratios = stored(self._ratios(strings))
        sums = read.join(shuffled(ratios), "s").groupBy("id").agg(F.sum("step").alias("sum"))
        mean = F.coalesce(F.col("sum") / F.lit(float(EXACT)) / F.length("text"), F.lit(0.0))
        means = stored(texts.join(shuffled(sums), "id", "left").select(F.col("text").alias("of"), mean.alias("ratio")))
        done = stored(rows.join(shuffled(means), F.col("text") == F.col("of")).drop("of"))
        discard(texts, strings, ratios, means)
        return done

    def _ratios(self, strings: DataFrame) -> DataFrame:
        """s, step: log-likelihood ratio of the last character of a string after the others, in millionths.

        Goes from the last character to longer strings, so that a string meets one context and the string without its first
        character, and neither meets more strings than the alphabet has characters.
        """
        done: list[DataFrame] = []
        for n in range(1, ORDER + 2):
            ends = strings.filter(F.length("s") >= n).select(F.expr(f"right(s, {n})").alias("s")).distinct()
            ends = ends.select("s", F.expr(f"left(s, {n - 1})").alias("context"), F.expr("right(s, 1)").alias("c"), F.expr("substring(s, 2)").alias("rest"))
            met = ends.join(shuffled(self.facts.filter(F.length("context") == n - 1)), "context", "left")
            if done:
                met = met.join(shuffled(done[-1].select(F.col("s").alias("rest"), "good", "bad")), "rest")
            else:
                met = met.withColumns({kind: F.lit(1 / len(ALPHABET)) for kind in ("good", "bad")})
            found = F.try_element_at("next", F.col("c"))
            smoothed = [
                F.when(
                    F.col(f"{kind}_n") > 0,
                    (F.coalesce(found[kind], F.lit(0)) + F.col(f"{kind}_kinds") * F.col(kind)) / (F.col(f"{kind}_n") + F.col(f"{kind}_kinds")),
                ).otherwise(F.col(kind)).alias(kind)
                for kind in ("good", "bad")
            ]
            done.append(stored(met.select("s", *smoothed)))
        step = F.round(F.log(F.col("good") / F.col("bad")) * EXACT).cast("long")
        ratios = stored(reduce(DataFrame.unionByName, done).select("s", step.alias("step")))
        discard(*done)
        return ratios

    def discard(self) -> None:
        discard(self.facts)


def _ends(text: str) -> Column:
    """For every character of a text, it and the up to ORDER characters before it."""
    first = F.transform(F.sequence(F.lit(1), F.least(F.length(text), F.lit(ORDER))), lambda n: F.left(F.col(text), n))
    others = F.regexp_extract_all(text, F.lit(f"(?=(.{{{ORDER + 1}}}))"), F.lit(1))
    return F.when(F.length(text) > 0, F.concat(first, others)).otherwise(F.array().cast("array<string>"))


@dataclass(frozen=True)
class Model:
    """Per context and character, row by row of the alphabet: the next context and the log-likelihood ratio."""

    moves: list[int]
    ratios: list[float]

    def mean_ratio(self, text: Column) -> Column:
        """Mean log-likelihood ratio of the characters, accepted to rejected; 0 where there are none."""
        moves = F.split(F.lit(",".join(map(str, self.moves))), ",").cast("array<int>")
        ratios = F.split(F.lit(",".join(f"{r:.6f}" for r in self.ratios)), ",").cast("array<double>")

        def step(done: Column, c: Column) -> Column:
            at = done["at"] * len(ALPHABET) + F.instr(F.lit(ALPHABET), c)
            return F.struct(F.element_at(moves, at).alias("at"), (done["sum"] + F.element_at(ratios, at)).alias("sum"))

        characters = F.regexp_extract_all(text, F.lit("."), F.lit(0))
        total = F.aggregate(characters, F.struct(F.lit(0).alias("at"), F.lit(0.0).alias("sum")), step, lambda done: done["sum"])
        return F.when(F.length(text) > 0, total / F.length(text)).otherwise(F.lit(0.0))

    def with_ratio(self, rows: DataFrame) -> DataFrame:
        """Add the mean log-likelihood ratio of `text`."""
        return rows.withColumn("ratio", self.mean_ratio(F.col("text")))

    def discard(self) -> None:
        """Nothing is stored."""


def transitions(examples: DataFrame) -> DataFrame:
    """context, c, accepted, rejected: how often a character follows each context of up to ORDER characters.

    `examples` has text, good and n. Equal strings of ORDER + 1 characters are counted before they are cut into contexts.
    """
    windows = examples.select("good", "n", F.explode(F.regexp_extract_all("text", F.lit(f"(?=(.{{1,{ORDER + 1}}}))"), F.lit(1))).alias("w"))
    counted = windows.groupBy("w").agg(
        F.sum(F.when(F.col("good"), F.col("n")).otherwise(F.lit(0))).alias("accepted"),
        F.sum(F.when(F.col("good"), F.lit(0)).otherwise(F.col("n"))).alias("rejected"),
    )
    cut = counted.select("w", "accepted", "rejected", F.explode(F.sequence(F.lit(1), F.length("w"))).alias("k"))
    return cut.groupBy(F.expr("left(w, k - 1)").alias("context"), F.expr("substring(w, k, 1)").alias("c")).agg(
        F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected")
    )


def fit(examples: DataFrame, contexts: int | None = None) -> Counts | Model | None:
    """Models of the accepted and the rejected examples, with all contexts; None where one kind is missing.

    With a number of contexts, one expression from those seen most often.
    """
    return _whole(examples) if contexts is None else _expression(examples, contexts)


def _whole(examples: DataFrame) -> Counts | None:
    kinds = {"good": "accepted", "bad": "rejected"}
    parts = [x for kind, n in kinds.items() for x in (F.sum(n).alias(f"{kind}_n"), F.count_if(F.col(n) > 0).alias(f"{kind}_kinds"))]
    after = F.struct("c", F.struct(*[F.col(n).alias(kind) for kind, n in kinds.items()]))
    facts = transitions(examples).groupBy("context").agg(*parts, F.map_from_entries(F.collect_list(after)).alias("next"))
    model = Counts(stored(facts))
    first = model.facts.filter("context = '' and good_n > 0 and bad_n > 0").first()
    if first is None:
        model.discard()
        return None
    return model


def _expression(examples: DataFrame, contexts: int) -> Model | None:
    counts = stored(transitions(examples))
    seen = counts.groupBy("context").agg(F.sum(F.col("accepted") + F.col("rejected")).alias("n"))
    often = seen.filter((F.col("n") >= SEEN) | (F.col("context") == ""))
    kept = often.orderBy(F.col("n").desc(), F.length("context"), "context").limit(contexts)
    # At most one row per kept context and character.
    rows = counts.join(kept.select(F.col("context").alias("of")), F.col("context") == F.col("of")).select("context", "c", "accepted", "rejected").collect()
    discard(counts)
    followers: dict[str, list[dict[str, int]]] = {}
    for r in rows:
        for kind, n in enumerate((r.accepted, r.rejected)):
            found = followers.setdefault(r.context, [{}, {}])[kind]
            if n:
                found[r.c] = n
    if not rows or not all(followers[""]):
        return None

    # A context has a suffix and a prefix that are seen as often and are shorter, so that both are kept with it.
    names = sorted(followers, key=lambda context: (len(context), context))
    number = {context: i for i, context in enumerate(names)}
    smoothed: dict[str, list[list[float]]] = {}
    for context in names:
        shorter = smoothed[context[1:]] if context else [[1 / len(ALPHABET)] * len(ALPHABET)] * 2
        smoothed[context] = []
        for found, base in zip(followers[context], shorter):
            n, kinds = sum(found.values()), len(found)
            smoothed[context].append([(found.get(c, 0) + kinds * p) / (n + kinds) if n else p for c, p in zip(ALPHABET, base)])

    def after(context: str, c: str) -> int:
        longest = (context + c)[-ORDER:]
        while longest not in number:
            longest = longest[1:]
        return number[longest]

    return Model(
        [after(context, c) for context in names for c in ALPHABET],
        [math.log(a / b) for context in names for a, b in zip(*smoothed[context])],
    )


def cut(scores: Sequence[tuple[int, bool, int]]) -> float:
    """The least score to accept, from (score in steps, accepted, count): that with the best sum of both shares told right.

    Of several, the one nearest to 0. With one kind of example only, 0.
    """
    totals = {kind: sum(n for _, good, n in scores if good == kind) for kind in (True, False)}
    if not all(totals.values()):
        return 0.0
    at: dict[int, dict[bool, int]] = {0: {}}
    for step, good, n in scores:
        at.setdefault(step, {})[good] = n
    told, below = [], {True: 0, False: 0}
    for step in sorted(at):
        right = (totals[True] - below[True]) / totals[True] + below[False] / totals[False]
        told.append((round(right, 9), -abs(step), step))
        for good, n in at[step].items():
            below[good] += n
    return max(told)[2] / STEP


def learn(
    urls: DataFrame, url_col: str = "url", rules: Sequence[tuple[str, str]] = RULES, contexts: int | None = None
) -> tuple[Counts | Model | None, float]:
    """Model and cut from the URLs that a rule decides. Equal readings of one verdict are counted once and weighted.

    Four fifths of the readings, by hash, train the models; the cut is set on the others.
    """
    host, path = host_and_path(F.col(url_col))
    ruled = urls.select(reading(host, path).alias("text"), _verdict(rule_of(host, path, rules), rules).alias("verdict")).filter("verdict is not null")
    examples = ruled.groupBy("text", (F.col("verdict") == "allow").alias("good")).agg(F.count("*").alias("n"))
    examples = stored(examples.withColumn("held", F.pmod(F.xxhash64("text"), F.lit(FOLDS)) == 0))
    model = fit(examples.filter("not held"), contexts)
    if model is None:
        discard(examples)
        return None, 0.0
    score = F.floor(F.col("ratio") * STEP).cast("int")
    # A log ratio grows with the logarithm of the counts at most, and so does the number of steps.
    scores = model.with_ratio(examples.filter("held")).groupBy(score.alias("s"), "good").agg(F.sum("n").alias("n")).collect()
    discard(examples)
    return model, cut([tuple(r) for r in scores])


def _verdict(rule: Column, rules: Sequence[tuple[str, str]]) -> Column:
    found = F.lit(None).cast("string")
    for text, verdict in rules:
        found = F.when(rule == text, F.lit(verdict)).otherwise(found)
    return found


def judge(
    pages: DataFrame, model: Counts | Model | None, least: float, id_col: str = "page_id", url_col: str = "url",
    rules: Sequence[tuple[str, str]] = RULES,
) -> DataFrame:
    """Per row: page_id, host, path, rule, verdict and ratio, the mean log-likelihood ratio.

    A rule fits its host and all hosts below, where the path starts with the rule's path; the longest wins, of equal ones
    the first. Without a rule, a URL is allowed if its ratio reaches `least`; without a model, the ratio is 0. A URL that is null or
    has no `://` has an empty host and path, and ratio 0. URLs of any length are read whole. Repeated rows are judged
    alike, a null id stays null, other columns are not read, and an empty table gives an empty result.
    """
    host, path = host_and_path(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    text = reading(F.col("host"), F.col("path"))
    rows = rows.select("*", rule_of(F.col("host"), F.col("path"), rules).alias("rule"), text.alias("text"))
    rows = model.with_ratio(rows) if model else rows.withColumn("ratio", F.lit(0.0))
    own = F.when(F.col("ratio") >= least, F.lit("allow")).otherwise(F.lit("block"))
    return rows.select("page_id", "host", "path", "rule", F.coalesce(_verdict(F.col("rule"), rules), own).alias("verdict"), "ratio")


def verdicts(spark: SparkSession, folder: str) -> DataFrame:
    """The registered query: models from all pages' URLs that a rule decides, then a verdict on every page."""
    pages = table(spark, folder, "pages")
    model, least = learn(pages)
    done = judge(pages, model, least)
    if model:
        model.discard()
    return done

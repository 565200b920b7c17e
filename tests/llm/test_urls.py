"""URL filters: hosts, paths and rules, and the models against a brute-force version."""

import math
from collections import Counter

import pytest

from lapwright.llm import registry, url_filter
from lapwright.llm.url_filter import ALPHABET, CONTEXTS, ORDER, RULES, SEEN

SMALL = "/root/testdata/sf0.001"
URLS = [
    None, "", "no scheme", "http:/x.net/", "https://A.Net/", "https://a.net", "https://net/x", "http://internet/x", "x://B.example.NET/en/1?q=/de/",
    "x://example.net/EN/1", "x://deep.sub.example.com/de/#a", "https://example.com/de", "https://fr.org/fr/é/☃?x", "https://org/fr/#y", "https://u:p@h.org:80/fr/a://b",
    "https://ex.org?x=/fr/", "https://ex.org#/fr/", "https://é.example.org/en/line\nbreak\ttab", "://", ":///", "a://?x", "https://b.com/" + "long/" * 4000,
]


def parts(url):
    """Host and path by searching for the ends."""
    at = (url or "").find("://")
    if at < 0:
        return "", ""
    rest = url[at + 3 :]
    end = min([i for c in "/?#" if (i := rest.find(c)) >= 0], default=len(rest))
    stop = min([i for c in "?#" if (i := rest.find(c)) >= 0], default=len(rest))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end]), rest[end:stop]


def rule(host, path):
    fits = [r for r, _ in RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/") :])]
    return max(fits, key=len, default=None)


def reading(host, path):
    plain = ["0" if c in "123456789" else chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host + path]
    return "".join(c if c in ALPHABET else "?" for c in plain)


def ratio_of(examples, contexts=CONTEXTS):
    """Mean log ratio of a text by looking the longest kept context up at every character."""
    after = {kind: Counter() for kind in (True, False)}
    for text, good, n in examples:
        for i, c in enumerate(text):
            for k in range(min(i, ORDER) + 1):
                after[good][text[i - k : i], c] += n
    seen = Counter()
    for counts in after.values():
        for (context, _), n in counts.items():
            seen[context] += n
    kept = set(sorted((c for c, n in seen.items() if n >= SEEN or not c), key=lambda c: (-seen[c], len(c), c))[:contexts])

    def p(kind, context, c):
        base = p(kind, context[1:], c) if context else 1 / len(ALPHABET)
        found = [n for x in ALPHABET if (n := after[kind][context, x])]
        return (after[kind][context, c] + len(found) * base) / (sum(found) + len(found)) if found else base

    def mean(text):
        total = 0.0
        for i, c in enumerate(text):
            context = next(text[i - k : i] for k in range(min(i, ORDER), -1, -1) if text[i - k : i] in kept)
            total += math.log(p(True, context, c) / p(False, context, c))
        return total / len(text) if text else 0.0

    return mean


def pages(spark, urls=URLS):
    rows = [(i if i % 5 else None, u, "h", "p", "r", "t", 1) for i, u in enumerate(urls)]
    return spark.createDataFrame(rows + rows[4:6], "page_id long, url string, host string, path string, rule string, text string, ratio int")


def test_hosts_paths_and_rules(spark):
    got = url_filter.judge(pages(spark), None, 0.0)
    expected = []
    for r in pages(spark).collect():
        host, path = parts(r.url)
        found = rule(host, path)
        expected.append((r.page_id, host, path, found, dict(RULES).get(found, "allow"), 0.0))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(expected, key=repr)
    assert {e[3] for e in expected} == {None, *(r for r, _ in RULES)}


@pytest.mark.parametrize("contexts", [CONTEXTS, 40])
def test_ratios_are_those_of_the_longest_kept_contexts(spark, contexts):
    urls = [r.url for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()]
    examples = [(reading(*parts(u)), i % 3 > 0, 1 + i % 2) for i, u in enumerate(urls)]
    model = url_filter.fit(spark.createDataFrame(examples, "text string, good boolean, n long"), contexts)
    assert len(model.moves) <= contexts * len(ALPHABET)
    mean = ratio_of(examples, contexts)
    texts = [reading(*parts(u)) for u in urls + [u for u in URLS if u and len(u) < 1000]]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    got = {r.i: r.m for r in df.select("i", model.mean_ratio(df["text"]).alias("m")).collect()}
    assert all(abs(got[i] - mean(t)) < 1e-5 for i, t in enumerate(texts))


def test_ratios_are_those_of_all_contexts_of_many(spark, monkeypatch):
    """More contexts than an expression holds, most of them rare: none is left out."""
    words = [format(i * 2654435761 % 2**32, "08x") for i in range(400)]
    examples = [(reading(f"{w[:3]}.{w[3:6]}.org", f"/{w}"), i % 3 > 0, 1 + i % 2) for i, w in enumerate(words)]
    model = url_filter.fit(spark.createDataFrame(examples, "text string, good boolean, n long"))
    assert model.facts.count() > CONTEXTS
    monkeypatch.setitem(globals(), "SEEN", 1)
    mean = ratio_of(examples, None)
    texts = [t for t, _, _ in examples[:40]] + [reading(*parts(u)) for u in URLS] + ["a", "", "ab", "zzzzzzzzz"] * 2
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    got = {r.i: r.ratio for r in model.with_ratio(df).collect()}
    assert len(got) == len(texts) and all(abs(got[i] - mean(t)) < 1e-5 for i, t in enumerate(texts))


def test_readings_are_plain(spark):
    got = url_filter.judge(pages(spark), None, 0.0)
    text = got.select(url_filter.reading(got["host"], got["path"]).alias("x"), "host", "path").collect()
    assert all(r.x == reading(r.host, r.path) for r in text)


def test_the_cut_tells_most_examples_right():
    assert url_filter.cut([]) == 0.0 and url_filter.cut([(5, True, 3)]) == 0.0
    assert url_filter.cut([(300, True, 5), (100, False, 5)]) == 0.3
    assert url_filter.cut([(-300, True, 5), (-800, False, 5), (-290, False, 1)]) == -0.3
    assert url_filter.cut([(300, True, 5), (-100, False, 5)]) == 0.0


def test_learned_urls_are_told_apart(spark):
    """Hosts that no rule names are judged by their likeness to those that rules decide."""
    good = [(i, f"https://news{i % 40}.journal.org/fr/story-{i}") for i in range(400)]
    bad = [(i, f"https://win{i % 40}.casino-bonus.net/xxx{i}") for i in range(400)]
    new = [(1000 + i, f"https://news{i}.journal.com/fr/story-{i}") for i in range(50)]
    new += [(2000 + i, f"https://win{i}.casino-bonus.com/xxx{i}") for i in range(50)]
    df = spark.createDataFrame(good + bad + new, "page_id long, url string")
    got = {r.page_id: r.verdict for r in url_filter.judge(df, *url_filter.learn(df)).filter("rule is null").collect()}
    assert [got[i] for i in range(1000, 1050)] == ["allow"] * 50 and [got[i] for i in range(2000, 2050)] == ["block"] * 50


def test_one_kind_or_nothing_allows(spark):
    df = spark.createDataFrame([(1, "https://a.net/x"), (2, "https://a.com/x")], "page_id long, url string")
    assert url_filter.learn(df) == (None, 0.0)
    assert {r.page_id: r.verdict for r in url_filter.judge(df, None, 0.0).collect()} == {1: "block", 2: "allow"}
    none = df.limit(0)
    assert url_filter.judge(none, *url_filter.learn(none)).count() == 0


def test_query_and_its_plan(spark):
    got = registry.queries()["op12_url_filter"](spark, SMALL)
    assert got.count() == spark.read.parquet(f"{SMALL}/pages.parquet").count()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan

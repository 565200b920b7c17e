"""Quality rules, decontamination, secrets and the classifier against brute force, and SQL where there is some."""

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from helpers import awkward, empty, hit_words

from lapwright.llm import decontamination, line_dedup, quality_classifier, quality_rules, registry, secrets

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_queries_equal_their_sql(spark, name):
    db = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "labels", "embeddings"):
        db.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    expected = db.sql(registry.oracle_sql()[name])
    columns = sorted(expected.columns)
    got = registry.queries()[name](spark, SMALL)
    assert sorted(got.columns) == columns
    assert sorted(repr(tuple(r)) for r in got.select(*columns).collect()) == sorted(
        map(repr, expected.select(", ".join(columns)).fetchall())
    )


def test_measures_of_a_text():
    words = [f"w{i}" for i in range(9)]
    text = "  ".join(words + ["x"] + words) + "\nsame # line\n\nsame # line\n \t\n"
    n_words, chars, symbols, dup, repeated, lines, echoes = quality_rules.measure(text)
    assert (n_words, symbols, dup, repeated, lines, echoes) == (25, 2, 1, 18, 3, 0)
    assert chars == sum(len(w) for w in re.findall(r"[^\x20\x09-\x0D]+", text))
    assert quality_rules.measure("a " * 20)[4] == 20
    assert quality_rules.measure("") == (0,) * 7


def test_steps_are_ordered_and_close(spark):
    values = [*range(200), 10**6, 2**40 + 1]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    with_steps = df.withColumn("s", quality_rules.step_of(df["v"]))
    rows = with_steps.withColumn("start", quality_rules.step_start(with_steps["s"])).collect()
    steps = [r.s for r in sorted(rows, key=lambda r: r.v)]
    assert steps == sorted(steps)
    assert all(r.start <= r.v <= r.start * 17 / 16 + 1e-9 for r in rows)


def test_verdicts_over_awkward_rows(spark):
    plain = " ".join(f"ordinary{i % 40} words" for i in range(0, 40))
    docs = awkward(spark, [None, "", plain, plain.replace(" ", "### "), "x y"])
    got = quality_rules.judge(docs, weight=1)
    assert got.count() == docs.count()
    assert got.filter("kept and n_words < 20").count() == 0
    assert quality_rules.judge(empty(spark)).count() == 0
    symbols = spark.createDataFrame(
        [(i, plain if i % 10 else plain.replace(" ", "### "), None, "s") for i in range(50)],
        "doc_id long, text string, lang string, source string",
    )
    assert {r.doc_id for r in quality_rules.judge(symbols, weight=10).filter("not kept").collect()} == {0, 10, 20, 30, 40}


def test_thresholds_follow_the_source(spark):
    words = [f"ordinary{i % 40} words" for i in range(40)]
    plain, code = " ".join(words), " ".join(w.replace(" ", " ## ") for w in words)
    rows = [(i, plain + f" {i}", "en", "news") for i in range(600)] + [(1000 + i, code + f" {i}", "en", "code") for i in range(600)]
    rows += [(5000, code, "en", "news"), (5001, code, "en", "code"), (5002, plain + " #", "en", "news")]
    rows += [(6000 + i, "\n".join([f"line {i} again and again"] * 100 if i % 4 == 0 else [f"line {j} of text {i}" for j in range(100)]), "en", "junk") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    done = quality_rules.judge(docs, weight=50).cache()
    failed = {r.doc_id: r.failed for r in done.collect()}
    assert failed[5000] == "symbol_share" and failed[5001] == "" == failed[5002]
    assert all(not failed[i] and not failed[1000 + i] for i in range(600))
    # A quarter of a source is bad: its share still has a fence.
    assert all(("copied_line_share" in failed[6000 + i]) == (i % 4 == 0) for i in range(600))
    high = {r.source: r.fence["symbol_share"].high for r in quality_rules.fences(done, weight=50).collect()}
    assert high["news"] < high["code"]


def test_hits_are_those_of_all_windows(spark):
    draw = random.Random(8)
    words = ["Red", "green", "Éclat", "7up", "x"] + [f"k{i}" for i in range(30)]
    items = [(i, " ".join(draw.choice(words) for _ in range(n))) for i, n in enumerate([30, 12, 10, 9, 4, 1, 0])]
    items += [(20, items[0][1]), (100, items[1][1].upper()), (9, None)]
    texts = [None, "", "x", items[0][1], "\n".join([items[1][1]] * 3)]
    for _ in range(40):
        a = draw.choice(items[:3])[1].split()
        k = draw.randrange(len(a))
        noise = lambda: [draw.choice(words[5:]) for _ in range(draw.randrange(15))]
        texts.append(", ".join(noise() + a[k : k + draw.randrange(1, 14)] + noise()))
    benchmark = spark.createDataFrame([(*i, "extra") for i in items], "item_id long, text string, words string")
    docs = awkward(spark, texts)
    got = [
        (r.doc_id, r.n_words, r.n_hit, sorted(r["items"]))
        for r in decontamination.contamination(docs, benchmark).collect()
    ]
    expected = []
    for r in docs.collect():
        n, places, found = hit_words(r.text, items)
        expected.append((r.doc_id, n, len(places), sorted(map(str, found))))
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    clean = decontamination.keep_clean(docs, benchmark)
    assert clean.columns == docs.columns and clean.count() == sum(not e[2] for e in expected)
    none = spark.createDataFrame([], benchmark.schema)
    assert decontamination.contamination(docs, none).filter("n_hit > 0").count() == 0
    assert decontamination.contamination(empty(spark), benchmark).count() == 0


def base_spans(text):
    assign = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found = [(m.start(), 0, m.end()) for m in re.finditer(assign, text, re.A) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found)


def test_joined_and_mixed_keys_are_found(spark):
    ratios = secrets.transition_ratios(secrets.labelled_strings(spark.read.parquet(f"{SMALL}/documents.parquet")))
    key, words = "kX9vQ2mZr7LpT4bWc8Ns1Hd6", "internationalization_configuration_manager"
    mixed = "kX9vQ2mZr7LpT4bWc8Ns1Hd6Zdeadbeef01234567Q2mZr7LpT4bWkX9v"
    texts = {
        1: f"see {words}/{words}/{key} here", 2: f"see {key}-{words}_{words} here", 3: f"see {mixed} here", 4: f"see {words}/{words}",
        5: f"see {key[:12]}/{key[12:]} here",
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: [(texts[r.doc_id][f["start"] : f["end"]], f["kind"]) for f in r.found] for r in secrets.find(docs, ratios).collect()}
    assert got[1] == [(key, 3)] and got[2] == [(key, 3)] and got[4] == []
    assert got[3] == [(mixed[:25], 3), (mixed[25:41], 2), (mixed[41:], 3)]
    assert got[5] == [(f"{key[:12]}/{key[12:]}", 3)]


def test_words_come_from_enough_texts_without_findings(spark):
    rows = [(k, f"password=hunter2hunter2 number {k}") for k in range(200)]
    rows += [(k, "ordinary" + "".join(chr(97 + int(c)) for c in str(k))) for k in range(1000, 1010)]
    words = secrets.labelled_strings(spark.createDataFrame(rows, "doc_id long, text string"), sample=100).filter("label = 0")
    assert words.count() == 10


def test_base_spans_and_random_strings(spark):
    draw = random.Random(9)
    parts = ["password=", "Token : '", "API_KEY=\"", "api-key=", "AKIA", "AKIAAKIA", "secret", "😀", " ", "\n", "é", "0123456789abcdef",
             "deadbeefdeadbeefde", "ABCDEFGHIJKLMN", "QRSTUV2345", "passwd:", "hunter2hunter2", "the quick brown fox", "=", "'"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randrange(1, 14))) for _ in range(150)]
    texts += [None, "", "See kX9vQ2mZr7LpT4bWc8Ns1Hd6 here", "internationalization_configuration_manager", "z" * 40, "ab" * 5000 + " token=" + "Zz9" * 9]
    docs = awkward(spark, texts)
    ratios = secrets.transition_ratios(secrets.labelled_strings(spark.read.parquet(f"{SMALL}/documents.parquet")))
    for r in secrets.find(docs, ratios).join(docs.select("doc_id", "text"), "doc_id").collect():
        if r.doc_id is None or r.doc_id in (0, 3):
            continue
        assert [(x.start, x.kind, x.end) for x in r.found if x.kind < 3] == base_spans(r.text or ""), r.text
    of = {r.doc_id: r.found for r in secrets.find(docs, ratios).collect()}
    assert [(x.start, x.kind, x.end) for x in of[152]] == [(4, 3, 28)]
    assert of[153] == of[154] == []
    assert secrets.find(empty(spark), ratios).count() == 0
    assert len(secrets.find(docs, ratios).collect()) == docs.count()


def test_registered_scan_digests(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    for r in secrets.scan(spark, SMALL).collect():
        spans = base_spans(texts[r.doc_id] or "")
        listed = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == i for _, k, _ in spans) for i in range(3)]


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = quality_classifier.scores(spark, folder).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    judged = [r for r in rows if r.held_out and r.doc_id in quality]
    assert len(judged) > 50
    assert np.mean([r.predicted == quality[r.doc_id] for r in judged]) > 0.95


def test_classifier_over_awkward_rows(spark):
    docs = awkward(spark)
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(9)] + [(None, 1, 0), (5, None, 1), (1, 0, 0)], "doc_id long, quality int, toxic int")
    done = quality_classifier.classify(docs.withColumnRenamed("rank", "score"), labels)
    assert done.count() == docs.count() and "rank" not in done.columns
    nothing = labels.limit(0)
    assert {r.score for r in quality_classifier.classify(docs, nothing).collect()} == {0.5}
    assert quality_classifier.classify(empty(spark), labels).count() == 0
    # A label that is not learned from changes nothing.
    held = next(i for i in range(9) if zlib.crc32(str(i).encode()) % 5 == 0)
    flipped = labels.selectExpr("doc_id", f"if(doc_id = {held}, 1 - quality, quality) as quality", "toxic")
    scores = lambda x: sorted(r.score for r in quality_classifier.classify(docs, x).collect())
    assert scores(labels) == scores(flipped)


def test_sample_is_bounded_by_ids_and_indicators(spark):
    rows = [(k % 5 + 1, f"text {k} of some words", k % 2) for k in range(1000)]
    samples = spark.createDataFrame(rows, "key long, text string, label int").selectExpr("*", "xxhash64(key, text) as place")
    least = {}
    for r in samples.collect():
        least[r.key] = min(least.get(r.key, r), r, key=lambda x: x.place)
    once = spark.createDataFrame(list(least.values()), samples.schema)
    weights, a, b = quality_classifier.fit(samples)
    again = quality_classifier.fit(once)
    assert np.array_equal(weights, again[0]) and (a, b) == again[1:]
    # By hand: the first rows in order of place, as far as their indicators go.
    seen = np.zeros(quality_classifier.BUCKETS, dtype=bool)
    found = [(quality_classifier.indicators(r.text, seen), r.label) for r in sorted(least.values(), key=lambda x: x.place)]
    capacity = sum(len(f) for f, _ in found[:3])
    expected = quality_classifier.fit_rows([f for f, _ in found[:3]], np.array([y for _, y in found[:3]]))
    weights, a, b = quality_classifier.fit(samples, capacity)
    assert np.array_equal(weights, expected[0]) and (a, b) == expected[1:]


def test_descent_solves_the_dual_problem(monkeypatch):
    """Against projected gradients on the whole dual matrix, with log-count ratios counted by hand."""
    draw = random.Random(4)
    words = [f"w{i}" for i in range(12)]
    rows = [" ".join(draw.choice(words[:8] if i % 2 else words[4:]) for _ in range(6)) for i in range(24)]
    labels = np.array([i % 2 for i in range(24)])
    seen = np.zeros(quality_classifier.BUCKETS, dtype=bool)
    found = [quality_classifier.indicators(t, seen) for t in rows]
    y, cost = np.where(labels == 1, 1.0, -1.0), np.full(24, 0.1)
    used = sorted(set(np.concatenate(found).tolist()))
    count = [{c: 1 + sum(c in f for f, l in zip(map(set, found), labels) if l == k) for c in used} for k in (0, 1)]
    rest = quality_classifier.BUCKETS - len(used)
    total = [sum(c.values()) + rest for c in count]
    ratio = {c: np.log(count[1][c] / total[1]) - np.log(count[0][c] / total[0]) for c in used}
    x = np.array([[ratio[c] if c in set(f.tolist()) else 0.0 for c in used] + [1.0] for f in found])
    scale = np.zeros(quality_classifier.BUCKETS)
    scale[used] = [ratio[c] for c in used]
    monkeypatch.setattr(quality_classifier, "ROUNDS", 400)
    weights = quality_classifier._descend(found, scale, y, cost)
    alpha, gram = np.zeros(24), (x * y[:, None]) @ (x * y[:, None]).T
    for _ in range(20000):  # projected gradient on the same dual problem
        alpha = np.clip(alpha - (gram @ alpha - 1) / np.linalg.norm(gram, 2), 0, cost)
    dense = (alpha * y) @ x
    assert np.allclose(weights[used], dense[:-1], atol=1e-3) and abs(weights[-1] - dense[-1]) < 1e-3


def test_no_python_on_native_paths(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    plan = secrets.find(docs, [0.0] * 65 * 65)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_lines_are_taken_out_of_a_text_once(spark):
    """Words of lines with any blanks, and a plan that makes the array of lines in one place only."""
    texts = ["a b", " a  b ", "a\tb c\x0b", "\x0c \r", "one", "a\u00a0b c", "x  y\r", "", "a b c\u2028"]
    docs = spark.createDataFrame([(1, "\n".join(texts)), (2, None), (3, " \n")], "doc_id long, text string")
    lines = line_dedup._lines(docs, "doc_id", "text")
    got = sorted((r.doc_id, r.i, r.pos, r.words) for r in lines.collect())
    counts = [(p, len(re.findall(line_dedup.WORD, x))) for p, x in enumerate(texts)]
    assert got == [(1, i, *pair) for i, pair in enumerate((p, n) for p, n in counts if n)]
    assert lines._jdf.queryExecution().executedPlan().toString().count("transform(") == 1


def test_the_plan_of_item_prints_does_not_repeat_its_steps(spark):
    rows = spark.createDataFrame([([str(i) for i in range(12)],), ([],), (None,)], "words array<string>")
    prints = decontamination.distinct_prints(rows)
    assert prints._jdf.queryExecution().optimizedPlan().toString().count("zip_with") <= 6
    once = decontamination.with_fingerprints(rows.limit(1)).first().prints
    assert sorted(r[0] for r in prints.collect()) == sorted(set(once))

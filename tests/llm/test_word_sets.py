"""Near copies by shared word runs against all pairs."""

import random

import pytest
from helpers import awkward, empty, fingerprint, groups

from lapwright.llm import simhash, word_sets

MEDIUM = "/root/testdata/sf0.01"


def runs(text):
    words = (text or "").encode().lower().split()
    return frozenset(b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def alike(a, b, least=0.8):
    both = len(a & b)
    return bool(both) and both >= least * (len(a) + len(b) - both)


def pairs_of(texts):
    """Pairs of different run sets that are alike, by their ids, through an index of all runs."""
    sets, where = {}, {}
    for i, t in texts.items():
        sets.setdefault(runs(t), i)
    ids = {i: s for s, i in sets.items() if s}
    for i, s in ids.items():
        for r in s:
            where.setdefault(r, []).append(i)
    met = {(a, b) for few in where.values() if len(few) < 400 for a in few for b in few if a < b}
    return {(a, b) for a, b in met if alike(ids[a], ids[b])}


def test_recall_and_precision_on_given_documents(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text for r in docs.collect()}
    wanted = pairs_of(texts)
    assert len(wanted) >= 5
    kept = {r.doc_id for r in simhash.keep_one(docs, similarity=0.8).collect()}
    linked = groups(texts, lambda a, b: (min(a, b), max(a, b)) in wanted or texts[a] == texts[b])
    prints = {d: fingerprint(t) for d, t in texts.items()}
    caught = sum(not {a, b} <= kept for a, b in wanted)
    assert caught >= 0.9 * len(wanted), (caught, len(wanted))
    for d in set(texts) - kept:  # what goes has a copy: by its runs, or by its fingerprint
        by_print = any(e != d and (prints[d] ^ prints[e]).bit_count() <= 4 for e in texts)
        assert by_print or sum(r == linked[d] for r in linked.values()) > 1


@pytest.mark.parametrize("changed", [0, 2])
def test_large_groups_of_near_copies_become_one(spark, changed):
    draw = random.Random(changed)
    base = [f"w{draw.randrange(10**6)}" for _ in range(200)]
    rows = []
    for i in range(300):
        words = list(base)
        for _ in range(changed):
            words[draw.randrange(200)] = f"x{draw.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, " ".join(f"v{draw.randrange(10**6)}" for _ in range(80))) for i in range(100)]
    kept = {r.doc_id for r in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(7), similarity=0.8).collect()}
    assert kept == {0, *range(1000, 1100)}


def test_awkward_rows_and_none(spark):
    docs = awkward(spark)
    kept = simhash.keep_one(docs, similarity=0.8)
    assert kept.columns == docs.columns
    plain = simhash.keep_one(docs)
    assert sorted(map(repr, kept.collect())) == sorted(map(repr, plain.collect()))
    assert simhash.keep_one(empty(spark), similarity=0.8).count() == 0


def test_minima_agree_as_often_as_sets_are_alike():
    draw = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    total = 0.0
    for _ in range(40):
        other = list(words)
        for k in draw.sample(range(400), 8):
            other[k] = "x"
        a, b = word_sets.run_hashes(" ".join(words))[1], word_sets.run_hashes(" ".join(other))[1]
        truth = len(set(a.tolist()) & set(b.tolist())) / len(set(a.tolist()) | set(b.tolist()))
        total += (word_sets.minima(a) == word_sets.minima(b)).mean() - truth
        words = other
    assert abs(total / 40) < 0.03


def test_no_pair_of_a_bucket_is_passed_over(spark, monkeypatch):
    """Many far groups in one bucket: copies that no pivot is near to are still found, whatever the slots."""
    monkeypatch.setattr(word_sets, "SLOT", 7)
    draw = random.Random(5)
    size = word_sets.ROWS * word_sets.BANDS
    minima = {i: [draw.randrange(10**9) for _ in range(size)] for i in range(60)}
    for i in range(0, 60, 3):
        minima[i + 1] = minima[i][:-3] + [1, 2, 3]
    wanted = {(i, i + 1) for i in range(0, 60, 3)}
    nodes = spark.createDataFrame(list(minima.items()), "node long, minima array<int>")
    members = nodes.selectExpr("node", "0 as band", "7L as `key`")
    none = spark.createDataFrame([], "node long, root long")
    pivots = {(r.u, r.v) for r in word_sets.likely(word_sets.further_pairs(members, none), nodes, 0.8).collect()}
    assert not wanted <= pivots
    assert {(r.u, r.v) for r in word_sets.remaining_pairs(members, none, nodes, 0.8).collect()} == wanted
    joined = spark.createDataFrame([x for i in range(3, 60, 3) for x in ((i, 3), (i + 1, 3))], "node long, root long")
    assert {(r.u, r.v) for r in word_sets.remaining_pairs(members, joined, nodes, 0.8).collect()} == {(0, 1)}


def _nearly_similar(seed, count, copies):
    """Texts that share two thirds of their runs, all from one text, and some copies of them with one more word changed."""
    draw = random.Random(seed)
    base = [f"w{i}" for i in range(150)]
    texts = []
    for _ in range(count):
        words = list(base)
        for k in range(10, 150, 50):
            words[k + draw.randrange(40)] = f"x{draw.randrange(10**9)}"
        texts.append(words)
    return [" ".join(t) for t in texts] + [" ".join([*t[:-1], f"x{draw.randrange(10**9)}"]) for t in texts[:copies]]


def test_parities_differ_in_no_more_bits_than_sets_do_in_runs():
    draw = random.Random(7)
    for size in (1, 5, 150, 4000):
        base = [f"w{i}" for i in range(size)]
        for changed in (0, 1, size // 50, size // 4, size):
            other = list(base)
            for k in draw.sample(range(size), changed):
                other[k] = f"x{k}"
            a, b = (word_sets.run_set(word_sets.run_hashes(" ".join(t))[1]) for t in (base, other))
            bits = sum(int(x ^ y).bit_count() for x, y in zip(word_sets.parities(a).tolist(), word_sets.parities(b).tolist()))
            assert bits <= len(set(a.tolist()) ^ set(b.tolist()))


def test_few_pairs_of_a_large_group_of_nearly_similar_texts_are_checked(spark):
    """The pairs that leave the joins follow the links, not the square of the group, and none of the links is lost."""
    texts = _nearly_similar(3, 120, 12)
    sets = [runs(t) for t in texts]
    wanted = {frozenset((a, b)) for a in range(len(texts)) for b in range(a) if alike(sets[a], sets[b])}
    assert {frozenset((i, 120 + i)) for i in range(12)} <= wanted and len(wanted) < 60
    nodes = word_sets.signatures(spark.createDataFrame([*enumerate(texts)], "id long, text string").repartition(3)).drop("text")
    ids = {r.node: r.id for r in nodes.collect()}
    members = nodes.selectExpr("node", "0 as band", "7L as `key`")
    none = spark.createDataFrame([], "node long, root long")
    pairs = word_sets.remaining_pairs(members, none, nodes, 0.8)
    met = {frozenset((ids[r.u], ids[r.v])) for r in pairs.collect()}
    assert wanted <= met and len(met) <= 3 * len(texts)
    every = spark.createDataFrame([(a, b) for a in ids for b in ids if a < b], "u long, v long")
    assert {frozenset((ids[r.u], ids[r.v])) for r in word_sets.likely(every, nodes, 0.8).collect()} == met

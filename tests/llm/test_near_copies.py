"""SimHash groups and line runs against brute force."""

import random

import numpy as np
from helpers import awkward, empty, fingerprint, groups, without_copied_runs
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lapwright.llm import components as components_module
from lapwright.llm import line_dedup, simhash, word_sets
from lapwright.llm.components import components

MASKS = simhash.covering_masks()


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 2**64 - 1), st.sets(st.integers(0, 63), max_size=4))
def test_every_pair_within_the_radius_meets(fp, flipped):
    other = fp ^ sum(1 << b for b in flipped)
    assert any((fp & m) == (other & m) for m in (m % 2**64 for m in MASKS))


def test_components_of_chains_and_stars(spark):
    draw = random.Random(1)
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(5, 5)]
    links += [(draw.randrange(1000, 1100), draw.randrange(1000, 1100)) for _ in range(60)]
    nodes = {n for link in links for n in link}
    joined = {frozenset(x) for x in links}
    roots = groups(nodes, lambda a, b: frozenset((a, b)) in joined)
    smallest = {}
    for n, r in roots.items():
        smallest[r] = min(n, smallest.get(r, n))
    expected = {(n, smallest[r]) for n, r in roots.items() if smallest[r] != n}
    got = {tuple(r) for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert {x for x in got if x[0] != x[1]} == expected
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def _near(spark):
    """Texts with a large group of near copies, small groups and strangers."""
    draw = random.Random(2)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for g in range(4):
        base = [draw.choice(words) for _ in range(150)]
        for _ in range((60, 8, 2, 1)[g]):
            text = [*base]
            for _ in range(draw.randrange(3)):
                text[draw.randrange(150)] = draw.choice(words)
            rows.append(" ".join(text))
    rows += [" ".join(draw.choice(words) for _ in range(draw.randrange(1, 9))) for _ in range(60)]
    draw.shuffle(rows)
    return spark.createDataFrame([*enumerate(rows)], "doc_id long, text string")


def test_groups_are_those_of_all_pairs(spark):
    for docs in (_near(spark), awkward(spark)):
        rows = [(r.doc_id, fingerprint(r.text)) for r in docs.select("doc_id", "text").collect()]
        roots = groups({fp for _, fp in rows}, lambda a, b: (a ^ b).bit_count() <= 4)
        ids = {}
        for d, fp in rows:
            ids.setdefault(roots[fp], []).append(d)
        expected = sorted(((d, fp, min((x for x in ids[roots[fp]] if x is not None), default=None)) for d, fp in rows), key=repr)
        got = [(r.doc_id, r.fp % 2**64, r.component_id) for r in simhash.near_duplicates(docs).collect()]
        assert sorted(got, key=repr) == expected
        kept = simhash.keep_one(docs)
        assert kept.columns == docs.columns
        assert kept.count() == len({r for r in roots.values()})
    assert simhash.near_duplicates(empty(spark)).count() == 0
    assert simhash.keep_one(empty(spark)).count() == 0


def _passages(spark):
    draw = random.Random(4)
    line = lambda: " ".join(draw.choice(["red", "green", "blue", "far", "near", "Tür"]) + str(draw.randrange(30)) for _ in range(draw.randrange(3, 14)))
    hot = line()
    passages = [[line() for _ in range(draw.randrange(5, 14))] for _ in range(4)] + [[" ".join([line() for _ in range(12)])]]
    texts = []
    for i in range(40):
        text = [hot, "", *[line() for _ in range(draw.randrange(3))]]
        for _ in range(draw.randrange(3)):
            p = draw.choice(passages)
            a = draw.randrange(len(p)) if draw.random() < 0.5 else 0
            text += p[a:] + ([""] if draw.random() < 0.3 else []) + [line()] * draw.randrange(2)
        texts.append("\n".join(text))
    texts += [texts[5], texts[6] + "\n" + texts[6], "\n".join([hot] * 40), None, "", "\n\n"]
    return spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")


def test_copied_runs_are_those_of_all_windows(spark):
    docs = _passages(spark)
    expected = without_copied_runs([tuple(r) for r in docs.orderBy("doc_id").collect()])
    got = {r.doc_id: r.text for r in line_dedup.deduplicate(docs).collect()}
    assert got == expected
    assert sum(got[k] != t for k, t in (tuple(r) for r in docs.collect())) > 10


def test_awkward_rows_keep_their_shape(spark):
    long = "\n".join(f"line {i} of a long text that is there twice and more" for i in range(30))
    docs = awkward(spark, ["short", None, long, long + "\nmore", "", "x\n" + long])
    done = line_dedup.deduplicate(docs)
    assert sorted(done.columns) == sorted(docs.columns)
    rows = done.orderBy("doc_id").collect()
    assert len(rows) == docs.count()
    by_id = {r.doc_id: r.text for r in rows if r.doc_id not in (None, 3)}
    assert (by_id[2], by_id[5], by_id[1], by_id[4]) == (long, "x", None, "")
    assert {r.text for r in rows if r.doc_id == 3} == {"more", "another text of document three"}
    # Ids that are null come last, and rows equal in id and text are one document.
    late = spark.createDataFrame([(None, long), (9, long), (9, long)], "doc_id long, text string")
    assert sorted(((r.doc_id, r.text) for r in line_dedup.deduplicate(late).collect()), key=repr) == [(9, long), (9, long), (None, "")]
    assert line_dedup.deduplicate(empty(spark)).count() == 0


def test_ranks_are_places_in_the_suffix_array(spark):
    draw = random.Random(6)
    sequences = [[draw.randrange(3) for _ in range(draw.randrange(1, 25))] for _ in range(12)]
    rows = [(s, i, v << 58) for s, x in enumerate(sequences) for i, v in enumerate(x)]
    got = line_dedup.suffix_ranks(spark.createDataFrame(rows, "s long, i int, a long"), 8, ["s"], ["a"])
    prefixes = {(s, i): tuple(x[i : i + 8]) for s, x in enumerate(sequences) for i in range(len(x))}
    expected = {k: 1 + sum(q < p for q in prefixes.values()) for k, p in prefixes.items()}
    assert {(r.s, r.i): r.r3 for r in got.collect()} == expected
    assert got.filter(F.col("r0") < 1).count() == 0


def test_the_filter_of_nodes_follows_their_number(spark):
    nodes = [5, -7, 2**62 + 11]
    few = word_sets._bitmap(spark.createDataFrame([(n,) for n in nodes], "node long"), len(nodes))
    assert len(few) == 8192 and int(np.unpackbits(few).sum()) == len(nodes)
    lowest = 8 * len(few) - 1
    assert all(few[(n & lowest) >> 3] >> (n & 7) & 1 for n in nodes)
    rows = spark.createDataFrame([(f"text {i} of some words here",) for i in range(300)], "text string")
    wanted = [word_sets.run_hashes(f"text {i} of some words here")[0] for i in range(0, 300, 3)]
    wanted = [n - 2**64 if n >> 63 else n for n in wanted]
    found = word_sets.sets(rows, spark.createDataFrame([(n,) for n in wanted], "node long"))
    assert set(wanted) <= {r.node for r in found.collect()}


def _plans(monkeypatch, *modules):
    """Plans of everything that the modules store from now on."""
    seen = []
    for module in modules:
        def noted(df, store=module.stored):
            seen.append(df._jdf.queryExecution().executedPlan().toString())
            return store(df)

        monkeypatch.setattr(module, "stored", noted)
    return seen


def test_joins_of_prints_and_links_send_nothing_through_the_driver(spark, monkeypatch):
    """Their sides grow with the input, and an explode or a compressed file hides how far."""
    plans = _plans(monkeypatch, simhash, components_module)
    done = simhash.near_duplicates(awkward(spark))
    plans.append(done._jdf.queryExecution().executedPlan().toString())
    assert sum("SortMergeJoin" in p for p in plans) > 3 and not any("Broadcast" in p for p in plans)


def test_joins_of_word_sets_and_lines_send_nothing_through_the_driver(spark, monkeypatch):
    plans = _plans(monkeypatch, simhash, word_sets, line_dedup, components_module)
    for done in (simhash.keep_one(awkward(spark), similarity=0.8), line_dedup.deduplicate(awkward(spark))):
        plans.append(done._jdf.queryExecution().executedPlan().toString())
    assert sum("SortMergeJoin" in p for p in plans) > 10 and not any("Broadcast" in p for p in plans)

"""Hard negatives and vector codes against brute force and SQL."""

import math
import random

import numpy as np
import pytest

from lapwright.llm import hard_negatives, vector_codes
from lapwright.llm.vectors import LIMIT

# Columns behind the first three have names that the operators use themselves.
SCHEMA = "vec_id long, label int, embedding array<float>, id long, q string, score long, block int, code string, error int"


def vectors(spark, n=300, width=8, spread=3, seed=5):
    """Random vectors, many of them equal in parts, and every awkward case."""
    draw = random.Random(seed)
    one = lambda: [draw.randrange(-spread, spread + 1) / 4 + draw.choice([0.0, 0.001]) for _ in range(width)]
    rows = [(i, draw.randrange(4) if i % 3 else 1, one()) for i in range(n)]
    rows += [(7, 1, rows[7][2])] * 3 + [(20, 2, one()), (20, 2, rows[20][2]), (None, 1, one()), (None, 2, one()), (None, 2, one())]
    rows += [(901, None, one()), (902, 1, None), (903, 1, [math.nan] + one()[1:]), (904, 1, [math.inf] * width), (905, 1, [None] * width)]
    rows += [(910, 1, []), (911, 2, one()[:3]), (912, 1, one() + one()), (913, 0, [1e30] + [-1e30] * (width - 1))]
    draw.shuffle(rows)
    return spark.createDataFrame([(*r, 1, "x", 2, 3, "y", 4) for r in rows], SCHEMA).repartition(5)


def whole(df):
    """Kept rows as (id, label, numbers)."""
    out = []
    for r in df.collect():
        v = r.embedding
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            out.append((r.vec_id, r.label, tuple(max(-LIMIT, min(LIMIT, math.floor(256 * x))) for x in v)))
    return out


def mined(rows, is_anchor, positives=5, negatives=10):
    last = lambda i: (i is None, i or 0)
    out = []
    for anchor in {r for r in rows if is_anchor(r[0])}:
        others = list(rows)
        others.remove(anchor)
        score = lambda r, a=anchor: sum(x * y for x, y in zip(a[2], r[2]))
        best = sorted((-score(r), last(r[0]), r[0], r[1]) for r in others)
        for minus, _, pid, _ in [b for b in best if b[3] == anchor[1]][:positives]:
            fits = [b for b in best if b[3] != anchor[1] and 30 * -minus <= 100 * -b[0] <= 90 * -minus][:negatives]
            out += [(anchor[0], pid, k, b[2], -minus, -b[0]) for k, b in enumerate(fits, 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [4096, 3])
def test_negatives_are_those_of_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(hard_negatives, "BLOCK", block)
    monkeypatch.setattr(hard_negatives, "ROWS", 16)
    monkeypatch.setattr(hard_negatives, "COLUMNS", 4)
    df = vectors(spark)
    got = hard_negatives.mine(df, df["vec_id"] % 20 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    rows = [r for r in whole(df) if r[1] is not None]
    expected = mined(rows, lambda i: i is not None and i % 20 == 0)
    assert len(expected) > 300 and sorted(map(tuple, got.collect()), key=repr) == expected


def test_no_vectors_no_anchors_no_positives(spark):
    df = vectors(spark, n=30)
    assert hard_negatives.mine(df.limit(0), df["vec_id"] >= 0).count() == 0
    assert hard_negatives.mine(df, df["vec_id"] < 0).count() == 0
    alone = spark.createDataFrame([(0, 1, [1.0]), (1, 2, [1.0])], "vec_id long, label int, embedding array<float>")
    assert hard_negatives.mine(alone, alone["vec_id"] == 0).count() == 0


def test_a_hot_anchor_and_label(spark):
    """A third of all rows are copies of one anchor: they are one anchor, whose positives are its copies."""
    rows = [(0, 1, [1.0, 0.5])] * 200 + [(i, i % 3, [i / 400, 0.1]) for i in range(1, 400)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").repartition(6)
    got = hard_negatives.mine(df, df["vec_id"] % 100 == 0)
    assert sorted(map(tuple, got.collect()), key=repr) == mined(whole(df), lambda i: i % 100 == 0)


def coded(rows, parts, entries, rounds):
    """Codes and errors by plain search, and the codebooks."""
    m = max(1, -(-max(len(r[2]) for r in rows) // parts))
    wide = {r: r[2] + (0,) * (parts * m - len(r[2])) for r in rows}
    first = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:entries]
    books = [[wide[r][p * m : p * m + m] for r in first] for p in range(parts)]

    def nearest(r, p):
        x = wide[r][p * m : p * m + m]
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for r in rows:
                members.setdefault(nearest(r, p)[1], []).append(wide[r][p * m : p * m + m])
            for k, xs in members.items():
                books[p][k] = tuple(sum(c) // len(xs) for c in zip(*xs))
    out = []
    for r in rows:
        best = [nearest(r, p) for p in range(parts)]
        out.append((r[0], r[1], "".join(f"{k:02x}" for _, k in best), sum(d for d, _ in best)))
    return sorted(out, key=repr), books


@pytest.mark.parametrize("parts, entries, rounds", [(4, 24, 4), (2, 64, 2), (16, 1, 1), (3, 400, 2)])
def test_codes_are_those_of_plain_search(spark, parts, entries, rounds):
    entries = min(entries, 256)
    df = vectors(spark)
    got, books = vector_codes.compress(df, parts=parts, entries=entries, rounds=rounds)
    expected, plain = coded(whole(df), parts, entries, rounds)
    assert books.tolist() == [[list(e) for e in b] for b in plain]
    assert sorted((tuple(r) for r in got.select("vec_id", "label", "code", "error").collect()), key=repr) == expected


def test_bounds_save_distances_and_never_lie():
    draw = np.random.default_rng(3)
    x, entries = draw.integers(-60, 60, (4000, 4)), draw.integers(-60, 60, (64, 4))
    state, before, depths = vector_codes.start(x, entries, 16), entries, []
    for _ in range(6):
        entries = before + draw.integers(-3, 4, before.shape)
        state, depth = vector_codes.advance(x, state, before, entries)
        d = ((x[:, None] - entries[None]) ** 2).sum(axis=2)
        code, upper, near, lower, outer = state
        assert (code == d.argmin(axis=1)).all()
        far = np.sqrt(d.astype(float))
        assert (upper >= far[np.arange(len(x)), code]).all()
        assert (lower <= np.take_along_axis(far, near.astype(int), axis=1)).all()
        rest = far.copy()
        np.put_along_axis(rest, np.column_stack([code, near]).astype(int), np.inf, axis=1)
        assert (outer <= rest.min(axis=1)).all()
        depths.append(depth)
        state, before = vector_codes.shrunk(state, max(8, depth)), entries
    assert state[2].shape[1] < 16 or max(depths) == 16


def test_copies_of_one_vector_and_nothing(spark):
    hot = spark.createDataFrame([(i, None, [0.5] * 20) for i in range(200)], "vec_id long, label int, embedding array<float>")
    got, books = vector_codes.compress(hot)
    assert {(r.code, r.error) for r in got.collect()} == {("00" * 16, 0)} and books.shape == (16, 64, 2)
    got, books = vector_codes.compress(hot.limit(0))
    assert got.count() == 0 and books.size == 0

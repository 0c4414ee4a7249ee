"""Coordinate pruning against brute force."""

import math
import random

import numpy as np
import pytest

from ledgerlens.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, id string, q int, dim string"


def brute(rows, every=50, k=5, m=3, low=50, high=95):
    ok = {(i, tuple(math.floor(256 * x) for x in v), lab) for i, v, lab in rows
          if i is not None and lab is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for i, q, lab in ok:
        if i % every:
            continue
        score = [(sum(a * b for a, b in zip(q, p)), j, other) for j, p, other in ok if len(p) == len(q)]
        pos = sorted((-s, j) for s, j, other in score if other == lab and j != i)[:k]
        for s, j in pos:
            neg = sorted((-t, n) for t, n, other in score if other != lab and low * -s <= 100 * t <= high * -s)[:m]
            out += [(i, j, r + 1, n, -s, -t) for r, (t, n) in enumerate(neg)]
    return sorted(out)


def mined(spark, rows, **options):
    df = spark.createDataFrame([(i, v, lab, "x", 1, "y") for i, v, lab in rows], SCHEMA)
    return sorted(map(tuple, hn.hard_negatives(df, **options).collect()))


def f32(*v):
    return [float(np.float32(x)) for x in v]


def test_matches_brute_force_with_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(hn, "BUCKET_VALUES", 128)
    monkeypatch.setattr(hn, "ANCHORS", 4)
    monkeypatch.setattr(hn, "HELD", 2)
    rnd = random.Random(3)
    base = [[rnd.gauss(0, 1) for _ in range(6)] for _ in range(6)]
    rows = []
    for i in range(400):
        c, length = base[i % 6], rnd.choice([0.1, 0.5, 1, 1, 4])
        rows.append((i, f32(*(length * (x + rnd.gauss(0, 0.3)) for x in c)), i % 3))
    rows += [(400, None, 1), (401, f32(*[1] * 5) + [None], 1), (450, f32(*[1] * 5) + [float("nan")], 1),
             (None, f32(*[1] * 6), 1), (500, f32(*[1] * 6), None), (550, f32(*[0] * 6), 1), (551, [], 0),
             (600, f32(1, 2, 3), 1), (601, f32(1, 2, 2.5), 1), (602, f32(1, 1.5, 2), 0), (603, f32(0, 1, 2), 0),
             (700, rows[0][1], 0), (701, rows[0][1], 0), (702, rows[3][1], 1), (703, rows[3][1], 1),
             (50, rows[100][1], 2), (50, rows[100][1], 2)] + [rows[7]] * 5
    got = mined(spark, rows)
    assert got == brute(rows) and len(got) > 60
    assert mined(spark, rows, every=20, low=0, high=100) == brute(rows, every=20, low=0, high=100)


def test_small_tables(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(0, f32(1, 0), 1)]) == []
    rows = [(0, f32(1, 0), 1), (1, f32(1, 0), 1), (2, f32(0.9, 0.1), 2), (3, f32(-1, 0), 1)]
    assert mined(spark, rows) == brute(rows) == [(0, 1, 1, 2, 256 * 256, 230 * 256)]


def test_ranges_lose_nothing_and_prune():
    rng = np.random.default_rng(5)
    centre = rng.normal(size=(40, 8))
    x = np.floor(256 * (centre[rng.integers(0, 40, 3000)] + 0.05 * rng.normal(size=(3000, 8)))).astype(np.int64)
    b = hn.Bucket(np.arange(3000).astype("<i8").tobytes(), np.zeros(3000, "<i8").tobytes(), x.astype("<i4").tobytes())
    q = x[:50].astype(np.float64)
    norm = np.sqrt((q * q).sum(axis=1))
    score = x[:50] @ x.T
    pruned = 0
    for cut in (0.5, 0.9, 0.97):
        least = cut * norm * b.longest
        reach, lists = b.candidates(q, norm, least)
        for i in range(50):
            want = set(np.flatnonzero(score[i] >= least[i]).tolist())
            if not reach[i]:
                assert not want
            elif lists[i] is not None:
                pruned += 1
                assert want <= set(lists[i].tolist())
    assert pruned > 40


def test_buckets_that_are_too_short_are_not_shipped(spark, monkeypatch):
    monkeypatch.setattr(hn, "BUCKET_VALUES", 20)
    monkeypatch.setattr(hn, "HELD", 1)
    rows = [(i, f32(4, 0.01 * i), i % 2) for i in range(60)] + [(100 + i, f32(0.01, 0.01 * (i % 5)), i % 2) for i in range(400)]
    seen = {}
    plain = hn._shipped

    def spy(bodies, sizes, blocks, parts):
        out = plain(bodies, sizes, blocks, parts)
        seen.setdefault("groups", bodies.count())
        seen["asked"] = out.where("kind = 1").select("grp").distinct().count()
        return out
    monkeypatch.setattr(hn, "_shipped", spy)
    assert mined(spark, rows, every=59) == brute(rows, every=59)
    assert seen["asked"] < seen["groups"] / 2


def test_too_long_a_vector_raises(spark):
    with pytest.raises(Exception, match="too long"):
        mined(spark, [(0, f32(1e9, 1), 1)])
    with pytest.raises(ValueError):
        mined(spark, [], low=95, high=50)

"""The mixture against a plain version, and the exactness of the splitting tree."""

import hashlib
import math
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest

from ledgerlens.llm import mixing

SCHEMA = "doc_id long, text string, source string, s string, size int, h string"
WORD = re.compile("[^\x20\x09-\x0d]+")


def md5(*parts):
    return hashlib.md5("|".join("-" if p is None else f"={p}" for p in parts).encode()).hexdigest()


def targets(z):
    names = sorted(z, key=lambda s: (s is None, (s or "").encode()))
    w = {s: i % 3 + 1 for i, s in enumerate(names)}
    whole, capped = sum(z.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        lam = Fraction(whole - 3 * sum(z[s] for s in capped), sum(w[s] for s in free) or 1)
        more = {s for s in free if 3 * z[s] < lam * w[s]}
        if not more:
            return {s: Fraction(3 * z[s]) if s in capped else lam * w[s] for s in names}, {s: i for i, s in enumerate(names)}
        capped |= more


def plain(rows, seed, block_words):
    """Per document: (doc_id, size, source_size, target, taken)."""
    sized = [(i, s, len(WORD.findall(t or "")), hashlib.md5(t.encode()).hexdigest() if t is not None else None) for i, t, s in rows]
    z = Counter()
    for _, s, n, _ in sized:
        z[s] += n
    goal, number = targets(z)
    seen, units = Counter(), defaultdict(list)
    for i, s, n, m in sized:
        seen[i, s, n, m] += 1
        units[s].append((md5(seed, number[s], i, n, m, seen[i, s, n, m]), i, n))
    out = []
    for s, mine in units.items():
        take = min(math.floor(float(goal[s]) + 0.5), 3 * z[s])
        e, rest = divmod(take, z[s]) if z[s] else (0, 0)
        nb = max(1, -(-z[s] // block_words))
        blocks = defaultdict(list)
        for h, i, n in sorted(mine):
            blocks[int(h[:8], 16) * nb >> 32].append((h, i, n))
        taken = {h: e * n for h, _, n in mine}
        for b in sorted(blocks, key=lambda b: md5(seed, number[s], e, b)):
            for h, _, n in blocks[b]:
                part = min(n, rest)
                taken[h] += part
                rest -= part
        out += [(i, n, z[s], float(goal[s]), taken[h]) for h, i, n in mine]
    return sorted(out, key=repr)


def made():
    rows = [(i, " ".join(["wörd"] * (i % 37)), f"s{i % 5}" if i % 4 else "big") for i in range(600)]
    rows += [(1000, None, "s1"), (1001, "", "s2"), (1002, " \n\t", "s2"), (None, "a b c", "s3"), (1003, "x y", None),
             (1004, None, "empty"), (1005, "w " * 9000, "s4"), (1006, "tiny", "tiny"), (5, "same id", "s0")]
    return rows + [(2000, "equal rows of three", "s1")] * 40


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)


@pytest.fixture
def small(monkeypatch):
    for k, v in (("FAN", 4), ("GROUP", 2)):
        monkeypatch.setattr(mixing, k, v)


def test_documents_match_a_plain_version(spark, small):
    rows = made()
    got = mixing.mix_documents(frame(spark, rows), seed=5, block_words=64, shard_words=500)
    got = sorted(map(tuple, got.select("doc_id", "size", "source_size", "target", "taken").collect()), key=repr)
    want = plain(rows, 5, 64)
    assert [g[:3] + g[4:] for g in got] == [w[:3] + w[4:] for w in want]
    assert all(math.isclose(g[3], w[3]) and g[4] <= 3 * g[1] for g, w in zip(got, want))
    words, goal = Counter(), {}
    for i, n, zs, t, k in got:
        words[zs, t] += k
        goal[zs, t] = t
    assert all(abs(words[k] - goal[k]) <= 0.5 for k in goal)


def test_plan_is_exact_and_disjoint(spark, small):
    rows = made()
    units, plan, sources = mixing.mixture(frame(spark, rows), seed=5, block_words=64, shard_words=500)
    got = plan.collect()
    by_shard = defaultdict(list)
    for r in got:
        by_shard[r["shard"]].append(r["place"])
    assert len(by_shard) > 16 and all(sorted(p) == list(range(1, len(p) + 1)) for p in by_shard.values())
    uses = Counter((r["h"], r["epoch"]) for r in got)
    assert max(uses.values()) == 1
    again = mixing.mixture(frame(spark, rows).repartition(7), seed=5, block_words=64, shard_words=500)[1]
    assert sorted(map(tuple, again.collect()), key=repr) == sorted(map(tuple, got), key=repr)
    other = mixing.mixture(frame(spark, rows), seed=6, block_words=64, shard_words=500)[1]
    assert sorted((r["h"], r["shard"]) for r in other.collect()) != sorted((r["h"], r["shard"]) for r in got)


def test_texts_of_the_mix(spark, small):
    rows = [(i, "a\tb  c d", "x") for i in range(9)] + [(20 + i, "e f g", "y") for i in range(40)] + [(90, None, "x")]
    docs = frame(spark, rows)
    units, plan, sources = mixing.mixture(docs, block_words=8, shard_words=50)
    texts = mixing.mix_texts(docs, plan, sources).collect()
    assert len(texts) == plan.count()
    assert sum(len(WORD.findall(r["text"])) for r in texts) == sum(r["words"] for r in plan.collect())


def test_quotas_of_every_shard(spark, small):
    n = [(s, (s * 7) % 23 + 1) for s in range(11)]
    total = sum(k for _, k in n)
    got = mixing.shard_quotas(spark.createDataFrame(n, "s long, n long"), 11, total, 37, seed=1).collect()
    per_source, per_shard = Counter(), Counter()
    for r in got:
        per_source[r["s"]] += r["n"]
        per_shard[r["shard"]] += r["n"]
    assert per_source == dict(n)
    each, over = divmod(total, 37)
    assert [per_shard[i] for i in range(37)] == [each + (i < over) for i in range(37)]


def test_splits_follow_the_distribution():
    counts, room = np.array([30, 50, 20]), np.array([10, 40, 25, 25])
    draws = np.array([mixing.split_counts(counts, room, [seed]) for seed in range(2000)])
    assert (draws.sum(axis=1) == counts).all() and (draws.sum(axis=2) == room).all()
    assert np.allclose(draws.mean(axis=0), np.outer(room, counts) / 100, atol=0.25)
    # variance of the hypergeometric distribution
    p, k = counts / 100, room[:, None]
    assert np.allclose(draws.var(axis=0), k * p * (1 - p) * (100 - k) / 99, rtol=0.2)


def test_tables_without_words(spark):
    assert mixing.mix_documents(frame(spark, [])).collect() == []
    got = mixing.mix_documents(frame(spark, [(1, None, "a"), (2, "", None)])).collect()
    assert sorted((r["doc_id"], r["size"], r["target"], r["taken"]) for r in got) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]

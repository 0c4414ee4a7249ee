"""Suffix-array dedup against a plain dictionary of all windows."""

import hashlib
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as E
from ledgerlens.llm import suffix_dedup as sd
from tests.conftest import SF001


def brute(rows, length=100):
    """rows in their order: (id, bytes); equal rows of an id follow each other."""
    seen, out = set(), []
    for i, body in rows:
        gone = np.zeros(len(body), dtype=bool)
        for p in range(len(body) - length + 1):
            w = body[p:p + length]
            if w in seen:
                gone[p:p + length] = True
            else:
                seen.add(w)
        spans = sum(1 for p in range(len(body)) if gone[p] and (p == 0 or not gone[p - 1]))
        kept = bytes(b for b, g in zip(body, gone) if not g)
        out.append((i, len(body), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    got = Counter(tuple(r) for r in E.queries()["op1_suffix_dedup"](spark, SF001).collect())
    want = brute([(r["doc_id"], (r["text"] or "").encode()) for r in sorted(rows)])
    assert sum(k[2] > 0 for k in want) > 20
    assert got == want


@pytest.fixture(scope="module")
def planted():
    rng = np.random.default_rng(9)
    words = ["".join(chr(97 + c) for c in rng.integers(0, 26, 6)) for _ in range(400)]
    prose = lambda n: " ".join(rng.choice(words, n))
    line, passage = prose(9), prose(60)                # a line under 100 bytes, a passage over
    rows = [(i, f"{prose(30)} {line} {prose(10)}") for i in range(60)]
    rows += [(100 + i, f"{prose(8)}{passage}{prose(i % 5 * 9)}") for i in range(40)]
    rows += [(200, "a" * 5000), (201, "ab" * 130 + "a" * 150), (202, "Eationnt " * 300 + prose(20)),
             (203, (prose(12) + "\n") * 7), (204, ""), (205, None), (206, "é" * 49 + "x"), (207, "é" * 60),
             (208, passage[:99]), (209, passage[:100]), (210, "abc" * 400000 + prose(50))]
    return rows


@pytest.mark.parametrize("hot", [2000, 3])
def test_planted_cases(spark, planted, hot, monkeypatch):
    monkeypatch.setattr(sd, "HOT", hot)
    monkeypatch.setattr(sd, "PIECE", 4096)
    df = spark.createDataFrame(planted, "doc_id long, text string").repartition(5)
    got = Counter(tuple(r) for r in sd.suffix_dedup(df).collect())
    assert got == brute([(i, (t or "").encode()) for i, t in sorted(planted, key=lambda r: r[0])])


def test_nulls_repeated_ids_and_empty_table(spark, planted):
    rows = [(None, planted[70][1]), (5, planted[71][1]), (5, planted[71][1]), (5, planted[72][1]), (6, "short"),
            (None, None), (6, "short"), (9, planted[72][1])]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, n_removed string")
    got = Counter(tuple(r) for r in sd.suffix_dedup(df).collect())
    th = {r["text"]: r["h"] for r in df.selectExpr("text", "xxhash64(cast(coalesce(text, '') as binary)) as h").collect()}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, th[r[1]]))
    assert got == brute([(i, (t or "").encode()) for i, t in order])
    assert sd.suffix_dedup(df.limit(0)).count() == 0
    kept = {r["doc_id"]: r["kept"] for r in sd.suffix_dedup(df, with_text=True).where("doc_id = 9").collect()}
    assert len(kept[9]) < len(planted[72][1])


def test_equal_suffixes_groups(monkeypatch):
    rng = np.random.default_rng(4)
    text = rng.integers(97, 99, 3000).astype(np.uint8)
    text[1500:2000] = text[200:700]
    starts = np.arange(len(text) - 40)
    member, group = sd.equal_suffixes(text, starts, 40)
    want = {}
    for p in starts:
        want.setdefault(text[p:p + 40].tobytes(), []).append(int(p))
    got = {}
    for m, g in zip(member, group):
        got.setdefault(int(g), []).append(int(m))
    assert sorted(sorted(v) for v in got.values()) == sorted(v for v in want.values() if len(v) > 1)

"""The Merkle manifest against a plain recursive version."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree long, pos string, digest int"


def sha(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


def enc(v) -> str:
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(r, bump=0) -> str:
    n = r[4] + bump if r[4] is not None else None
    return sha("".join(map(enc, (r[0], r[3], r[2], n, r[1]))))


def climb(level, fan):
    """All levels from the leaves to the single top."""
    levels = [level]
    while len(level) > 1:
        level = [sha("".join(level[i:i + fan])) for i in range(0, len(level), fan)]
        levels.append(level)
    return levels


def steps(levels, pos, fan):
    for level in levels[:-1]:
        at = pos // fan * fan
        run = level[at:at + fan]
        yield "".join(run[:pos - at]), "".join(run[pos - at + 1:])
        pos //= fan


def expected(rows, fan):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for g in langs:
        mine = sorted((r for r in rows if r[2] == g), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[g] = mine, climb([leaf(r) for r in mine], fan)
    top = climb([trees[g][1][-1][0] for g in langs], fan)
    out = []
    for i, g in enumerate(langs):
        mine, levels = trees[g]
        for pos, r in enumerate(mine):
            path = [*steps(levels, pos, fan), *steps(top, i, fan)]
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[4] is not None
            fold = leaf(r, 1) if tampered else leaf(r)
            for left, right in path:
                fold = sha(left + fold + right)
            out.append((r[0], leaf(r), levels[-1][0], top[-1][0], sha("".join(a + b for a, b in path)), fold, not tampered))
    return sorted(out, key=repr)


def audited(spark, rows, fan):
    docs = spark.createDataFrame([(*r, 7, "x", 1) for r in rows], SCHEMA)
    tampered = merkle.leaf_digest(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars") + 1, F.col("text"))
    hit = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0) & F.col("n_chars").isNotNull()
    got = merkle.audit(docs, changed=F.when(hit, tampered), fan=fan)
    return sorted(map(tuple, got.collect()), key=repr)


ROWS = [(i, f"text {i} ä", ("de", "en", "fr")[i % 3], f"s{i % 4}", i) for i in range(75)] + [
    (100, "only one of its language", "zz", None, None), (None, "no id", "en", "s", 3), (None, None, None, None, None),
    (101, "", None, "s", 0), (102, "long " * 50_000, "en", "s", 250_000), (7, "same id, other text", "de", "s", 1),
    *[(200, "equal rows", "en", "s", 10)] * 13, (203, "a", "é", "s", 1)]


@pytest.mark.parametrize("fan,stride", [(2, 4096), (2, 4), (3, 9)])
def test_matches_a_recursive_version(spark, monkeypatch, fan, stride):
    monkeypatch.setattr(merkle, "STRIDE_NODES", stride)
    assert audited(spark, ROWS, fan) == expected(ROWS, fan)


def test_empty_table_and_single_row(spark):
    assert audited(spark, [], 2) == []
    one = [(5, "t", "en", "s", 1)]
    assert audited(spark, one, 2) == expected(one, 2)
    assert audited(spark, one, 2)[0][1] == audited(spark, one, 2)[0][3]


def test_equal_blocks_are_stored_once(spark, monkeypatch):
    monkeypatch.setattr(merkle, "STRIDE_NODES", 4)
    docs = spark.createDataFrame([(1, "t", "en", "s", 1, 0, "", 0)] * 64, SCHEMA)
    m = merkle.build_manifest(docs)
    assert [r.count() for r in m.trees.strides] == [2, 2, 2]
    assert m.leaves.count() == 64


def test_a_request_for_some_leaves_only(spark, monkeypatch):
    monkeypatch.setattr(merkle, "STRIDE_NODES", 8)
    docs = spark.createDataFrame([(*r, 7, "x", 1) for r in ROWS], SCHEMA)
    m = merkle.build_manifest(docs)
    asked = m.leaves.where("pos % 10 = 3").select("tree", "pos", F.col("digest").alias("known"))
    got = merkle.prove(m, asked).select("known", "digest", merkle.folded(merkle.hex_text(F.col("digest")), F.col("path")).alias("root")).collect()
    assert len(got) == asked.count() > 5
    assert all(bytes(r["known"]) == bytes(r["digest"]) and r["root"] == m.root.hex() for r in got)

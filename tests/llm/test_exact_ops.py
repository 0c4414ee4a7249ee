"""Contract operators against plain brute force, over the smoke tables and over
awkward rows (nulls, empty and repeated rows, clashing columns, empty tables)."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from tokenizers import Tokenizer

import __spark_entry__ as E
from ledgerlens.llm import line_dedup, packing, queries, simhash, token_output, topk
from tests.conftest import SF001

SCHEMA = "doc_id long, text string, lang string, gone string, n_lines string"
ROWS = [(3, "A b\n x \nc", "en", None, "q"), (3, "A b\n x \nc", "en", None, "q"), (None, "a B \n", None, None, None),
        (7, None, None, None, None), (8, "", "en", None, None), (1, "a b\nÉ\né", "fr", "x", "y"),
        (9, "w " * 30000 + "\n a b", "en", None, None), (10, "\n\n", "en", None, None)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]


def lines_brute(rows, least):
    key = lambda s: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s.strip(" \t\n\x0b\x0c\r"))
    seen = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            seen[key(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not key(x) or len(seen[key(x)]) < least]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return Counter(out)


def test_line_dedup_odd_rows(spark, odd):
    got = line_dedup.line_dedup(odd, min_docs=3)
    assert set(got.columns) == {"doc_id", "text", "lang", "gone", "n_lines", "n_dropped"}
    rows = Counter((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in got.collect())
    assert rows == lines_brute([(r[0], r[1]) for r in ROWS], 3)
    assert any(k[2] for k in rows)
    assert line_dedup.line_dedup(odd.limit(0)).count() == 0


def test_line_dedup_query(spark, docs):
    got = Counter(tuple(r) for r in E.queries()["op10_line_dedup"](spark, SF001)
                  .select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect())
    assert got == Counter((i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in lines_brute(docs, 10))


def simhash_brute(rows, words=3, radius=3):
    fps = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        grams = [b" ".join(w[i:i + words]) for i in range(max(1, len(w) - words + 1))] if w else []
        bits = Counter(b for g in grams for b in range(64) if xxhash.xxh64_intdigest(g, seed=42) >> b & 1)
        fps.append(sum(1 << b for b in range(64) if bits[b] * 2 > len(grams)))
    comp = list(range(len(rows)))
    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i
    f = np.array(fps, dtype=np.uint64)
    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(f ^ f[i]) <= radius):
            comp[root(int(j))] = root(i)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return Counter((d, f"{fps[i]:016x}", least.get(root(i))) for i, (d, _) in enumerate(rows))


def dedup_brute(rows, words=3, radius=3):
    """Rows that stay: fingerprints within the radius and sketches that agree."""
    fps = [int(f, 16) for _, f, _ in (next(iter(simhash_brute([r], words))) for r in rows)]
    bins = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        grams = [b" ".join(w[i:i + words]) for i in range(max(1, len(w) - words + 1))] if w else []
        low = {}
        for h in (xxhash.xxh64_intdigest(g, seed=42) for g in grams):
            low[h & 255] = min(h, low.get(h & 255, h))
        bins.append({k: h >> 8 & 1 for k, h in low.items()})
    comp = list(range(len(rows)))
    f = np.array(fps, dtype=np.uint64)
    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i
    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(f ^ f[i]) <= radius):
            a, b = bins[i], bins[int(j)]
            if sum(a.get(k) != b.get(k) for k in a.keys() | b.keys()) <= (1 - simhash.AGREE) * len(a.keys() | b.keys()):
                comp[root(int(j))] = root(i)
    best = {}
    for i, (d, t) in enumerate(rows):
        mine = (d is None, d or 0, t or "")
        best[root(i)] = min(best.get(root(i), mine), mine)
    return sorted((d, t) for _, d, t in best.values())


def test_simhash_query(spark, docs):
    got = Counter(tuple(r) for r in E.queries()["op7_simhash"](spark, SF001).collect())
    assert got == simhash_brute(docs)


def test_simhash_odd_rows_and_small_tiles(spark, odd):
    g = simhash.simhash_groups(odd, words=3)
    got = Counter((r["doc_id"], f"{r['fp'] & (1 << 64) - 1:016x}", r["component_id"]) for r in g.collect())
    assert got == simhash_brute([(r[0], r[1]) for r in ROWS])
    assert simhash.simhash_groups(odd.limit(0)).count() == 0
    left = simhash.simhash_dedup(odd)
    assert left.columns == odd.columns and simhash.simhash_dedup(odd.limit(0)).count() == 0
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in left.collect()) == \
        [(d or 0, t) for d, t in dedup_brute([(r[0], r[1]) for r in ROWS])]


def test_simhash_dedup_keeps_texts_that_share_no_passage(spark, monkeypatch):
    # two kinds of word in every place: each shingle is one of eight, so all fingerprints tend to one
    rnd = np.random.default_rng(9)
    rows = [(i, " ".join(rnd.choice(["to", "be"], 3000))) for i in range(25)]
    phrase = " ".join(f"w{i}" for i in range(400))
    rows += [(100 + i, phrase + f" {i}" * (i % 3)) for i in range(9)] + [(7, phrase), (100, "an id with two texts"), (200, phrase)]
    monkeypatch.setattr(simhash, "TILE", 8)
    df = spark.createDataFrame([(d, t, "sketch", 1, 2) for d, t in rows], "doc_id long, text string, sketch string, fp int, n int")
    got = sorted((r["doc_id"], r["text"]) for r in simhash.simhash_dedup(df).collect())
    want = dedup_brute(rows)
    assert got == want
    # the large group of the phrase leaves its smallest id, a repeated id keeps its other text
    assert (7, phrase) in got and (100, "an id with two texts") in got and not any(d in (101, 103, 200) for d, _ in got)


@pytest.mark.parametrize("same,agree", [(1.0, True), (0.9, True), (0.4, False), (0.0, False)])
def test_sketches_follow_the_similarity(same, agree):
    rng = np.random.default_rng(2)
    shared, own = int(800 * 2 * same / (1 + same)), 800
    common = rng.integers(0, 1 << 63, shared, dtype=np.uint64)
    pair = [np.concatenate([common, rng.integers(0, 1 << 63, own - shared, dtype=np.uint64)]) for _ in range(2)]
    a, b = (np.frombuffer(simhash.sketch(h), "<u8").reshape(1, 8) for h in pair)
    assert simhash.alike(a, b)[0] == agree


def test_simhash_dedup_on_the_documents(spark, docs):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted(tuple(r) for r in simhash.simhash_dedup(df).collect()) == dedup_brute(docs)


@pytest.mark.parametrize("tile", [3, 4096])
def test_tile_links_join_exactly_the_close_prints(spark, tile):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    near = base ^ (np.uint64(1) << rng.integers(0, 64, 40).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 40).astype(np.uint64))
    fps = np.unique(np.concatenate([base, near, base ^ np.uint64(0xF), [np.uint64(0)]]))
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    parent = {int(x): int(x) for x in fps}
    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for r in simhash.tile_links(df, 3, tile).collect():
        a, b = (x & (1 << 64) - 1 for x in r)
        parent[root(a)] = root(b)
    got = {frozenset(int(y) for y in fps if root(int(y)) == root(int(x))) for x in fps}
    comp = np.arange(len(fps))
    for _ in range(len(fps)):
        comp = np.array([comp[np.bitwise_count(fps ^ x) <= 3].min() for x in fps])
    assert got == {frozenset(int(y) for y in fps[comp == c]) for c in set(comp)}


def ids_of(rows):
    tok = Tokenizer.from_file(queries.TOKENIZER)
    return [(d, tok.encode(t or "", add_special_tokens=False).ids + [1]) for d, t in rows]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def test_token_output_query(spark, docs):
    want, at = [], 0
    for d, ids in sorted(ids_of(docs), key=lambda x: x[0]):
        want.append((d, at, len(ids), crc(ids)))
        at += len(ids)
    got = [tuple(r) for r in E.queries()["op5_token_output"](spark, SF001).orderBy("doc_id").collect()]
    assert got == want


def test_token_files_by_document(spark, odd, tmp_path):
    m = token_output.write_tokens(odd, f"file://{tmp_path}", queries.TOKENIZER).collect()
    want = dict((d, ids) for d, ids in ids_of([(r[0], r[1]) for r in ROWS]))
    for d in (3, 7, 8, 9):
        found = [a for r in m for a in token_output.read_file(r["path"]).find(d)]
        assert len(found) == (2 if d == 3 else 1)
        assert all(a.tolist() == want[d] for a in found)
    assert sum(r["n_docs"] for r in m) == len(ROWS)
    path = m[0]["path"].removeprefix("file://")
    raw = bytearray(open(path, "rb").read())
    raw[20] ^= 0xFF
    open(path, "wb").write(raw)
    with pytest.raises(Exception):
        for i in range(m[0]["n_docs"]):
            token_output.read_file(path).document(i)


def test_token_output_empty_and_nulls(spark, odd):
    assert token_output.token_output(odd.limit(0), queries.TOKENIZER).count() == 0
    rows = token_output.token_output(odd, queries.TOKENIZER).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == [None, 1, 3, 3, 7, 8, 9, 10]
    assert all(b["start"] == a["start"] + a["n_tokens"] for a, b in zip(rows, rows[1:]))


def check_packing(rows, want, size):
    pieces = defaultdict(list)
    for r in rows:
        pieces[r["sequence_id"]].append((r["offset"], r["length"]))
    for p in pieces.values():
        p.sort()
        at = 0
        for o, n in p:
            assert o == at
            at += n
        assert at <= size
    cut = Counter((d, k, a, len(ids[a:a + size]), crc(ids[a:a + size])) for d, ids in want
                  for k, a in enumerate(range(0, len(ids), size)))
    assert cut == Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows)
    least = -(-sum(len(i) for _, i in want) // size)
    assert len(pieces) <= least * 1.02 + 2


def test_packing_query(spark, docs):
    check_packing(E.queries()["op6_packing"](spark, SF001).collect(), ids_of(docs), 4096)


def test_packing_odd_rows_and_hot_length(spark, odd, monkeypatch):
    monkeypatch.setattr(packing, "RANK_ROWS", 2)
    want = ids_of([(r[0], r[1]) for r in ROWS])
    check_packing(packing.pack_documents(odd, queries.TOKENIZER, size=7).collect(), want, 7)
    assert packing.pack_documents(odd.limit(0), queries.TOKENIZER).count() == 0
    seq = packing.sequences(odd.where("doc_id <> 3"), packing.pack_documents(odd.where("doc_id <> 3"), queries.TOKENIZER),
                            queries.TOKENIZER).collect()
    assert Counter(i for s in seq for i in s["ids"]) == Counter(i for d, ids in want if d not in (3, None) for i in ids)


def test_fullest_combination_is_the_best_subset():
    rng = np.random.default_rng(2)
    for _ in range(60):
        counts = {int(k): int(rng.integers(1, 4)) for k in rng.integers(1, 30, 5)}
        room = int(rng.integers(1, 60))
        combo = packing.fullest(counts, sorted(counts, reverse=True), room)
        sums = {0}
        for k, n in counts.items():
            sums = {s + k * i for s in sums for i in range(n + 1) if s + k * i <= room}
        assert sum(k * n for k, n in combo.items()) == max(sums)
        assert all(n <= counts[k] for k, n in combo.items())


def topk_brute(rows, k, every):
    ok = sorted({(i, tuple(int(np.floor(256 * float(np.float32(x)))) for x in v)) for i, v in rows})
    out = []
    for i, v in ok:
        if i % every == 0:
            s = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in ok if j != i)
            out += [(i, r + 1, j, -t) for r, (t, j) in enumerate(s[:k])]
    return sorted(out)


def test_topk_query(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF001}/embeddings.parquet").collect()]
    got = sorted(tuple(r) for r in E.queries()["op2_exact_topk"](spark, SF001).collect())
    assert got == topk_brute(rows, 5, 50)


def test_topk_ties_blocks_and_odd_vectors(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 4) * (1 + i % 3)]) for i in range(200)]
    rows += [(1000 + i, [1.0, 2.0, 3.0, 4.0]) for i in range(60)]
    bad = [(2000, None), (2001, [None, 1.0, 1.0, 1.0]), (2002, [float("nan"), 1.0, 1.0, 1.0]),
           (2003, [float("inf"), 0.0, 0.0, 0.0]), (2004, []), (2005, [1.0]), (None, [1.0] * 4), rows[0]]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>").withColumnRenamed("x", "score")
    for block in (4096, 16):
        monkeypatch.setattr(topk, "BLOCK", block)
        got = sorted(tuple(r) for r in topk.top_k(df, k=5, every=20, n_pivots=7).collect())
        assert got == topk_brute(rows, 5, 20)
    assert topk.top_k(df.limit(0)).count() == 0
    assert topk.top_k(df.where("vec_id = 0"), every=20).count() == 0


def test_another_vocabulary_goes_through_the_tokenizer(tmp_path, docs):
    import json

    from ledgerlens.llm.tokens import WordEncoder
    form = json.load(open(queries.TOKENIZER))
    form["normalizer"]["normalizers"] = form["normalizer"]["normalizers"][:2]          # keeps the case
    path = str(tmp_path / "cased.json")
    json.dump(form, open(path, "w"))
    known, cased = WordEncoder(queries.TOKENIZER), WordEncoder(path)
    assert known.known and not cased.known
    own = [Tokenizer.from_file(p) for p in (queries.TOKENIZER, path)]
    odd = ["It's THE Café don't, 3.5 x²", "a\tb c", "'s 's't <|endoftext|> é", "", " \n ", "Ünïcode ǆ ß ſ İ"]
    for text in [t or "" for _, t in docs[:60]] + odd:
        for enc, tok in zip((known, cased), own):
            want = np.array(tok.encode(text, add_special_tokens=False).ids, dtype=enc.dtype).tobytes()
            assert enc.encode(text) == want


def test_the_cache_forgets_without_harm(monkeypatch, docs):
    from ledgerlens.llm import tokens
    monkeypatch.setattr(tokens, "_MOST", 50)
    enc, tok = tokens.WordEncoder(queries.TOKENIZER), Tokenizer.from_file(queries.TOKENIZER)
    for _, t in docs[:80]:
        assert enc.encode(t or "") == np.array(tok.encode(t or "", add_special_tokens=False).ids, dtype=enc.dtype).tobytes()

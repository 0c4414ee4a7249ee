"""Toxicity and quality: the index against brute force, held-out accuracy on
the labels, and awkward rows."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from ledgerlens.llm import quality, toxicity
from ledgerlens.llm.queries import id_crc

SF01 = "/root/testdata/sf0.1"


def test_block_max_search_equals_brute_force():
    rng = np.random.default_rng(3)
    vectors = []
    for _ in range(300):
        t = np.unique(rng.integers(0, 40, int(rng.integers(0, 8))))
        w = rng.random(len(t)) + 0.1
        vectors.append((t, w / np.sqrt((w * w).sum()) if len(t) else w))
    vectors[17] = vectors[250] = vectors[40]
    dense = np.zeros((300, 40))
    for i, (t, w) in enumerate(vectors):
        dense[i, t] = w
    for block in (7, 64, 1000):
        index = toxicity.BlockMaxIndex(vectors, 40, block)
        for q in range(0, 300, 9):
            t, w = vectors[q]
            if not len(t):
                continue
            ids, sims = index.search(t, w, 5, q)
            cos = np.round(dense @ dense[q], 12)
            cos[q] = 0
            want = [i for i in np.lexsort((np.arange(300), -cos))[:5] if cos[i] > 1e-12]
            assert ids.tolist() == want and np.allclose(sims, cos[want])


def held(rows, mod, rest):
    return {r["doc_id"]: zlib.crc32(str(r["doc_id"]).encode()) % mod == rest for r in rows}


@pytest.mark.parametrize("name,label,mod,rest,least", [("op9_toxicity", "toxic", 5, 0, 0.95), ("op8_quality", "quality", 3, 1, 0.97)])
def test_held_out_accuracy(spark, name, label, mod, rest, least):
    got = E.queries()[name](spark, SF01).collect()
    labels = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()}
    out = held(got, mod, rest)
    assert all(r["held_out"] == out[r["doc_id"]] for r in got)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    assert len(got) == spark.read.parquet(f"{SF01}/documents.parquet").count()
    test = [r for r in got if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in test]) >= least
    s, y = np.array([r["score"] for r in test]), np.array([labels[r["doc_id"]] for r in test])
    assert (s[y == 1][:, None] > s[y == 0][None, :]).mean() > 0.9


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, ("nice words about the sea and boats " * (1 + i % 3)) + ("awful moron stuff" if i % 4 == 0 else ""), "x")
            for i in range(200)]
    rows += [(None, "moron here", "x"), (500, None, "x"), (501, "", "x"), (502, "moron " * 20000, "x"), (3, rows[3][1], "x")]
    labels = [(i, int(i % 4 != 0), int(i % 4 == 0)) for i in range(200)] + [(3, 1, 0), (None, 1, 1), (9, None, None)]
    return (spark.createDataFrame(rows, "doc_id long, text string, score string"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_odd_rows(spark, odd):
    docs, labels = odd
    fold = id_crc() % 5 == 0
    t = toxicity.toxicity_scores(docs, labels, fold)
    assert t.columns == ["doc_id", "text", "score", "evidence"]
    rows = t.collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert all((r["score"] >= 0.5) == ("moron" in (r["text"] or "")) for r in rows)
    toxic = [r for r in rows if r["score"] >= 0.5]
    assert all(r["evidence"] and all(e % 4 == 0 for e in r["evidence"]) for r in toxic)
    q = quality.quality_scores(docs, labels, fold).collect()
    assert len(q) == docs.count() and all(0 <= r["score"] <= 1 for r in q)
    for fn in (toxicity.toxicity_scores, quality.quality_scores):
        assert fn(docs.limit(0), labels, fold).count() == 0
        none = fn(docs, labels.limit(0), fold).collect()
        assert len(none) == docs.count() and len({r["score"] for r in none}) == 1


def test_held_out_labels_are_never_used(spark, odd):
    docs, labels = odd
    fold = id_crc() % 5 == 0
    flipped = labels.withColumn("toxic", F.when(fold, 1 - F.col("toxic")).otherwise(F.col("toxic"))) \
        .withColumn("quality", F.when(fold, 1 - F.col("quality")).otherwise(F.col("quality")))
    for fn in (toxicity.toxicity_scores, quality.quality_scores):
        a, b = (sorted((r["doc_id"] or -1, r["score"]) for r in fn(docs, x, fold).collect()) for x in (labels, flipped))
        assert a == b


def test_pairwise_weights_prefer_the_good_side():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 3))
    y = (x[:, 0] - 0.5 * x[:, 2] + rng.normal(size=400) * 0.1 > 0).astype(int)
    good, bad = np.flatnonzero(y), np.flatnonzero(1 - y)
    w = quality.bradley_terry(x, rng.choice(good, 2000), rng.choice(bad, 2000))
    assert w[0] > 0 > w[2] and abs(w[1]) < abs(w[2])


def test_texts_of_one_labelled_id_are_chosen_alike_in_every_run(spark):
    from ledgerlens.llm.common import one_per_id
    rows = [(i % 7, f"text {i}", i % 2) for i in range(50)] + [(9, None, 1)]
    df = spark.createDataFrame(rows, "doc_id long, body string, y int")
    runs = [sorted(map(tuple, one_per_id(d, "doc_id", "body").collect())) for d in (df, df.repartition(5), df.orderBy(F.rand(2)))]
    assert runs[0] == runs[1] == runs[2] and [r[0] for r in runs[0]] == [0, 1, 2, 3, 4, 5, 6, 9]
    assert one_per_id(df, "doc_id", "body").columns == df.columns


def test_clashing_columns_of_the_classifiers(spark):
    docs = spark.createDataFrame([(1, "bad bad word", 1, "x", 2.0), (2, None, 2, "y", 3.0), (1, "fine", 3, "z", 4.0)],
                                 "doc_id long, text string, __scored int, evidence string, score double")
    labels = spark.createDataFrame([(1, 1, 1), (2, 0, 0)], "doc_id long, toxic int, quality int")
    out = toxicity.toxicity_scores(docs, labels, F.lit(False))
    assert sorted(r["__scored"] for r in out.collect()) == [1, 2, 3]
    assert quality.quality_scores(docs, labels, F.lit(False)).where("score BETWEEN 0 AND 1").count() == 3


def test_quality_is_fitted_on_every_labelled_row(spark):
    # the scaling and the threshold of every row, in one block or in many; more rows than one fit held before
    texts = ["the sea and the boats are calm today", "a calm day, with boats and the sea!", "x x x x $$$ x x x", "$$ y y y y y y $$"]
    docs = spark.range(16_000).select(F.col("id").alias("doc_id"), F.concat(
        F.element_at(F.array(*map(F.lit, texts)), (F.col("id") % 4 + 1).cast("int")), F.repeat(F.lit(" and so on"), (F.col("id") % 9).cast("int"))).alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 4 < 2).cast("int").alias("quality"))
    one, many = (quality.fit(docs, labels, F.lit(False), block_rows=n) for n in (1 << 20, 512))
    x = np.stack([quality.features(r["text"]) for r in docs.collect()])
    for model in (one, many):
        assert np.allclose(model.mean, x.mean(axis=0)) and np.allclose(model.scale, x.std(axis=0), atol=1e-6)
        s = np.sort(model.raw(x))
        assert np.isclose(model.threshold, (s[7999] + s[8000]) / 2)
        assert ((model.score(x) >= 0.5) == (np.arange(16_000) % 4 < 2)).all()
    assert np.allclose(many.weights, quality.fit(docs.repartition(7), labels, F.lit(False), block_rows=512).weights)


def test_quality_pairs_hold_every_row_and_rare_labels_reach_every_block(spark):
    for y in ([1, 0, 0, 0, 0], [1, 1, 1, 0, 1], [1, 0], [1] * 7 + [0] * 7):
        y = np.array(y)
        good, bad = quality.block_pairs(y, 4)
        assert set(good) | set(bad) == set(range(len(y))) and (y[good] == 1).all() and (y[bad] == 0).all()
        assert len(set(zip(good, bad))) == len(good)
    assert len(quality.block_pairs(np.ones(3), 4)[0]) == 0
    docs = spark.range(600).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 3, "$ $ $ $").otherwise(
        F.concat(F.lit("calm words on the sea "), F.col("id").cast("string"))).alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") >= 3).cast("int").alias("quality"))
    rows = quality.quality_scores(docs, labels, F.lit(False), block_rows=20).collect()
    assert all((r["score"] >= 0.5) == (r["doc_id"] >= 3) for r in rows)

"""The corpus pipeline stage by stage against plain versions of its decisions."""

from collections import Counter

import corpus_pipeline as cp
from ledgerlens.llm import queries, toxicity
from ledgerlens.llm.common import read, shared_table
from tests.conftest import SF001
from tests.llm.test_decontam import brute as contaminated_brute
from tests.llm.test_exact_ops import check_packing, dedup_brute, ids_of, lines_brute


def test_each_stage_on_its_own_input(spark):
    docs = read(spark, SF001, "documents")
    assert [n for n, _ in cp.STAGES] == ["toxicity", "line_dedup", "simhash", "decontamination", "packing"]

    scored = toxicity.toxicity_scores(docs, read(spark, SF001, "labels"), queries.id_crc() % 5 == 0).collect()
    kept = shared_table(cp.drop_toxic(spark, docs, SF001), "t1")
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in scored if r["score"] < 0.5}

    rows = [(r["doc_id"], r["text"]) for r in kept.collect()]
    lined = shared_table(cp.drop_common_lines(spark, kept, SF001), "t2")
    assert lined.columns == docs.columns and lined.schema == docs.schema
    assert Counter((r["doc_id"], r["text"]) for r in lined.collect()) == \
        Counter((i, t) for i, _, _, t in lines_brute(rows, 10).elements())
    assert all(r["n_chars"] == len(r["text"]) for r in lined.collect())

    rows = [(r["doc_id"], r["text"]) for r in lined.collect()]
    single = shared_table(cp.drop_near_copies(spark, lined, SF001), "t3")
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(d for d, _ in dedup_brute(rows))

    rows = [(r["doc_id"], r["text"]) for r in single.collect()]
    items = [tuple(r) for r in read(spark, SF001, "benchmark").select("item_id", "text").collect()]
    clean = shared_table(cp.drop_contaminated(spark, single, SF001), "t4")
    bad = {d for d, _ in contaminated_brute(rows, items)}
    assert sorted(r["doc_id"] for r in clean.collect()) == sorted(d for d, _ in rows if d not in bad)

    rows = [(r["doc_id"], r["text"]) for r in clean.collect()]
    packed = cp.pack_sequences(spark, clean, SF001).collect()
    check_packing(packed, ids_of(rows), 4096)

    whole = cp.run(spark, SF001).collect()
    assert Counter(r[:5] for r in whole) == Counter(r[:5] for r in packed)
    assert cp.ORACLE_SQL is None and queries.QUERIES["pipeline"] is cp.run


def test_stages_keep_odd_rows_whole(spark):
    docs = spark.createDataFrame([(1, "a plain text", "en", "s", 12), (2, None, None, None, None), (None, "x y z", "en", "s", 5),
                                  (4, "", "en", None, 0)], read(spark, SF001, "documents").schema)
    for _, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, SF001)
        assert out.columns == docs.columns
        assert {r["doc_id"] for r in out.collect()} >= {1, 2, None}
        assert stage(spark, docs.limit(0), SF001).count() == 0
    assert cp.pack_sequences(spark, docs, SF001).count() == 4

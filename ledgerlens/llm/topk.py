"""Exact top-k search by inner product with a pivot-distance index.

Inner products become distances by one added component, sqrt(M^2 - |x|^2) with M
the largest norm: |q - x|^2 = |q|^2 + M^2 - 2 <q, x>. Every vector is keyed by its
nearest pivot and its distance to it; sorted by that key the table is cut into
annuli. A query first searches its own annulus, which bounds its k-th best
score, then the other annuli in the order of their triangle-inequality bounds
| |q - p| - r | until the bound passes the k-th best."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shared_table

#: Vectors in a block (several annuli) and queries in a block.
BLOCK, QUERIES, ANNULUS = 4096, 512, 256


def quantise(vec: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component, as long."""
    return F.transform(vec, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))


def _usable(vec: Column) -> Column:
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x.cast("double"))
                   | (F.abs(x.cast("double")) == F.lit(float("inf"))))
    return vec.isNotNull() & ~F.coalesce(bad, F.lit(True))


def _scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products: through floats where no sum can leave
    their exact range, else in 64-bit integers."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, q.shape[1])
    if most < 2.0 ** 52:
        return np.rint(q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    return q @ x.T


def _lift(x: np.ndarray, top: float) -> np.ndarray:
    f = x.astype(np.float64)
    rest = np.sqrt(np.maximum(top - (f * f).sum(axis=1), 0.0))
    return np.concatenate([f, rest[:, None]], axis=1)


def _dist(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2.0 * (a @ b.T)
    return np.sqrt(np.maximum(d, 0.0))


def _matrix(col, n: int) -> np.ndarray:
    return col.flatten().to_numpy().reshape(n, -1) if n else np.empty((0, 0), dtype=np.int64)


class Best:
    """The k best (score, id) of each query of a block; ties to smaller ids."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.score = np.full((n, k), np.iinfo(np.int64).min)
        self.id = np.full((n, k), np.iinfo(np.int64).max)

    def add(self, rows: np.ndarray, score: np.ndarray, ids: np.ndarray, hide: np.ndarray) -> None:
        low = np.iinfo(np.int64).min
        score = np.where(hide, low, score)
        # most columns are below the k-th best already
        cols = np.flatnonzero((score >= self.score[rows, -1][:, None]).any(axis=0) & ~hide.all(axis=0))
        if not len(cols):
            return
        s = np.concatenate([self.score[rows], score[:, cols]], axis=1)
        i = np.concatenate([self.id[rows], np.where(hide[:, cols], np.iinfo(np.int64).max, ids[cols])], axis=1)
        order = np.lexsort((i, -np.maximum(s, low + 1)), axis=1)[:, :self.k]
        self.score[rows] = np.take_along_axis(s, order, axis=1)
        self.id[rows] = np.take_along_axis(i, order, axis=1)

    def rows(self, query_ids: np.ndarray):
        real = self.id < np.iinfo(np.int64).max
        q = np.repeat(query_ids, real.sum(axis=1))
        return q, self.id[real], self.score[real]


def search_block(best: Best, q: np.ndarray, q_id: np.ndarray, q_lift: np.ndarray, q_norm: np.ndarray,
                 top: float, x: np.ndarray, x_id: np.ndarray, pivot: np.ndarray, dist: np.ndarray,
                 pivots: np.ndarray, know: np.ndarray) -> None:
    """Expand the annuli of one block for one query block. ``know``: scores that
    the k-th best of each query is known to reach."""
    cuts = np.flatnonzero(np.concatenate([[True], pivot[1:] != pivot[:-1]]))
    edges = sorted({*cuts.tolist(), *range(0, len(x), ANNULUS), len(x)})
    spans = list(zip(edges[:-1], edges[1:]))
    to = _dist(q_lift, pivots[[pivot[a] for a, _ in spans]])
    inner, outer = (np.array([f(dist[a:b]) for a, b in spans]) for f in (np.min, np.max))
    bound = np.maximum(np.maximum(inner[None, :] - to, to - outer[None, :]), 0.0)
    # the score that a vector at that distance has, with room for rounding
    reach = (q_norm[:, None] + top - bound * bound) / 2.0
    reach += 1e-6 * (np.abs(reach) + top) + 1.0
    for s in np.argsort(-reach.max(axis=0), kind="stable"):
        floor = np.maximum(best.score[:, -1], know)
        rows = np.flatnonzero(reach[:, s] >= floor)
        if len(rows):
            a, b = spans[s]
            best.add(rows, _scores(q[rows], x[a:b]), x_id[a:b], x_id[None, a:b] == q_id[rows, None])


def build_index(vectors: DataFrame, n_pivots: int = 64) -> tuple[DataFrame, np.ndarray, float]:
    """(blocks table, pivots, largest squared norm) for (vec_id, q) rows.

    Pivots are ``n_pivots`` vectors in hash order (a bounded choice that steers
    speed alone; every vector is indexed). Blocks come from a range deal over
    (pivot, distance, vec_id), so equal vectors split too."""
    norm = F.aggregate("q", F.lit(0).cast("long"), lambda s, v: s + v * v)
    top = float(vectors.agg(F.max(norm).alias("m")).first()["m"] or 0)
    picked = vectors.select("vec_id", "q", F.xxhash64("vec_id", "q").alias("h")).orderBy("h", "vec_id").limit(n_pivots)
    pivots = np.unique(_lift(np.array([r["q"] for r in picked.collect()], dtype=np.int64), top), axis=0)

    def key(frames):
        for b in frames:
            if b.num_rows:
                d = _dist(_lift(_matrix(b.column(1), b.num_rows), top), pivots)
                near = d.argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array(near.astype(np.int32)),
                     pa.array(d[np.arange(len(near)), near])], names=["vec_id", "q", "pivot", "dist"])

    keyed = shared_table(vectors.mapInArrow(key, "vec_id long, q array<long>, pivot int, dist double"), "pivot-keys")
    ranged = keyed.repartitionByRange("pivot", "dist", "vec_id").sortWithinPartitions("pivot", "dist", "vec_id")

    def cut(frames):
        held = []
        for b in frames:
            held.append(b)
            while sum(h.num_rows for h in held) >= BLOCK:
                t = pa.Table.from_batches(held).combine_chunks()
                yield _block(t.slice(0, BLOCK))
                held = t.slice(BLOCK).to_batches()
        if held and sum(h.num_rows for h in held):
            yield _block(pa.Table.from_batches(held))

    return shared_table(ranged.mapInArrow(cut, "ids binary, q binary, pivot binary, dist binary"), "pivot-blocks"), pivots, top


def _block(t: pa.Table) -> pa.RecordBatch:
    t = t.combine_chunks()
    cols = [t.column("vec_id").to_numpy().astype("<i8"),
            t.column("q").combine_chunks().flatten().to_numpy().astype("<i8"),
            t.column("pivot").to_numpy().astype("<i4"), t.column("dist").to_numpy().astype("<f8")]
    return pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in cols],
                                      names=["ids", "q", "pivot", "dist"])


def _open_block(ids: bytes, q: bytes, pivot: bytes, dist: bytes):
    ids = np.frombuffer(ids, "<i8")
    return ids, np.frombuffer(q, "<i8").reshape(len(ids), -1), np.frombuffer(pivot, "<i4"), np.frombuffer(dist, "<f8")


def top_k(embeddings: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id",
          vec_col: str = "embedding", scale: int = 256, n_pivots: int = 64) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` best inner products for each
    row whose id is divisible by ``every``, over all other rows.

    Vectors that are null, empty, or hold a null or non-finite component, and
    rows without an id, take no part; vectors of the most frequent length are
    compared (others have no inner product with them; ties to the shorter).
    Equal rows count once. Different vectors of one id are candidates of their
    own, though never of their own id; such a query id is answered once, for the
    vector of the smallest hash.
    Fewer candidates give fewer rows, an empty table none; further columns are
    ignored. Scores must fit 64 bits.

    Query blocks are dealt to every index part (the query set grows with the
    table, so it is not broadcast); a task holds one part of the index and
    streams the query blocks."""
    spark = embeddings.sparkSession
    vec = F.col(vec_col)
    usable = embeddings.where(F.col(id_col).isNotNull() & _usable(vec) & (F.size(vec) > 0))
    lengths = usable.groupBy(F.size(vec).alias("n")).count().orderBy(F.desc("count"), "n").first()
    empty = "query_id long, rank int, vec_id long, score long"
    if lengths is None:
        return spark.createDataFrame([], empty)
    vectors = usable.where(F.size(vec) == lengths["n"]) \
        .select(F.col(id_col).cast("long").alias("vec_id"), quantise(vec, scale).alias("q")) \
        .dropDuplicates(["vec_id", "q"])
    blocks, pivots, top = build_index(vectors, n_pivots)

    def seed(frames):
        """Query blocks out of index blocks, with what their own block gives."""
        for b in frames:
            for args in zip(*(b.column(i).to_pylist() for i in range(4))):
                ids, x, pivot, dist = _open_block(*args)
                mine = np.flatnonzero(ids % every == 0)
                for i in range(0, len(mine), QUERIES):
                    m = mine[i:i + QUERIES]
                    best, lift = Best(len(m), k), _lift(x[m], 0.0)
                    lift[:, -1] = 0.0
                    norm = (lift * lift).sum(axis=1)
                    low = np.full(len(m), np.iinfo(np.int64).min)
                    search_block(best, x[m], ids[m], lift, norm, top, x, ids, pivot, dist, pivots, low)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([c.tobytes()], pa.binary()) for c in (ids[m], x[m], best.score[:, -1])],
                        names=["ids", "q", "know"])

    queries = shared_table(blocks.mapInArrow(seed, "ids binary, q binary, know binary"), "query-blocks")
    parts = max(1, -(-blocks.count() // 4))
    none = F.lit(None).cast("binary")
    dealt = blocks.select(F.pmod(F.xxhash64("ids"), F.lit(parts)).alias("part"), F.lit(0).alias("kind"),
                          "ids", "q", "pivot", "dist", none.alias("know")) \
        .unionByName(queries.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("part"),
                                    F.lit(1).alias("kind"), "ids", "q", none.alias("pivot"), none.alias("dist"), "know")) \
        .repartition(parts, "part").sortWithinPartitions("part", "kind")

    def search(frames):
        part, held = None, []
        for b in frames:
            for row in zip(*(b.column(i).to_pylist() for i in range(7))):
                if row[0] != part:
                    part, held = row[0], []
                if row[1] == 0:
                    held.append(_open_block(*row[2:6]))
                    continue
                q_id = np.frombuffer(row[2], "<i8")
                q = np.frombuffer(row[3], "<i8").reshape(len(q_id), -1)
                know = np.frombuffer(row[6], "<i8")
                best, lift = Best(len(q_id), k), _lift(q, 0.0)
                lift[:, -1] = 0.0
                norm = (lift * lift).sum(axis=1)
                for ids, x, pivot, dist in held:
                    search_block(best, q, q_id, lift, norm, top, x, ids, pivot, dist, pivots, know)
                out = best.rows(q_id)
                if len(out[0]):
                    code = np.array([xxhash.xxh64_intdigest(v.tobytes()) >> 1 for v in q])
                    out = (*out, np.repeat(code, (best.id < np.iinfo(np.int64).max).sum(axis=1)))
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in out],
                                                     names=["query_id", "vec_id", "score", "code"])

    found = dealt.mapInArrow(search, "query_id long, vec_id long, score long, code long")
    order = Window.partitionBy("query_id").orderBy("code", F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")

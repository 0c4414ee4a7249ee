"""Hard negatives by coordinate pruning over length buckets.

Vectors are dealt to length buckets: a class of lengths within a tenth of each
other, cut into parts of bounded size. A bucket holds its vectors and, per
coordinate, their order by the normalised value. For a score of at least t an
anchor q needs a cosine of t / (|q| * longest); buckets that are too short are
never shipped to. In the others the anchor's largest coordinates (its focus) get
a feasible range of values each, a slice of the sorted list; the slices are
intersected and what is left is scored exactly, in integers.

Two passes: the best rows of the anchor's own label (positives), then per
positive the best rows of other labels in its score window. Both first look into
the anchor's own bucket, which gives the scores that later buckets must reach."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shared_table
from .topk import Best, _scores, _usable, quantise

#: Components in a bucket (4096 vectors of 64), buckets held by a task, anchors
#: in a block, focus coordinates.
BUCKET_VALUES, HELD, ANCHORS, FOCUS = 1 << 18, 8, 512, 4
#: log of the squared ratio of lengths within a class.
_RATIO = float(-2.0 * np.log(0.9))
_LOW, _NONE = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def length_class(square: Column) -> Column:
    """Class of a squared length: longer vectors have larger classes; -1 for zero."""
    return F.when(square > 0, F.floor(F.log(square.cast("double")) / F.lit(_RATIO))).otherwise(F.lit(-1)).cast("long")


def _vectors(rows: DataFrame, id_col: str, label_col: str, vec_col: str, scale: int) -> DataFrame:
    vec = F.col(vec_col)
    long = F.aggregate(vec, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")) * float(scale * scale)
    usable = rows.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & _usable(vec) & (F.size(vec) > 0)) \
        .withColumn(vec_col, F.when(long < 2.0 ** 56, vec).otherwise(F.raise_error(F.lit(
            "a vector is too long for exact 64-bit scores: scale it down"))))
    q = usable.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                      quantise(vec, scale).alias("q")).dropDuplicates()
    square = F.aggregate("q", F.lit(0).cast("long"), lambda s, v: s + v * v)
    return q.withColumn("dim", F.size("q")).withColumn("square", square).withColumn("cls", length_class(F.col("square")))


class Bucket:
    """One length bucket: vectors and the order of every normalised coordinate."""

    def __init__(self, ids: bytes, labels: bytes, q: bytes, order: bytes | None = None):
        self.ids, self.labels = np.frombuffer(ids, "<i8"), np.frombuffer(labels, "<i8")
        self.q = np.frombuffer(q, "<i4").reshape(len(self.ids), -1).astype(np.int64)
        f = self.q.astype(np.float64)
        norm = np.sqrt((f * f).sum(axis=1))
        self.longest = float(norm.max(initial=0.0))
        unit = f / np.where(norm > 0, norm, 1.0)[:, None]
        self.order = np.argsort(unit, axis=0, kind="stable").T if order is None \
            else np.frombuffer(order, "<u4").reshape(-1, len(self.ids))
        self.sorted = np.take_along_axis(unit.T, self.order.astype(np.int64), axis=1)

    def candidates(self, q: np.ndarray, norm: np.ndarray, least: np.ndarray):
        """(reach, lists): ``reach`` tells which anchors any row can satisfy;
        ``lists`` gives per anchor the rows left by the ranges of its focus
        coordinates, None where they leave more than half."""
        with np.errstate(divide="ignore", invalid="ignore"):
            cos = np.where(least > 0, least / (norm * self.longest), -1.0) - 1e-9
        reach = ~(cos > 1.0)
        lists: list[np.ndarray | None] = [None] * len(q)
        n = len(self.ids)
        tight = np.flatnonzero(reach & (cos > 0))
        if not len(tight):
            return reach, lists
        unit = q[tight] / norm[tight, None]
        c = np.minimum(cos[tight], 1.0)[:, None]
        focus = np.argsort(-np.abs(unit), axis=1, kind="stable")[:, :FOCUS]
        at = np.take_along_axis(unit, focus, axis=1)
        spread = np.sqrt(np.maximum(1.0 - c * c, 0.0) * np.maximum(1.0 - at * at, 0.0)) + 1e-9
        # within the cap of that cosine a coordinate lies around its centre; the
        # anchor's own direction lifts the bound to the end of the axis
        low = np.where(at < -c, -1.0, at * c - spread)
        high = np.where(at > c, 1.0, at * c + spread)
        for i, a in enumerate(tight):
            slices = []
            for f, lo, hi in zip(focus[i], low[i], high[i]):
                x, y = np.searchsorted(self.sorted[f], [lo - 1e-9, hi + 1e-9], side="left")
                if y - x < n:
                    slices.append(self.order[f][x:y])
            if not slices or min(map(len, slices)) * 2 > n:
                continue
            seen = np.zeros(n, dtype=np.uint8)
            for s in slices:
                seen[s] += 1
            lists[a] = np.flatnonzero(seen == len(slices))
        return reach, lists


def _bodies(vectors: DataFrame) -> DataFrame:
    """(dim, slot, ids, labels, q, order): one row per bucket, ``slot`` counted
    from the longest class down in each dimension."""
    sizes = vectors.groupBy("dim", "cls").agg(F.count(F.lit(1)).alias("n")) \
        .withColumn("parts", F.ceil(F.col("n") * F.col("dim") / F.lit(BUCKET_VALUES)))
    # a few hundred classes a dimension: squared lengths are below 2 ** 56
    above = Window.partitionBy("dim").orderBy(F.desc("cls")).rowsBetween(Window.unboundedPreceding, -1)
    sizes = shared_table(sizes.select("dim", "cls", "parts", F.coalesce(F.sum("parts").over(above), F.lit(0)).alias("first")),
                         "length-classes")
    placed = vectors.join(sizes, ["dim", "cls"]) \
        .withColumn("slot", F.col("first") + F.pmod(F.xxhash64("id", "label", "q"), F.col("parts")))

    def build(key, t):
        cols = [t.column("id").to_numpy().astype("<i8").tobytes(), t.column("label").to_numpy().astype("<i8").tobytes(),
                t.column("q").combine_chunks().flatten().to_numpy().astype("<i4").tobytes()]
        order = Bucket(*cols).order.astype("<u4").tobytes()
        return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([key[1].as_py()], pa.int64()),
                         *(pa.array([c], pa.binary()) for c in (*cols, order))],
                        names=["dim", "slot", "ids", "labels", "q", "order"])

    bodies = placed.select("dim", "slot", "id", "label", "q").groupBy("dim", "slot") \
        .applyInArrow(build, "dim int, slot long, ids binary, labels binary, q binary, order binary")
    return shared_table(bodies, "length-buckets"), sizes


def _blocks(anchors: DataFrame, more: list[str]) -> DataFrame:
    """Anchors (dim, id, label, code, q, need and ``more``) in blocks of about
    ``ANCHORS`` that need similar lengths; ``need`` is the least squared length
    of a row that can matter."""
    anchors = anchors.withColumn("cls", length_class(F.col("need")) - 1)
    sizes = shared_table(anchors.groupBy("dim", "cls").agg(F.ceil(F.count(F.lit(1)) / F.lit(ANCHORS)).alias("parts")), "anchor-classes")
    blk = F.pmod(F.xxhash64("id", "code"), F.col("parts"))
    return anchors.join(sizes, ["dim", "cls"]).withColumn("blk", blk).groupBy("dim", "cls", "blk") \
        .agg(F.collect_list(F.struct("id", "label", "code", "q", *more)).alias("anchors"))


def _shipped(bodies: DataFrame, sizes: DataFrame, blocks: DataFrame, parts: int) -> DataFrame:
    """Buckets, ``HELD`` to a group, each followed by the anchor blocks that its
    group may matter to: those whose least class is not above all of it."""
    # per dimension a few hundred classes with the last slot of each
    ends = sizes.groupBy("dim").agg(F.collect_list(F.struct("cls", (F.col("first") + F.col("parts")).alias("end"))).alias("ends"))
    last = F.aggregate(F.filter("ends", lambda e: e["cls"] >= F.col("cls")), F.lit(0).cast("long"),
                       lambda a, e: F.greatest(a, e["end"]))
    asked = blocks.join(ends, "dim").withColumn("last", last).where(F.col("last") > 0) \
        .withColumn("grp", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("last") - 1) / F.lit(HELD)))))
    null = F.lit(None)
    held = bodies.select("dim", F.floor(F.col("slot") / F.lit(HELD)).alias("grp"), F.lit(0).alias("kind"), "ids", "labels", "q", "order",
                         null.cast(blocks.schema["anchors"].dataType).alias("anchors"))
    ask = asked.select("dim", "grp", F.lit(1).alias("kind"), *[null.cast("binary").alias(c) for c in ("ids", "labels", "q", "order")],
                       "anchors")
    return held.unionByName(ask).repartition(parts, "dim", "grp").sortWithinPartitions("dim", "grp", "kind")


class Anchors:
    """A block of anchors out of an Arrow list of structs."""

    def __init__(self, block: pa.Array):
        get = {f.name: block.field(f.name) for f in block.type}
        n = len(block)
        self.id, self.label, self.code = (get[k].to_numpy(zero_copy_only=False).astype(np.int64) for k in ("id", "label", "code"))
        self.q = get["q"].flatten().to_numpy().reshape(n, -1).astype(np.int64)
        f = self.q.astype(np.float64)
        self.norm = np.sqrt((f * f).sum(axis=1))
        self.get = get

    def matrix(self, name: str, fill: int) -> np.ndarray:
        """A list column as rows of equal length, short lists filled."""
        rows = self.get[name].to_pylist()
        width = max((len(r) for r in rows), default=0)
        return np.array([r + [fill] * (width - len(r)) for r in rows], dtype=np.int64).reshape(len(rows), width)


def _verify(bucket: Bucket, a: Anchors, least: np.ndarray, visit) -> None:
    """Scores exactly what the ranges leave; ``visit(rows, columns, scores)``."""
    reach, lists = bucket.candidates(a.q.astype(np.float64), a.norm, least)
    for i, cols in enumerate(lists):
        if reach[i] and cols is not None and len(cols):
            visit(np.array([i]), cols, _scores(a.q[i:i + 1], bucket.q[cols]))
    whole = np.array([i for i in np.flatnonzero(reach) if lists[i] is None], dtype=np.int64)
    every = np.arange(len(bucket.ids))
    for i in range(0, len(whole), 128):
        rows = whole[i:i + 128]
        visit(rows, every, _scores(a.q[rows], bucket.q))


def find_positives(bucket: Bucket, a: Anchors, best: Best, know: np.ndarray) -> None:
    def visit(rows, cols, scores):
        hide = (bucket.labels[None, cols] != a.label[rows, None]) | (bucket.ids[None, cols] == a.id[rows, None])
        best.add(rows, scores, bucket.ids[cols], hide)
    _verify(bucket, a, np.maximum(know, best.score[:, -1]).astype(np.float64), visit)


def window(positive: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """(least, most) score with low * positive <= 100 * score <= high * positive,
    exact for 64-bit scores below 2 ** 57."""
    return -((-positive * low) // 100), (positive * high) // 100


def find_negatives(bucket: Bucket, a: Anchors, best: list[Best], least: np.ndarray, most: np.ndarray) -> None:
    """``least`` and ``most``: windows per anchor and positive (least > most: none)."""
    floors = np.stack([np.maximum(least[:, j], b.score[:, -1]) for j, b in enumerate(best)], axis=1)
    floors = np.where(least > most, _NONE, floors).min(axis=1, initial=_NONE)

    def visit(rows, cols, scores):
        same = bucket.labels[None, cols] == a.label[rows, None]
        for j, b in enumerate(best):
            hide = same | (scores < least[rows, j, None]) | (scores > most[rows, j, None])
            if not hide.all():
                b.add(rows, scores, bucket.ids[cols], hide)
    _verify(bucket, a, floors.astype(np.float64), visit)


def _stream(per_block):
    """Runs ``per_block(buckets, anchors)`` over the shipped rows: a task holds
    one group of buckets and streams the blocks."""
    def run(frames):
        group, held = None, []
        for b in frames:
            for i in range(b.num_rows):
                key = (b.column(0)[i].as_py(), b.column(1)[i].as_py())
                if key != group:
                    group, held = key, []
                if b.column(2)[i].as_py() == 0:
                    held.append(Bucket(*(b.column(k)[i].as_py() for k in range(3, 7))))
                    continue
                yield from per_block(held, Anchors(b.column(7)[i].values))
    return run


def _batch(**cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in cols.values()], names=list(cols))


def hard_negatives(rows: DataFrame, every: int = 50, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
                   id_col: str = "vec_id", label_col: str = "label", vec_col: str = "embedding", scale: int = 256) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose id is divisible by ``every``. An anchor's positives
    are its ``positives`` best other rows of the same (integer) label; for each,
    the first ``negatives`` rows of other labels with ``low`` to ``high`` percent
    of the positive's score. Best is the larger inner product of the vectors
    floor(scale * x), ties to the smaller id.

    Rows without an id or label, and vectors that are null, empty or hold a null
    or non-finite component, take no part. Vectors compare within their length;
    equal rows count once; different rows of one id are rows of their own, though
    never a positive of their own id. Fewer candidates give fewer rows, an empty
    table none; further columns are ignored. A vector with a squared length of
    2 ** 56 or more (after scaling) raises an error: its scores might not fit."""
    if not 0 <= low < high:
        raise ValueError("the window needs 0 <= low < high percent")
    vectors = shared_table(_vectors(rows, id_col, label_col, vec_col, scale), "negatives-vectors")
    bodies, sizes = _bodies(vectors)
    parts = max(1, -(-bodies.count() // HELD))

    def seed(frames):
        """Per anchor the score that its ``positives``-th best is known to reach."""
        for b in frames:
            for row in zip(*(b.column(i).to_pylist() for i in range(5))):
                bucket = Bucket(*row[1:])
                mine = np.flatnonzero(bucket.ids % every == 0)
                for i in range(0, len(mine), ANCHORS):
                    m = mine[i:i + ANCHORS]
                    best = Best(len(m), positives)
                    score = _scores(bucket.q[m], bucket.q)
                    best.add(np.arange(len(m)), score, bucket.ids,
                             (bucket.labels[None, :] != bucket.labels[m, None]) | (bucket.ids[None, :] == bucket.ids[m, None]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row[0]] * len(m), pa.int32()), pa.array(bucket.ids[m]), pa.array(bucket.labels[m]),
                         pa.array(list(bucket.q[m]), pa.list_(pa.int64())), pa.array(best.score[:, -1])],
                        names=["dim", "id", "label", "q", "know"])

    def need(score: Column, square: Column) -> Column:
        """Least squared length of a row that reaches the score."""
        s = score.cast("double")
        return F.when((score > 0) & (square > 0), s * s / square.cast("double") * F.lit(1 - 1e-9)).otherwise(F.lit(0.0))

    square = F.aggregate("q", F.lit(0).cast("long"), lambda s, v: s + v * v)
    anchors = shared_table(
        bodies.select("dim", "ids", "labels", "q", "order").mapInArrow(seed, "dim int, id long, label long, q array<long>, know long")
        .withColumn("square", square).withColumn("need", need(F.col("know"), F.col("square")))
        .withColumn("code", F.xxhash64("label", "q")), "negatives-anchors")

    def positive_rows(held: list[Bucket], a: Anchors):
        best, know = Best(len(a.id), positives), a.get["know"].to_numpy(zero_copy_only=False).astype(np.int64)
        for bucket in held:
            find_positives(bucket, a, best, know)
        real = best.id < _NONE
        times = real.sum(axis=1)
        if times.any():
            yield _batch(id=np.repeat(a.id, times), code=np.repeat(a.code, times), pid=best.id[real], ps=best.score[real])

    found = _shipped(bodies, sizes, _blocks(anchors, ["know"]), parts) \
        .mapInArrow(_stream(positive_rows), "id long, code long, pid long, ps long")
    first = Window.partitionBy("id", "code").orderBy(F.desc("ps"), "pid")
    chosen = found.withColumn("j", F.row_number().over(first)).where(F.col("j") <= positives) \
        .groupBy("id", "code").agg(F.array_sort(F.collect_list(F.struct("j", "pid", "ps"))).alias("p"))
    ready = anchors.drop("know", "need").join(chosen, ["id", "code"]) \
        .select("dim", "id", "label", "code", "q", "square", F.col("p.pid").alias("pid"), F.col("p.ps").alias("ps"))
    # only windows of positive scores bound the length; one of zero needs none
    useful = F.filter("ps", lambda x: x >= 0)
    ready = ready.where(F.size(useful) > 0) \
        .withColumn("need", need(F.ceil(F.array_min(useful) * F.lit(low) / F.lit(100)) - 1, F.col("square")))

    def negative_rows(held: list[Bucket], a: Anchors):
        pid, ps = a.matrix("pid", -1), a.matrix("ps", -1)
        least, most = window(ps, low, high)
        none = ps < 0
        least, most = np.where(none, 1, least), np.where(none, 0, most)
        best = [Best(len(a.id), negatives) for _ in range(ps.shape[1])]
        for bucket in held:
            find_negatives(bucket, a, best, least, most)
        for j, b in enumerate(best):
            real = b.id < _NONE
            times = real.sum(axis=1)
            if times.any():
                yield _batch(id=np.repeat(a.id, times), code=np.repeat(a.code, times), j=np.full(int(times.sum()), j),
                             pid=np.repeat(pid[:, j], times), ps=np.repeat(ps[:, j], times), nid=b.id[real], ns=b.score[real])

    blocks = _blocks(shared_table(ready, "negatives-positives"), ["pid", "ps"])
    out = _shipped(bodies, sizes, blocks, parts) \
        .mapInArrow(_stream(negative_rows), "id long, code long, j long, pid long, ps long, nid long, ns long")
    best_first = Window.partitionBy("id", "code", "j").orderBy(F.desc("ns"), "nid")
    return out.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= negatives) \
        .select(F.col("id").alias("anchor_id"), F.col("pid").alias("positive_id"), "rank",
                F.col("nid").alias("negative_id"), F.col("ps").alias("positive_score"), F.col("ns").alias("negative_score"))

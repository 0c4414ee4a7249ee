"""SimHash near-dedup: 64-bit fingerprints of word shingles, compared exactly in
tiles with numpy exclusive-or and bit counts; tile pairs whose population
counts differ beyond the radius are never formed.

``simhash_dedup`` drops rows, so it asks for more than close fingerprints: in
long texts of few words the majority of every bit tends to that of the language,
and texts that share no passage come within three bits. Its links also need a
sketch of the shingle sets (256 bins, one bit of each bin's smallest hash) to
agree in most bins, which is compared in the same pass."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.graph import connected_components
from .common import batches, shared_table, text_bytes

#: Fingerprints in a tile.
TILE = 4096
#: Bins of a sketch, and the share of the bins used by either text that must agree.
BINS, AGREE = 256, 0.8


def shingle_hashes(body: bytes, words: int = 3, seed: int = 42) -> np.ndarray:
    """XXH64 of every shingle, repeats included; none without words."""
    w = body.lower().split()
    if not w:
        return np.empty(0, dtype="<u8")
    grams = zip(*(w[i:] for i in range(words))) if len(w) > words else [w]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(b" ".join(g), seed) for g in grams), dtype="<u8")


def sketch(h: np.ndarray) -> bytes:
    """One-permutation one-bit minwise sketch: 256 bits that say which bins are
    used, then a bit of the smallest hash of each."""
    top = np.unique(h)[::-1]                      # descending: the smallest of a bin is written last
    at, bit = (top & np.uint64(BINS - 1)).astype(np.int64), (top >> np.uint64(8) & np.uint64(1)).astype(np.uint8)
    used, low = np.zeros(BINS, dtype=np.uint8), np.zeros(BINS, dtype=np.uint8)
    used[at] = 1
    low[at] = bit
    return np.packbits(used).tobytes() + np.packbits(low).tobytes()


def alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rows of two sketch arrays (n, 8 words) that agree in ``AGREE`` of the bins
    that either uses. For shingle sets of Jaccard similarity J about (1 + J) / 2
    of the bins agree, so J = 0.8 passes at 0.9 and J = 0.4 fails at 0.7."""
    either, differ = a[:, :4] | b[:, :4], (a[:, :4] ^ b[:, :4]) | (a[:, 4:] ^ b[:, 4:])
    return np.bitwise_count(differ).sum(axis=1) <= (1 - AGREE) * np.bitwise_count(either).sum(axis=1)


def fingerprint(body: bytes, words: int = 3, seed: int = 42) -> int:
    """Bits set in over half of the shingles' XXH64; no words: zero."""
    return majority(shingle_hashes(body, words, seed))


def majority(h: np.ndarray) -> int:
    if not len(h):
        return 0
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(h), 1 << 16):
        part = h[i:i + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 words: int = 3) -> DataFrame:
    """(doc_id, fp): one row per input row; fp is the signed long of the bits."""
    def run(frames):
        for b in batches(frames):
            fp = np.array([fingerprint(x, words) for x in b.column(1).to_pylist()], dtype="<u8").view("<i8")
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp)], names=["doc_id", "fp"])
    return text_bytes(docs, id_col, text_col).mapInArrow(run, "doc_id long, fp long")


def close_pairs(a: np.ndarray, b: np.ndarray, radius: int, same: bool, step: int = 256):
    """Index pairs of ``a`` and ``b`` within ``radius`` bits, all compared."""
    left, right = [], []
    for i in range(0, len(a), step):
        near = np.bitwise_count(a[i:i + step, None] ^ b[None, :]) <= radius
        x, y = np.nonzero(near)
        x += i
        if same:
            x, y = x[x < y], y[x < y]
        left.append(x)
        right.append(y)
    return np.concatenate(left), np.concatenate(right)


def forest(n: int, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) for every node joined to a smaller one: at most ``n`` rows
    stand for all the links, whatever their number."""
    label = np.arange(n)
    while True:
        old = label.copy()
        low = np.minimum(label[x], label[y])
        np.minimum.at(label, x, low)
        np.minimum.at(label, y, low)
        label = label[label]
        if np.array_equal(old, label):
            break
    node = np.flatnonzero(label != np.arange(n))
    return node, label[node]


def _compare(radius: int):
    def run(frames):
        for b in frames:
            src, dst = [], []
            same = b.column(2).to_pylist()
            for i, (a, c) in enumerate(zip(b.column(0), b.column(1))):
                a = a.values.to_numpy().view("<u8")
                c = c.values.to_numpy().view("<u8")
                x, y = close_pairs(a, c, radius, same[i])
                if not len(x):
                    continue
                both = a if same[i] else np.concatenate([a, c])
                node, root = forest(len(both), x, y if same[i] else y + len(a))
                src.append(both[node])
                dst.append(both[root])
            if src:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(src).view("<i8")), pa.array(np.concatenate(dst).view("<i8"))],
                    names=["src", "dst"])
    return run


def tile_links(prints: DataFrame, radius: int = 3, tile: int = TILE, agree: bool = False) -> DataFrame:
    """(src, dst) links that join all fingerprints within ``radius`` bits.

    ``prints`` has distinct ``fp``. A cell is the pair of population counts of
    the two halves; two fingerprints within the radius lie in cells whose counts
    differ by no more than the radius in sum, so only those tiles meet. Cells
    are cut into tiles by hash. Tiles are numbered and paired by number first, so
    that the bodies of a large cell's many tile pairs are dealt to many tasks.
    With ``agree`` rows are (fp, sketch, node), sketches must agree as well, and
    links join nodes."""
    low = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))
    kept = ["fp", "sketch", "node"] if agree else ["fp"]
    cells = prints.select(*kept, F.bit_count(low).alias("c"), F.bit_count(F.shiftrightunsigned("fp", 32)).alias("d"))
    # at most 33 x 33 rows, whatever the table
    sizes = cells.groupBy("c", "d").agg(F.ceil(F.count(F.lit(1)) / F.lit(tile)).alias("parts"))
    body = F.collect_list(F.struct(*kept) if agree else F.col("fp"))
    tiles = shared_table(cells.join(F.broadcast(sizes), ["c", "d"])
                         .withColumn("t", F.pmod(F.xxhash64(*kept), F.col("parts")))
                         .groupBy("c", "d", "t").agg(body.alias("fps"))
                         .withColumn("tile", F.xxhash64("c", "d", "t")), "simhash-tiles")
    near = [(i, j) for i in range(-radius, radius + 1) for j in range(-radius, radius + 1)
            if abs(i) + abs(j) <= radius and (i, j) >= (0, 0)]
    shifts = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in near])
    numbers = tiles.select("c", "d", "t", "tile")
    left = numbers.select(F.col("t").alias("lt"), F.col("tile").alias("left"), "c", "d", F.explode(shifts).alias("s")) \
        .select("lt", "left", (F.col("c") + F.col("s.i")).alias("c"), (F.col("d") + F.col("s.j")).alias("d"),
                ((F.col("s.i") == 0) & (F.col("s.j") == 0)).alias("own"))
    pairs = left.join(numbers, ["c", "d"]).where(~F.col("own") | (F.col("lt") <= F.col("t"))) \
        .select("left", F.col("tile").alias("right"))
    # the left body travels to the pair, and the pair to the right one: both joins have one row per pair
    a = tiles.select(F.col("tile").alias("left"), F.col("fps").alias("a"))
    b = tiles.select(F.col("tile").alias("right"), F.col("fps").alias("b"))
    dealt = pairs.join(a, "left").join(b, "right").select("a", "b", (F.col("left") == F.col("right")).alias("same"))
    return dealt.mapInArrow((_compare_alike if agree else _compare)(radius), "src long, dst long")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   words: int = 3, radius: int = 3) -> DataFrame:
    """(doc_id, fp, component_id) for every input row.

    ``component_id`` is the smallest id reachable over links of at most
    ``radius`` differing bits, the row's own included. Null and blank texts have
    fingerprint zero and link like any other; repeated ids and texts are rows of
    their own with the same component; a null id takes the smallest id of its
    group (null if none has one). An empty table gives no rows; further columns
    are ignored. A text of any length is hashed whole, one text at a time. Equal
    fingerprints collapse before tiles meet, so copies cost one row."""
    prints = shared_table(fingerprints(docs, id_col, text_col, words), "simhash")
    reps = shared_table(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-reps")
    links = tile_links(reps.select("fp"), radius)
    comp = connected_components(reps.select(F.col("fp").alias("id")), links) \
        .select(F.col("id").alias("fp"), "component")
    known = reps.join(comp, "fp")
    # read back, so that the join's sides are plain exchanges and a large group can be split
    first = shared_table(known.groupBy("component").agg(F.min("rep").alias("component_id")), "simhash-first")
    return prints.join(known.join(first, "component").select("fp", "component_id"), "fp") \
        .select("doc_id", "fp", "component_id")


def marks(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """(doc_id, fp, sketch, th) per row; ``th`` hashes the text."""
    def run(frames):
        for b in batches(frames):
            hashes = [shingle_hashes(x, words) for x in b.column(1).to_pylist()]
            fp = np.array([majority(h) for h in hashes], dtype="<u8").view("<i8")
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp), pa.array([sketch(h) for h in hashes], pa.binary()), b.column(2)],
                                             names=["doc_id", "fp", "sketch", "th"])
    return text_bytes(docs, id_col, text_col, text_hash(F.col(text_col))) \
        .mapInArrow(run, "doc_id long, fp long, sketch binary, th string")


def text_hash(text):
    """128 bits of the text as one string; null as empty."""
    t = F.coalesce(text, F.lit(""))
    return F.concat_ws("-", F.hex(F.xxhash64(t)), F.hex(F.xxhash64(F.lit(0x5EED), t))).alias("th")


def _compare_alike(radius: int):
    """Close fingerprints whose sketches agree, as a forest of the tile pair's
    nodes (positions of ``node`` arrays)."""
    def run(frames):
        for b in frames:
            src, dst = [], []
            for i in range(b.num_rows):
                same = b.column(2)[i].as_py()
                sides = []
                for col in (0, 1):
                    t = b.column(col)[i].values
                    raw = b"".join(t.field("sketch").to_pylist())
                    sides.append((t.field("fp").to_numpy().view("<u8"), np.frombuffer(raw, "<u8").reshape(-1, 8), t.field("node").to_numpy()))
                (fa, sa, na), (fb, sb, nb) = sides
                left, right = [], []
                for at in range(0, len(fa), 256):
                    x, y = close_pairs(fa[at:at + 256], fb, radius, False)
                    x += at
                    if same:
                        x, y = x[x < y], y[x < y]
                    for k in range(0, len(x), 1 << 18):
                        ok = alike(sa[x[k:k + (1 << 18)]], sb[y[k:k + (1 << 18)]])
                        left.append(x[k:k + (1 << 18)][ok])
                        right.append(y[k:k + (1 << 18)][ok])
                x, y = (np.concatenate(v) if v else np.empty(0, np.int64) for v in (left, right))
                if not len(x):
                    continue
                nodes = na if same else np.concatenate([na, nb])
                node, root = forest(len(nodes), x, y if same else y + len(na))
                src.append(nodes[node])
                dst.append(nodes[root])
            if src:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(src)), pa.array(np.concatenate(dst))], names=["src", "dst"])
    return run


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  words: int = 3, radius: int = 3) -> DataFrame:
    """The rows of ``docs`` that stay when of every group of near copies only the
    row of the smallest id is kept; all input columns.

    Rows are linked when their fingerprints differ in at most ``radius`` bits and
    their sketches agree (see the module's text); groups are what links reach.
    Null and blank texts are equal texts. Rows of one id are rows of their own:
    of equal (id, text) rows the smallest by its other columns counts, among
    texts of the smallest id the one of the smallest hash; null ids come last. A
    text of any length is hashed whole, one text at a time. An empty table gives
    no rows; columns of any name pass through."""
    spark_cols = docs.columns
    rows = shared_table(marks(docs, id_col, text_col, words), "simhash-marks")
    # copies collapse by fingerprint and sketch before anything is compared
    nodes = shared_table(rows.groupBy("fp", "sketch").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "th")).alias("rep"))
                         .withColumn("node", F.xxhash64("fp", "sketch")), "simhash-nodes")
    links = tile_links(nodes.select("fp", "sketch", "node"), radius, agree=True)
    comp = connected_components(nodes.select(F.col("node").alias("id")), links).select(F.col("id").alias("node"), "component")
    known = nodes.join(comp, "node")
    first = known.groupBy("component").agg(F.min("rep").alias("rep"))
    keep = first.select(F.col("rep.doc_id").alias("__keep_id"), F.col("rep.th").alias("__keep_th"))
    ranked = docs.withColumn("__th", text_hash(F.col(text_col)))
    kept = ranked.join(keep, ranked[id_col].cast("long").eqNullSafe(keep["__keep_id"]) & (ranked["__th"] == keep["__keep_th"]), "left_semi")
    # one per (id, text): only keys that repeat among the rows are ordered
    twice = shared_table(rows.groupBy("doc_id", "th").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                         .select(F.col("doc_id").alias("__id"), F.col("th").alias("__tw")), "simhash-twice")
    again = kept[id_col].cast("long").eqNullSafe(twice["__id"]) & (kept["__th"] == twice["__tw"])
    single = kept.join(twice, again, "left_anti").select(*[f"`{c}`" for c in spark_cols])
    if twice.isEmpty():
        return single
    doubled = kept.join(twice, again).groupBy("__id", "__tw").agg(F.min(F.struct(*[f"`{c}`" for c in spark_cols])).alias("r"))
    return single.unionByName(doubled.select(*[F.col("r").getField(c).alias(c) for c in spark_cols]))

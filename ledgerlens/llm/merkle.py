"""Merkle dataset manifest: a content-addressed DAG of digest-to-children
records, and membership proofs by descent.

Leaves of a group (a language) ascend by id and are hashed in runs of ``fan``
until one node, the subroot, remains; the subroots give the root the same way.
The tree is grown in strides of ``STRIDE`` levels: one bounded group of at most
``fan ** levels`` nodes goes up several levels at once, and every inner node is
stored as a record (digest, children) under the digest of its stride's top.

A proof descends: a request carries the rank of its leaf, starts at the root and
goes down by the digits of the rank in base ``fan``; at each record the chosen
child is followed and its unselected siblings are collected. Requests share the
segment of the strides above, so each stride ships one row per node that it
reaches. The segments, root first, are joined and reversed into leaf-first
order."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_table
from .order import range_running

#: Most nodes of one stride's bottom, and so most requests of one group.
STRIDE_NODES = 4096

_STEP = "struct<left: binary, right: binary>"


def encoded(c: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, ``:`` and the value."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf_digest(*cols: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*[encoded(c) for c in cols]).cast("binary"), 256))


def hex_text(c: Column) -> Column:
    return F.lower(F.hex(c))


def _parent(children: list[bytes]) -> bytes:
    return hashlib.sha256(b"".join(c.hex().encode() for c in children)).digest()


def _height(n: int, fan: int) -> int:
    h, reach = 0, 1
    while reach < n:
        h, reach = h + 1, reach * fan
    return h


@dataclass
class Forest:
    """Trees (numbered) with their records: ``strides[i]`` holds the records of
    levels ``i * levels`` to ``(i + 1) * levels``; ``tops`` has (tree, height,
    digest)."""
    fan: int
    levels: int
    strides: list[DataFrame]
    tops: DataFrame


def grow(nodes: DataFrame, fan: int = 2) -> Forest:
    """Build the trees over ``nodes`` (tree, pos, digest); ``pos`` counts from 0
    without gaps in each tree."""
    levels = 1
    while fan ** (levels + 1) <= STRIDE_NODES:
        levels += 1
    width = fan ** levels
    sizes = nodes.groupBy("tree").agg(F.count(F.lit(1)).alias("n"))
    sizes = shared_table(sizes, "merkle-sizes")
    most = sizes.agg(F.max("n")).first()[0] or 0
    at = nodes.join(sizes, "tree").select("tree", "pos", "digest", "n")
    strides = []

    def climb(base: int):
        def run(key, table):
            tree, blk = (k.as_py() for k in key)
            t = table.sort_by("pos")
            row, n = t.column("digest").to_pylist(), t.column("n")[0].as_py()
            made: list[tuple[bytes, list[bytes]]] = []
            for _ in range(max(0, min(levels, _height(n, fan) - base))):
                runs = [row[i:i + fan] for i in range(0, len(row), fan)]
                row = [_parent(r) for r in runs]
                made += zip(row, runs)
            top = row[0]
            digests, children = [top, *(d for d, _ in made)], [None, *(c for _, c in made)]
            k = len(digests)
            return pa.table([pa.array([tree] * k, pa.int64()), pa.array([blk] * k, pa.int64()),
                             pa.array([n] * k, pa.int64()), pa.array([top] * k, pa.binary()),
                             pa.array(digests, pa.binary()), pa.array(children, pa.list_(pa.binary()))],
                            names=["tree", "pos", "n", "top", "digest", "children"])
        return run

    for base in range(0, max(1, _height(most, fan)), levels):
        grown = shared_table(
            at.withColumn("blk", F.floor(F.col("pos") / F.lit(width))).groupBy("tree", "blk")
            .applyInArrow(climb(base), "tree long, pos long, n long, top binary, digest binary, children array<binary>"),
            "merkle-stride")
        # equal blocks have equal records: stored once by content
        strides.append(shared_table(grown.where(F.col("children").isNotNull()).select("top", "digest", "children")
                                    .dropDuplicates(["top", "digest"]), "merkle-records"))
        at = grown.where(F.col("children").isNull()).select("tree", "pos", "digest", "n")
    return Forest(fan, levels, strides, shared_table(at.select("tree", "n", "digest"), "merkle-tops"))


def descend(forest: Forest, requests: DataFrame, starts: DataFrame) -> DataFrame:
    """Proofs for ``requests`` (tree, pos and any further columns): those columns
    and digest, path, where path has one (left, right) step per level, leaf first.

    ``starts`` (tree, path) gives what lies above each tree, root first."""
    fan, levels = forest.fan, forest.levels
    more = [f for f in requests.schema.fields if f.name not in ("tree", "pos")]
    frontier = forest.tops.join(starts, "tree").select("tree", F.lit(0).cast("long").alias("blk"), "n", "digest", "path")

    def down(base: int, extra: list[str]):
        def run(key, left, right):
            if not left.num_rows or not right.num_rows:
                return _no_rows(left, extra)
            blk = key[1].as_py()
            children = dict(zip(right.column("digest").to_pylist(), right.column("children").to_pylist()))
            start, n = right.column("top")[0].as_py(), right.column("n")[0].as_py()
            deep = max(0, min(levels, _height(n, fan) - base))
            found, path = [], []
            for pos in left.column("pos").to_pylist():
                rank, cur, steps = pos - blk * fan ** levels, start, []
                for level in range(deep - 1, -1, -1):
                    digit = rank // fan ** level % fan
                    run_ = children[cur]
                    steps.append({"left": b"".join(run_[:digit]), "right": b"".join(run_[digit + 1:])})
                    cur = run_[digit]
                found.append(cur)
                path.append(steps)
            step = pa.struct([("left", pa.binary()), ("right", pa.binary())])
            return pa.table([left.column("tree"), left.column("pos"), *(left.column(c) for c in extra),
                             pa.array(found, pa.binary()), pa.array(path, pa.list_(step))],
                            names=["tree", "pos", *extra, "digest", "steps"])
        return run

    def _no_rows(left, extra):
        step = pa.struct([("left", pa.binary()), ("right", pa.binary())])
        return pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()),
                         *(pa.array([], left.schema.field(c).type) for c in extra),
                         pa.array([], pa.binary()), pa.array([], pa.list_(step))],
                        names=["tree", "pos", *extra, "digest", "steps"])

    width = fan ** levels
    for s in range(len(forest.strides) - 1, -1, -1):
        if s:
            asked, extra = requests.select("tree", F.floor(F.col("pos") / F.lit(width ** s)).alias("pos")).distinct(), []
        else:
            asked, extra = requests, more
        asked = asked.withColumn("blk", F.floor(F.col("pos") / F.lit(width)))
        # records are looked up by content; a node without any is its own top
        records = frontier.join(forest.strides[s], frontier["digest"] == forest.strides[s]["top"], "left") \
            .select("tree", "blk", "n", frontier["digest"].alias("top"), forest.strides[s]["digest"], "children")
        kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in more) if not s else ""
        seg = asked.groupBy("tree", "blk").cogroup(records.groupBy("tree", "blk")).applyInArrow(
            down(s * levels, [f.name for f in more] if not s else []),
            f"tree long, pos long, {kept + ', ' if kept else ''}digest binary, steps array<{_STEP}>")
        above = frontier.select("tree", "blk", "n", F.col("path").alias("above"))
        joined = seg.withColumn("blk", F.floor(F.col("pos") / F.lit(width))).join(above, ["tree", "blk"]) \
            .withColumn("path", F.concat("above", "steps"))
        if s:
            frontier = shared_table(joined.select("tree", F.col("pos").alias("blk"), "n", "digest", "path"), "merkle-frontier")
        else:
            return joined.select("tree", "pos", *[f"`{f.name}`" for f in more], "digest", F.reverse("path").alias("path"))


def folded(digest: Column, path: Column) -> Column:
    """The root (hex) that a leaf digest (hex) gives along a leaf-first path."""
    return F.aggregate(path, digest, lambda acc, x: F.sha2(
        F.concat(hex_text(x["left"]), acc, hex_text(x["right"])).cast("binary"), 256))


def proof_digest(path: Column) -> Column:
    """sha256 of all siblings (hex text) in path order, left to right."""
    return F.sha2(F.concat_ws("", F.transform(path, lambda x: F.concat(hex_text(x["left"]), hex_text(x["right"]))))
                  .cast("binary"), 256)


@dataclass
class Manifest:
    """``leaves``: (tree, pos, doc_id, digest, changed); ``groups``: (tree, the
    group's value); the records of all languages and those of the root."""
    leaves: DataFrame
    groups: DataFrame
    trees: Forest
    top: Forest
    root: bytes


def build_manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang",
                   columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
                   changed: Column | None = None, fan: int = 2) -> Manifest | None:
    """The manifest of ``docs``; None for an empty table.

    ``changed`` is a leaf digest (binary, null where nothing changed) kept beside
    each leaf, to test it against the proofs. Leaves ascend by (id, digest), null
    ids first; equal rows are leaves of their own. Null columns hash as ``-``,
    null groups are a group, the first; texts of any length are hashed whole by
    Spark and never leave the JVM; further columns are ignored."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(group_col).cast("string").alias("grp"),
                       leaf_digest(*[F.col(c) for c in columns]).alias("digest"),
                       (changed if changed is not None else F.lit(None).cast("binary")).alias("changed"))
    # equal rows once, with their number, so that no run of them is sorted in one task
    rows = shared_table(rows.groupBy("doc_id", "grp", "digest", "changed").agg(F.count(F.lit(1)).alias("copies")), "merkle-leaves")
    names = rows.select("grp").distinct().withColumn("one", F.lit(1)).withColumn("all", F.lit(0))
    groups = shared_table(range_running(names, ["all"], [F.col("grp").asc_nulls_first()], {"tree": "one"}, "merkle-names")
                          .select(F.col("tree").cast("long").alias("tree"), "grp"), "merkle-groups")
    if groups.isEmpty():
        return None
    numbered = rows.join(groups, rows["grp"].eqNullSafe(groups["grp"])).select("tree", "doc_id", "digest", "changed", "copies")
    ranked = range_running(numbered, ["tree"], [F.col("doc_id").asc_nulls_first(), F.col("digest")], {"first": "copies"},
                           "merkle-order")
    leaves = shared_table(ranked.select("tree", F.explode(F.sequence("first", F.col("first") + F.col("copies") - 1)).alias("pos"),
                                        "doc_id", "digest", "changed"), "merkle-ranked")
    trees = grow(leaves.select("tree", "pos", "digest"), fan)
    top = grow(trees.tops.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"), "digest"), fan)
    return Manifest(leaves, groups, trees, top, bytes(top.tops.first()["digest"]))


def prove(manifest: Manifest, requests: DataFrame) -> DataFrame:
    """Membership proofs of ``requests`` (tree, pos and further columns): adds
    digest (as found by descent), subroot and path (leaf first, to the root)."""
    spark = requests.sparkSession
    above = spark.createDataFrame([(0, [])], f"tree long, path array<{_STEP}>")
    subroots = requests.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos")).distinct()
    tops = shared_table(descend(manifest.top, subroots, above), "merkle-subroots")
    starts = tops.select(F.col("pos").alias("tree"), F.reverse("path").alias("path"))
    found = descend(manifest.trees, requests, starts)
    return found.join(tops.select(F.col("pos").alias("tree"), F.col("digest").alias("subroot")), "tree")


def audit(docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang",
          columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
          changed: Column | None = None, fan: int = 2) -> DataFrame:
    """Build the manifest of ``docs`` and prove every row against it: doc_id,
    leaf, subroot, root, proof_sha256, folded_root (of the changed leaf where
    there is one), verified. An empty table gives no rows; see
    ``build_manifest`` for nulls, repeated rows, long texts and extra columns."""
    spark: SparkSession = docs.sparkSession
    m = build_manifest(docs, id_col, group_col, columns, changed, fan)
    if m is None:
        return spark.createDataFrame([], "doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
                                         "folded_root string, verified boolean")
    proofs = prove(m, m.leaves.select("tree", "pos", "doc_id", "changed"))
    root = m.root.hex()
    return proofs.select("doc_id", hex_text(F.col("digest")).alias("leaf"), hex_text(F.col("subroot")).alias("subroot"),
                         F.lit(root).alias("root"), proof_digest(F.col("path")).alias("proof_sha256"),
                         folded(hex_text(F.coalesce("changed", "digest")), F.col("path")).alias("folded_root")) \
        .withColumn("verified", F.col("folded_root") == F.col("root"))

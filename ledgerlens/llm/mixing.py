"""Mixing sources to target weights with a multivariate-hypergeometric tree.

Every source is cut, in hash order, into blocks of whole documents of about
``block_words`` words. What a source has to give is a run of its blocks: whole
epochs, each in an order of its own, then as much of one more epoch as the target
asks; the last block, and the last document in it, are cut to the word. Its
number of blocks is the source's quota.

A tree over the output shards deals the quotas out: at each node the counts of
the node's blocks per source are split between the two halves of its shards by
one draw from the multivariate hypergeometric distribution, so that every shard
gets its exact number of blocks, as a random deal of all blocks would. Nodes are
handled in strides of ``FAN`` children, sources in groups of ``GROUP`` (a draw
for the groups, then one inside each). A shard then takes the next blocks of
each source's permuted order, no block twice, and shuffles their documents."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shared_table
from .order import hash_cell, hash_running, range_running

#: Children of a tree node and sources of a group that one draw handles.
FAN, GROUP = 256, 1024
#: Most blocks in all; with larger corpora blocks grow (a limit of the draw is 10 ** 9).
MOST_BLOCKS = 1 << 28
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def key_text(*cols: Column) -> Column:
    """Columns as one text; null is told from every value."""
    return F.concat_ws("|", *[F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("-")) for c in cols])


def source_targets(sizes: DataFrame, most: int = 3, weights: int = 3) -> tuple[DataFrame, int]:
    """(s, source, z, target) for (source, z): weights 1 .. ``weights`` in turn
    over the sources by name (null last); targets share the whole size by weight
    and stop at ``most`` times the source, the excess going to the others by
    weight. Every round caps the sources above their limit at the present share;
    only sums come to the driver. Also returns the whole size."""
    named = sizes.withColumn("one", F.lit(1)).withColumn("all", F.lit(0))
    ranked = shared_table(range_running(named, ["all"], [F.col("source").asc_nulls_last()], {"s": "one"}, "mix-names")
                          .select(F.col("s").cast("long").alias("s"), "source", "z",
                                  (F.col("s") % weights + 1).cast("long").alias("w")), "mix-sources")
    whole = int(ranked.agg(F.sum("z")).first()[0] or 0)
    big = "decimal(19,0)"

    def capped(rest: int, weight: int) -> Column:
        return (F.col("z") * most).cast(big) * F.lit(weight).cast(big) < F.lit(rest).cast(big) * F.col("w").cast(big)

    stop, rest, weight = F.lit(False), whole, None
    while True:
        z, w = ranked.agg(F.sum(F.when(stop, F.col("z")).otherwise(0)), F.sum(F.when(stop, 0).otherwise(F.col("w")))).first()
        if weight == w or not w:
            break
        rest, weight = whole - most * int(z or 0), int(w)
        stop = capped(rest, weight)
    share = F.lit(float(rest)) * F.col("w").cast("double") / F.lit(float(weight or 1))
    return ranked.select("s", "source", "z", F.when(stop, (F.col("z") * most).cast("double")).otherwise(share).alias("target")), whole


def split_counts(counts: np.ndarray, room: np.ndarray, seed: list[int]) -> np.ndarray:
    """Counts of each category for each child: a binary tree of multivariate-
    hypergeometric draws over the children; row i sums to ``room[i]``."""
    out = np.zeros((len(room), len(counts)), dtype=np.int64)

    def part(lo: int, hi: int, have: np.ndarray) -> None:
        if hi - lo == 1:
            out[lo] = have
            return
        mid = (lo + hi) // 2
        rng = np.random.Generator(np.random.PCG64([*seed, lo, hi]))
        left = rng.multivariate_hypergeometric(have, int(room[lo:mid].sum()), method="marginals")
        part(lo, mid, left)
        part(mid, hi, have - left)

    part(0, len(room), counts)
    return out


def _deal(seed: int, depth: int, level: int):
    def run(key, cats, rooms):
        node, grp = (k.as_py() for k in key)
        cats, rooms = cats.sort_by("sub"), rooms.sort_by("child")
        got = split_counts(cats.column("n").to_numpy(), rooms.column("room").to_numpy(), [seed, depth, level, node, grp])
        child, cat = np.nonzero(got)
        return pa.table([pa.array(np.full(len(child), node)), pa.array(rooms.column("child").to_numpy()[child]),
                         pa.array(cats.column("sub").to_numpy()[cat]), pa.array(got[child, cat])],
                        names=["node", "child", "sub", "n"])
    return run


def shard_quotas(quotas: DataFrame, n_sources: int, blocks: int, shards: int, seed: int) -> DataFrame:
    """(shard, s, n): blocks of each source in each shard, from (s, n). Shards
    hold equal numbers of blocks, the first ones one more where they must."""
    depths = groups = 1
    while FAN ** depths < shards:
        depths += 1
    while GROUP ** groups < n_sources:
        groups += 1
    each, over = divmod(blocks, shards)

    def before(shard: Column) -> Column:
        """Blocks of all shards before this one."""
        at = F.least(shard, F.lit(shards))
        return at * F.lit(each) + F.least(at, F.lit(over))

    state = quotas.select(F.lit(0).cast("long").alias("node"), F.col("s").alias("sub"), "n")
    for depth in range(depths):
        span = FAN ** (depths - 1 - depth)
        child = F.explode(F.sequence(F.col("node") * FAN, F.col("node") * FAN + FAN - 1)).alias("child")
        # the room of each child, for the one group that holds all sources
        rooms = state.select("node").distinct().select("node", F.lit(0).cast("long").alias("grp"), child) \
            .withColumn("room", before((F.col("child") + 1) * span) - before(F.col("child") * span))
        for level in range(groups - 1, -1, -1):
            cats = state.groupBy("node", F.floor(F.col("sub") / F.lit(GROUP ** (level + 1))).alias("grp"),
                                 F.floor(F.col("sub") / F.lit(GROUP ** level)).alias("cat")) \
                .agg(F.sum("n").alias("n")).withColumnRenamed("cat", "sub")
            dealt = cats.groupBy("node", "grp").cogroup(rooms.groupBy("node", "grp")) \
                .applyInArrow(_deal(seed, depth, level), "node long, child long, sub long, n long")
            rooms = shared_table(dealt, "mix-deal").select("node", F.col("sub").alias("grp"), "child", F.col("n").alias("room"))
        state = rooms.select(F.col("child").alias("node"), F.col("grp").alias("sub"), F.col("room").alias("n"))
    return state.select(F.col("node").alias("shard"), F.col("sub").alias("s"), "n")


def mixture(docs: DataFrame, seed: int = 17, block_words: int = 4096, shard_words: int = 1 << 20, most: int = 3,
            weights: int = 3, id_col: str = "doc_id", text_col: str = "text",
            source_col: str = "source") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(units, plan, sources).

    ``units``: one row per document: doc_id, s, size, text_md5, copy, h (its
    place in the hash order). ``plan``: one row per use of a document in the
    mix: doc_id, text_md5, copy, h, s, epoch, shard, place (order within the shard,
    from 1) and words (its first so many words; all but one document per source
    whole). ``sources``: s, source, z (size), target.

    A document's size is its number of words; null and empty texts, and texts of
    white space, have none: they are units that the plan never uses. Null ids and
    null sources are values like others (null sources weigh last); equal rows are
    units of their own, numbered by ``copy``; a text of any length is one unit.
    An empty table gives empty tables; a corpus without words an empty plan."""
    sized = shared_table(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                                     words(F.col(text_col)).alias("size"), F.md5(F.col(text_col).cast("binary")).alias("text_md5")), "mix-sizes")
    sources, whole = source_targets(sized.groupBy("source").agg(F.sum("size").alias("z")), most, weights)
    block = max(block_words, -(-whole // MOST_BLOCKS))
    take = F.floor(F.col("target") + F.lit(0.5))
    epochs = F.when(F.col("z") > 0, F.floor(take / F.greatest("z", F.lit(1)))).otherwise(0)
    sources = shared_table(sources.withColumn("take", F.least(take, F.col("z") * most)).withColumn("epochs", epochs)
                           .withColumn("rest", F.col("take") - F.col("epochs") * F.col("z"))
                           .withColumn("blocks", F.greatest(F.ceil(F.col("z") / F.lit(block)), F.lit(1))), "mix-targets")
    numbered = sized.join(sources.select("s", F.col("source").alias("__source"), "blocks"),
                          F.col("source").eqNullSafe(F.col("__source"))).drop("source", "__source")
    # equal rows are counted before they are numbered, so none of them meet in one task
    counted = numbered.groupBy("doc_id", "s", "size", "text_md5", "blocks").agg(F.count(F.lit(1)).alias("copies"))
    units = counted.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))) \
        .withColumn("h", F.md5(key_text(F.lit(seed), F.col("s"), F.col("doc_id"), F.col("size"), F.col("text_md5"), F.col("copy")).cast("binary"))) \
        .withColumn("block", hash_cell(F.col("h"), F.col("blocks")))
    units = shared_table(units.drop("copies", "blocks"), "mix-units")
    used = units.where(F.col("size") > 0)

    filled = used.groupBy("s", "block").agg(F.sum("size").alias("words"))
    known = sources.select("s", "epochs", "rest", F.col("blocks").alias("most_blocks"))
    rounds = filled.join(known, "s").withColumn("epoch", F.explode(F.expr(
        "sequence(0L, CASE WHEN rest > 0 THEN epochs ELSE greatest(epochs - 1, 0L) END)"))) \
        .where((F.col("epoch") < F.col("epochs")) | (F.col("rest") > 0)) \
        .withColumn("one", F.lit(1)).withColumn("bh", F.md5(key_text(F.lit(seed), F.col("s"), F.col("epoch"), F.col("block")).cast("binary")))
    ordered = hash_running(rounds, ["s", "epoch"], "bh", F.col("most_blocks"), {"at": "one", "ahead": "words"})
    whole_epoch = F.col("epoch") < F.col("epochs")
    given = F.when(whole_epoch, F.col("words")).otherwise(F.least(F.col("words"), F.col("rest") - F.col("ahead")))
    placed = shared_table(ordered.withColumn("given", given).where(F.col("given") > 0)
                          .select("s", "epoch", "block", "at", "given"), "mix-blocks")
    per_epoch = placed.groupBy("s", "epoch").agg(F.count(F.lit(1)).alias("n"))
    # a source has at most ``most`` + 1 epochs
    earlier = Window.partitionBy("s").orderBy("epoch").rowsBetween(Window.unboundedPreceding, -1)
    starts = shared_table(per_epoch.withColumn("start", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "mix-epochs")
    quotas = starts.groupBy("s").agg(F.sum("n").alias("n"))
    row = starts.agg(F.sum("n"), F.max("s")).first()
    total, n_sources = int(row[0] or 0), int(row[1] or 0) + 1
    shards = max(1, min(total, -(-whole // shard_words)))
    dealt = shard_quotas(quotas, n_sources, total, shards, seed)
    # rows per source: the shards, not its documents
    taken_before = Window.partitionBy("s").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    drawn = dealt.withColumn("first", F.coalesce(F.sum("n").over(taken_before), F.lit(0))) \
        .select("s", "shard", F.explode(F.sequence("first", F.col("first") + F.col("n") - 1)).alias("pos"))
    blocks = placed.join(starts.select("s", "epoch", "start"), ["s", "epoch"]).withColumn("pos", F.col("start") + F.col("at")) \
        .join(drawn, ["s", "pos"]).select("s", "epoch", "block", "given", "shard")
    # a block holds about ``block`` words, so at most as many documents
    inside = Window.partitionBy("s", "block").orderBy("h").rowsBetween(Window.unboundedPreceding, -1)
    offset = used.withColumn("offset", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    plan = offset.join(shared_table(blocks, "mix-drawn"), ["s", "block"]) \
        .withColumn("words", F.least(F.col("size"), F.col("given") - F.col("offset"))).where(F.col("words") > 0)
    shuffled = F.md5(key_text(F.lit(seed), F.col("shard"), F.col("epoch"), F.col("h")).cast("binary"))
    plan = plan.withColumn("place", F.row_number().over(Window.partitionBy("shard").orderBy(shuffled))) \
        .select("doc_id", "text_md5", "copy", "h", "s", "epoch", "shard", "place", "words")
    return units, plan, sources.select("s", "source", "z", "target")


def mix_texts(docs: DataFrame, plan: DataFrame, sources: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              source_col: str = "source") -> DataFrame:
    """The mix itself: (shard, place, doc_id, source, epoch, text), the text cut
    after its last taken word."""
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), F.col(text_col).alias("text"),
                        F.md5(F.col(text_col).cast("binary")).alias("text_md5")) \
        .dropDuplicates(["doc_id", "source", "text_md5"])
    rows = plan.join(sources.select("s", "source"), "s")
    match = (texts["doc_id"].eqNullSafe(rows["doc_id"]) & texts["source"].eqNullSafe(rows["source"])
             & (texts["text_md5"] == rows["text_md5"]))
    cut = F.when(rows["words"] >= words(texts["text"]), texts["text"]).otherwise(first_words(texts["text"], rows["words"]))
    return rows.join(texts, match).select("shard", "place", rows["doc_id"], rows["source"], "epoch", cut.alias("text"))


def first_words(text: Column, n: Column) -> Column:
    """The first ``n`` words, joined by single blanks."""
    return F.concat_ws(" ", F.slice(F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1)), 1, n.cast("int")))


def mix_documents(docs: DataFrame, seed: int = 17, id_col: str = "doc_id", text_col: str = "text",
                  source_col: str = "source", **options) -> DataFrame:
    """Per document: doc_id, size, source_size, target (its source's) and taken,
    the words of it that the mix holds, repeats counted. See ``mixture``."""
    units, plan, sources = mixture(docs, seed, id_col=id_col, text_col=text_col, source_col=source_col, **options)
    taken = plan.groupBy("h").agg(F.sum("words").alias("taken"))
    return units.join(taken, "h", "left") \
        .join(sources.select("s", F.col("z").alias("source_size"), "target"), "s") \
        .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))

"""Top-N subgraph extract: the tables behind the 3-D picture (top vertices,
induced edges, hubs, authorities, styles, volume ladder). Drawing itself is
not built; every table here is bounded by the top-N size."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import expressions as X

# Fixed display values of the reference extract.
TOP_N = 500
MIN_SIZE, MAX_SIZE = 5, 30
MIN_OPACITY, MAX_OPACITY = 0.1, 0.8
LADDER_STEPS = 10


def top_vertices(vertices: DataFrame, n: int = TOP_N) -> DataFrame:
    """The ``n`` vertices with the largest total volume (ties by id)."""
    v = vertices.select("id", "total_volume", "total_transactions", "symbol",
                        F.coalesce("total_buy_volume", F.lit(0.0)).alias("total_buy_volume"),
                        F.coalesce("total_sell_volume", F.lit(0.0)).alias("total_sell_volume"))
    return v.orderBy(F.col("total_volume").desc(), F.col("id")).limit(n)


def induced_edges(edges: DataFrame, top: DataFrame) -> DataFrame:
    """Edges with both ends among ``top``. The caller chooses its size, so the
    two semi joins are left to the planner, which broadcasts by measured size."""
    ids = top.select(F.col("id").alias("_id"))
    e = edges.join(ids, edges.src == ids._id, "left_semi").join(ids, edges.dst == ids._id, "left_semi")
    return e.select("src", "dst", "weight", "total_buy_value", "total_sell_value", "transaction_count",
                    "avg_gas_price")


def _ranked_degree(sub_edges: DataFrame, top: DataFrame, side: str, n: int) -> DataFrame:
    key, name = ("src", "out_degree") if side == "out" else ("dst", "in_degree")
    deg = sub_edges.groupBy(F.col(key).alias("id")).agg(F.count_distinct("src", "dst").alias(name))
    j = top.join(deg, "id", "left").withColumn(name, F.coalesce(F.col(name), F.lit(0)))
    return (j.orderBy(F.col(name).desc(), F.col("id")).limit(n)
            .select("id", X.short_address("id").alias("short_id"), "symbol", name,
                    F.col("total_volume").alias("volume")))


def hubs(sub_edges: DataFrame, top: DataFrame, n: int = 10) -> DataFrame:
    """Top ``n`` vertices of the subgraph by out-degree."""
    return _ranked_degree(sub_edges, top, "out", n)


def authorities(sub_edges: DataFrame, top: DataFrame, n: int = 10) -> DataFrame:
    """Top ``n`` vertices of the subgraph by in-degree."""
    return _ranked_degree(sub_edges, top, "in", n)


def vertex_style(top: DataFrame) -> DataFrame:
    """Marker size log1p(volume) / log1p(max volume) * 25 + 5 and a colour
    index: rank of the symbol among the sorted distinct symbols (empty or
    missing symbol -> 0). ``top`` is at most N rows, so the max is one
    scalar and the ranking window over it is bounded."""
    mx = top.agg(F.max("total_volume")).first()[0]
    denom = math.log1p(mx) if mx is not None and mx > 0 else None
    size = (F.log1p("total_volume") / F.lit(denom) * F.lit(MAX_SIZE - MIN_SIZE) + F.lit(MIN_SIZE)
            if denom else F.lit(float(MIN_SIZE)))
    has_sym = F.col("symbol").isNotNull() & (F.col("symbol") != "")
    ranked = top.withColumn("_s", F.when(has_sym, F.col("symbol")))
    w = Window.orderBy(F.col("_s").asc_nulls_last())
    ranked = ranked.withColumn("_r", F.dense_rank().over(w) - 1)
    return ranked.select("id", "symbol", "total_volume", size.alias("size"),
                         F.when(has_sym, F.col("_r")).otherwise(F.lit(0)).cast("long").alias("color_index"))


def edge_style(sub_edges: DataFrame) -> DataFrame:
    """Opacity clip(w / max w, 0.1, 0.8) and width 1 + 3 w / max w."""
    mx = sub_edges.agg(F.max("weight")).first()[0]
    rel = F.col("weight") / F.lit(float(mx)) if mx else F.lit(1.0)
    return sub_edges.select("src", "dst", "weight",
                            F.least(F.lit(MAX_OPACITY), F.greatest(F.lit(MIN_OPACITY), rel)).alias("opacity"),
                            (F.lit(1.0) + F.lit(3.0) * rel).alias("width"))


def ladder_fractions(steps: int = LADDER_STEPS) -> list[float]:
    """Evenly spaced fractions 0 .. 1 (the last exactly 1)."""
    if steps == 1:
        return [0.0]
    d = 1.0 / (steps - 1)
    return [i * d for i in range(steps - 1)] + [1.0]


def volume_ladder(top: DataFrame, sub_edges: DataFrame, steps: int = LADDER_STEPS) -> DataFrame:
    """For ``steps`` volume thresholds from min to max: how many vertices
    have volume >= t and how many edges have both ends >= t.

    Each vertex / edge is expanded by ``steps`` (a fixed factor, not a
    pairing), then grouped by step."""
    r = top.agg(F.min("total_volume").alias("lo"), F.max("total_volume").alias("hi")).first()
    lo, hi = r["lo"], r["hi"]
    if lo is None:
        return top.sparkSession.createDataFrame([], "step int, threshold double, visible_vertices long, "
                                                    "visible_edges long")
    th = F.array(*[F.lit(lo + f * (hi - lo)) for f in ladder_fractions(steps)])
    vol = top.select("id", "total_volume")
    v = vol.select(F.posexplode(th).alias("step", "threshold"), "total_volume") \
        .where(F.col("total_volume") >= F.col("threshold")) \
        .groupBy("step").agg(F.count(F.lit(1)).alias("visible_vertices"))
    ends = (sub_edges.select("src", "dst")
            .join(vol.select(F.col("id").alias("src"), F.col("total_volume").alias("vs")), "src")
            .join(vol.select(F.col("id").alias("dst"), F.col("total_volume").alias("vd")), "dst")
            .select(F.least("vs", "vd").alias("m")))
    e = ends.select(F.posexplode(th).alias("step", "threshold"), "m") \
        .where(F.col("m") >= F.col("threshold")) \
        .groupBy("step").agg(F.count(F.lit(1)).alias("visible_edges"))
    steps_df = top.sparkSession.range(steps).select(F.col("id").cast("int").alias("step"))
    out = steps_df.withColumn("threshold", F.element_at(th, F.col("step") + 1))
    return (out.join(v, "step", "left").join(e, "step", "left")
            .select("step", "threshold", F.coalesce("visible_vertices", F.lit(0)).alias("visible_vertices"),
                    F.coalesce("visible_edges", F.lit(0)).alias("visible_edges")))

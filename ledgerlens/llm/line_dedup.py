"""Line dedup (native): explode normalised lines, hash them, count the distinct
documents of each hash, drop lines over the threshold, reassemble by position."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ASCII_SPACE, ascii_lower, hash128, shared_table


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """Drop every line whose key occurs in at least ``min_docs`` documents.

    A key is the line stripped of ASCII white space at both ends with A-Z
    lower-cased; keys shorter than ``min_chars`` code points are never dropped.
    Returns the input columns with ``text_col`` replaced by the kept lines, plus
    ``n_lines`` and ``n_dropped`` (a column of these names in the input is
    replaced). A null or empty text is one empty line and becomes the empty
    text; rows of a repeated id are one document for the count and each is
    cleaned by itself; null ids together count as one document; an empty table
    gives an empty table.

    Only (hash, id) pairs and dropped positions are shuffled besides one pass of
    the texts; both counts pre-aggregate, so a line in every document costs one
    row per task."""
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("body"))
    rows = rows.withColumn("th", F.xxhash64("body"))
    at = rows.select("id", "th", F.posexplode(F.split("body", "\n", -1)).alias("pos", "line"))
    at = at.withColumn("key", ascii_lower(F.btrim("line", F.lit(ASCII_SPACE)))) \
        .where(F.length("key") >= max(1, min_chars)) \
        .select("id", "th", "pos", hash128(F.col("key")).alias("h"))
    at = at.select("id", "th", "pos", F.col("h.a").alias("ha"), F.col("h.b").alias("hb"))
    common = at.groupBy("ha", "hb").agg(F.count_distinct(F.struct("id")).alias("n")) \
        .where(F.col("n") >= min_docs).select("ha", "hb")
    # read back, so that the join's sides are plain exchanges and a hot line can be split
    common = shared_table(common, "common-lines")
    dropped = at.join(common, ["ha", "hb"]).groupBy("id", "th") \
        .agg(F.collect_set("pos").alias("gone")) \
        .select(F.col("id").alias("gid"), F.col("th").alias("gth"), "gone")
    out = rows.join(dropped, F.col("id").eqNullSafe(F.col("gid")) & (F.col("th") == F.col("gth")), "left")
    lines = F.split("body", "\n", -1)
    gone = F.coalesce("gone", F.array().cast("array<int>"))
    keep = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
    text = F.when(F.col("gone").isNull(), F.col("body")) \
        .otherwise(F.array_join(F.transform(keep, lambda p: F.get(lines, p)), "\n"))
    new = {text_col: text, "n_lines": F.size(lines).cast("long"), "n_dropped": F.size(gone).cast("long")}
    return out.select(*[new[c].alias(c) if c in new else F.col("row")[c].alias(c) for c in docs.columns],
                      *[v.alias(k) for k, v in new.items() if k not in docs.columns])

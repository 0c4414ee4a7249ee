"""Best-fit packing by minimum bin slack.

The plan needs only the histogram of piece lengths (at most ``size`` rows): for
each bin a bitset subset-sum over the available lengths finds the fullest
combination that holds the longest piece left, which is then removed - as often
as the counts allow, so the number of steps depends on the number of lengths and
not on the corpus. Pieces then find their place by their rank in their length."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batches, shared_table, text_bytes
from .tokens import encoder

#: Pieces of one length that one task ranks.
RANK_ROWS = 4_000


def fullest(counts: dict[int, int], order: list[int], room: int) -> dict[int, int]:
    """The combination of available lengths with the largest sum <= ``room``:
    {length: how many}. ``order`` lists the lengths, longest first."""
    sums, full, steps = 1, 1 << room, []
    mask = (full << 1) - 1
    for length in order:
        left = min(counts[length], room // length) if length <= room else 0
        unit = 1
        while left > 0:        # binary splitting of the count
            take = min(unit, left)
            steps.append((length, take, sums))
            sums |= (sums << length * take) & mask
            left -= take
            unit *= 2
        if sums & full:
            break
    at, found = sums.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> at & 1:
            found[length] = found.get(length, 0) + take
            at -= length * take
    return found


def plan_bins(histogram: dict[int, int], size: int) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, rank from, rank to, per bin, offset, first bin): the pieces
    of that length with ranks in [from, to) go, ``per bin`` at a time, to bins
    counted from ``first bin``, laid from ``offset`` on."""
    counts = {k: v for k, v in histogram.items() if v > 0}
    used = dict.fromkeys(counts, 0)
    order, rows, bins = sorted(counts, reverse=True), [], 0
    while order:
        top = order[0]
        counts[top] -= 1
        combo = fullest(counts, order, size - top)
        counts[top] += 1
        combo[top] = combo.get(top, 0) + 1
        times = min(counts[k] // n for k, n in combo.items())
        offset = 0
        for length, n in sorted(combo.items(), reverse=True):
            rows.append((length, used[length], used[length] + n * times, n, offset, bins))
            used[length] += n * times
            counts[length] -= n * times
            offset += n * length
        order = [k for k in order if counts[k] > 0]
        bins += times
    return rows


def token_pieces(docs: DataFrame, tokenizer: str, size: int = 4096, end_id: int = 1,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): documents as ids with the end
    id, cut into pieces of ``size`` where longer."""
    def run(frames):
        enc = encoder(tokenizer)
        end = end_id.to_bytes(enc.size, "little")
        for b in batches(frames):
            out = [[] for _ in range(5)]
            for doc_id, body in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = np.frombuffer(enc.encode(body.decode("utf-8", "replace")) + end, dtype=enc.dtype).astype("<u4")
                for k, at in enumerate(range(0, len(ids), size)):
                    part = ids[at:at + size]
                    for col, v in zip(out, (doc_id, k, at, len(part), zlib.crc32(part.tobytes()))):
                        col.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])
    return text_bytes(docs, id_col, text_col) \
        .mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(pieces: DataFrame, size: int = 4096) -> DataFrame:
    """Adds (sequence_id, offset) to ``pieces`` (length between 1 and ``size``).

    The rank of a piece among those of its length is its rank within a hash
    group of about ``RANK_ROWS`` rows plus the sizes of the groups before it, so
    a length that holds a third of the corpus is ranked by many tasks. Equal
    rows are told apart by a row number."""
    spark = pieces.sparkSession
    total = pieces.count()
    groups = max(1, -(-total // RANK_ROWS))
    rows = pieces.withColumn("g", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)))
    sizes = rows.groupBy("length", "g").agg(F.count(F.lit(1)).alias("n"))
    ahead = Window.partitionBy("length").orderBy("g").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("base", F.coalesce(F.sum("n").over(ahead), F.lit(0))).drop("n")
    # at most ``size`` rows
    hist = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    steps = plan_bins(hist, size)
    plan = spark.createDataFrame(steps or [(0, 0, 0, 1, 0, 0)],
                                 "p_length long, p_from long, p_to long, p_each long, p_offset long, p_bin long")
    inside = Window.partitionBy("length", "g").orderBy("doc_id", "piece", "ids_crc32")
    ranked = rows.withColumn("rn", F.row_number().over(inside)).join(sizes, ["length", "g"]) \
        .withColumn("rank", F.col("base") + F.col("rn") - 1)
    # a few rows per length: bounded by ``size`` and by the slack steps, not by the corpus
    placed = ranked.join(F.broadcast(plan), (F.col("length") == F.col("p_length")) & (F.col("rank") >= F.col("p_from"))
                         & (F.col("rank") < F.col("p_to")))
    turn = F.col("rank") - F.col("p_from")
    return placed.select(*[F.col(c) for c in pieces.columns],
                         (F.col("p_bin") + F.floor(turn / F.col("p_each"))).alias("sequence_id"),
                         (F.col("p_offset") + turn % F.col("p_each") * F.col("length")).alias("offset"))


def pack_documents(docs: DataFrame, tokenizer: str, size: int = 4096, end_id: int = 1,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset. Null texts are empty documents (the end id alone); null and repeated
    ids are packed like others, each row by itself; an empty table gives no
    rows; further columns of ``docs`` are ignored."""
    return pack(shared_table(token_pieces(docs, tokenizer, size, end_id, id_col, text_col), "pieces"), size)


def sequences(docs: DataFrame, packed: DataFrame, tokenizer: str, end_id: int = 1,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(sequence_id, ids): the packed sequences themselves. Needs unique ids; a
    sequence is at most ``size`` ids, so each group is bounded."""
    def run(frames):
        enc = encoder(tokenizer)
        end = end_id.to_bytes(enc.size, "little")
        for b in batches(frames):
            out = []
            for body, at, n in zip(*(b.column(i).to_pylist() for i in (3, 4, 5))):
                ids = enc.encode(body.decode("utf-8", "replace")) + end
                out.append(np.frombuffer(ids, dtype=enc.dtype)[at:at + n].astype("<i4").tolist())
            yield pa.RecordBatch.from_arrays([b.column(1), b.column(2), pa.array(out, pa.list_(pa.int32()))],
                                             names=["sequence_id", "offset", "part"])
    joined = packed.select("doc_id", "sequence_id", "offset", "start", "length") \
        .join(text_bytes(docs, id_col, text_col), "doc_id") \
        .select("doc_id", "sequence_id", "offset", "body", "start", "length")
    parts = joined.mapInArrow(run, "sequence_id long, offset long, part array<int>")
    return parts.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "part"))).alias("p")) \
        .select("sequence_id", F.flatten("p.part").alias("ids"))

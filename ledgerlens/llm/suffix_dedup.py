"""Suffix-array dedup: drop every byte of a repeated byte string of ``length``.

Equal windows of ``length`` bytes share the smallest hash of their ``GRAM``-byte
substrings (the anchor), so suffixes can be dealt to buckets by anchor and each
bucket be sorted by itself:

1. runs: consecutive window starts with one anchor (at most ``RUN``) become a row
   (anchor, content hash, document, start). Anchors that occur once hold no
   repeat and go.
2. classes: runs of equal content collapse to their earliest member; all other
   members are repeats as a whole (pre-aggregated, so copies cost one row a task).
3. sort: where an anchor has several classes, the suffixes of the classes' first
   runs are sorted by bytes with deep-shallow sorting - multikey quicksort on
   8-byte words to ``SHALLOW`` bytes, then blind tries that branch only where
   the suffixes of a group differ. Neighbours that agree on ``length`` bytes are
   repeats of the earliest of them.
4. each document's repeated windows are cut from its bytes.

An anchor with more than ``HOT`` classes is dealt window by window over several
buckets, by window hash; equal windows still meet."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import shared_table

GRAM, RUN, SHALLOW, HOT = 32, 96, 24, 2000
#: Bytes of text hashed at once, window starts per piece of a long text, text bytes sorted at once.
SLAB, PIECE, SORT_BYTES = 1 << 17, 1 << 20, 2 << 20
_M1, _M2, _BASE = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), 0x9E3779B97F4A7C15


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h *= _M1
    h ^= h >> np.uint64(29)
    h *= _M2
    h ^= h >> np.uint64(32)
    return h


def gram_hashes(body: np.ndarray, width: int) -> np.ndarray:
    """Mixed 64-bit hashes of all ``width``-byte substrings (a power of two)."""
    h, base, have = body.astype(np.uint64) + np.uint64(1), _BASE, 1
    while have < width:
        h = h[:-have] * np.uint64(base) + h[have:]
        base = base * base & (1 << 64) - 1
        have *= 2
    return _mix(h)


def _sliding(h: np.ndarray, width: int, pick) -> np.ndarray:
    have = 1
    while have * 2 <= width:
        h = pick(h[:-have], h[have:])
        have *= 2
    rest = width - have
    return pick(h[:len(h) - rest], h[rest:]) if rest else h


def runs(bodies: list[tuple[int, int, bytes]], length: int):
    """Runs of the texts of one slab, given as (row, offset, bytes) pieces:
    arrays row, start, count, self, anchor, content. ``self`` marks a run in
    which one window may repeat (its anchor occurs twice)."""
    sizes = np.array([len(b) for _, _, b in bodies])
    ends = np.cumsum(sizes)
    text = np.frombuffer(b"".join(b for _, _, b in bodies), dtype=np.uint8)
    if len(text) < length:
        return None
    grams = length - GRAM + 1
    h = gram_hashes(text, GRAM)
    m = _sliding(h, grams, np.minimum)
    owner = np.repeat(np.arange(len(bodies)), sizes)[:len(m)]
    valid = np.arange(len(m)) + length <= ends[owner]
    new = np.ones(len(m), dtype=bool)
    new[1:] = (m[1:] != m[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new & valid)
    if not len(at):
        return None
    # up to the next change, the end of the valid starts, or the largest run
    stops = np.flatnonzero(np.concatenate([new[1:] | (valid[:-1] & ~valid[1:]), [True]])) + 1
    count = stops[np.searchsorted(stops, at, side="right")] - at
    times = -(-count // RUN)
    nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    at, count = np.repeat(at, times) + nth * RUN, np.repeat(count, times) - nth * RUN
    count = np.minimum(count, RUN)
    anchor = m[at]
    # places of anchors: grams that are the smallest of some window
    spread = np.concatenate([np.zeros(grams - 1, dtype=np.uint64), np.where(valid, m, 0), np.zeros(grams - 1, dtype=np.uint64)])
    place = np.flatnonzero(_sliding(spread, grams, np.maximum) == h)
    value = h[place]
    i, last = np.searchsorted(place, at), np.searchsorted(place, at + count + grams - 1)
    seen = np.zeros(len(at), dtype=np.int64)
    live = np.flatnonzero(i < last)
    while len(live):
        seen[live] += value[i[live]] == anchor[live]
        i[live] += 1
        live = live[(i[live] < last[live]) & (seen[live] < 2)]
    # the content: hashes of the grams that tile the run's bytes, and its count
    end = at + count - 1 + length - GRAM
    content = _mix(h[at] ^ (count.astype(np.uint64) << np.uint64(56)))
    for step in range(GRAM, RUN + length - GRAM, GRAM):
        content = _mix(content * np.uint64(3) + h[np.minimum(at + step, end)])
    content = _mix(content * np.uint64(5) + h[end])
    mine = owner[at]
    offset = np.array([o for _, o, _ in bodies])[mine] - (ends - sizes)[mine]
    return np.array([r for r, _, _ in bodies])[mine], at + offset, count, seen >= 2, anchor, content


def _slabs(bodies: list[bytes], length: int):
    """The texts as slabs of about ``SLAB`` bytes; long texts in pieces that
    overlap by a window."""
    slab, size = [], 0
    for row, body in enumerate(bodies):
        for o in range(0, max(1, len(body) - length + 1), PIECE):
            part = body[o:o + PIECE + length - 1] if len(body) > PIECE else body
            slab.append((row, o, part))
            size += len(part)
            if size >= SLAB:
                yield slab
                slab, size = [], 0
    if slab:
        yield slab


def _pack(start, count, again):
    return start.astype(np.int64) << 8 | count.astype(np.int64) << 1 | again.astype(np.int64)


def _unpack(at: np.ndarray):
    return at >> 8, at >> 1 & 127, at & 1


# --- deep-shallow sorting -------------------------------------------------

def _words(text: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on as one big-endian number."""
    w = text.astype(np.uint64)
    for have in (1, 2, 4):
        w = (w[:-have] << np.uint64(8 * have)) | w[have:]
    return w


def _refine(order, group, key):
    """Sort within groups by ``key`` and split the groups where it differs."""
    by = np.lexsort((key, group))
    order, group, key = order[by], group[by], key[by]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (group[1:] != group[:-1]) | (key[1:] != key[:-1])
    return order, np.cumsum(new) - 1


def _shared(group):
    """Mask of members whose group (sorted numbers) has others."""
    same = group[1:] == group[:-1]
    return np.concatenate([[False], same]) | np.concatenate([same, [False]])


def equal_suffixes(text: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(members, group): the suffixes (indices into ``starts``) that agree on
    ``length`` bytes with another, in suffix order, and the number of their
    group. Deep-shallow: multikey quicksort to ``SHALLOW`` bytes, then blind
    tries for the groups that still agree."""
    word = _words(text)
    order, group = np.arange(len(starts)), np.zeros(len(starts), dtype=np.int64)
    depth = 0
    while depth < min(SHALLOW, length) and len(order):
        order, group = _refine(order, group, word[starts[order] + min(depth, length - 8)])
        keep = _shared(group)
        order, group = order[keep], group[keep]
        depth += 8
    done_o, done_g, found = [], [], 0
    # a node of the blind trie is a group with the depth of its first branching;
    # the words on which its members agree are skipped, not stored
    depth = np.full(len(order), depth)
    while len(order):
        key = word[starts[order] + np.minimum(depth, length - 8)]
        first = np.concatenate([[True], group[1:] != group[:-1]])
        head, mine = np.flatnonzero(first), np.cumsum(first) - 1
        differ = np.flatnonzero(np.logical_or.reduceat(key != key[head][mine], head)[mine])
        if len(differ):         # only these branch here
            by = differ[np.lexsort((key[differ], group[differ]))]
            order[differ], key[differ] = order[by], key[by]
        new = first
        new[1:] |= key[1:] != key[:-1]
        group, depth = np.cumsum(new) - 1, depth + 8
        keep, leaf = _shared(group), depth >= length
        ended = keep & leaf
        if ended.any():
            done_o.append(order[ended])
            done_g.append(np.unique(group[ended], return_inverse=True)[1] + found)
            found = done_g[-1][-1] + 1
        keep &= ~leaf
        order, group, depth = order[keep], group[keep], depth[keep]
    if not done_o:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    return np.concatenate(done_o), np.concatenate(done_g)


def _repeats(rows: list[tuple[int, int, int, int, bytes]], length: int):
    """Of (doc, ord, start, count, bytes) rows: the windows that are not the
    earliest of their equals, as arrays doc, ord, start, count of stretches."""
    texts = [r[4] for r in rows]
    base = np.cumsum([0, *map(len, texts)])
    text = np.frombuffer(b"".join(texts), dtype=np.uint8)
    count = np.array([r[3] for r in rows])
    row = np.repeat(np.arange(len(rows)), count)
    step = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    member, group = equal_suffixes(text, base[row] + step, length)
    if not len(member):
        return None
    doc, order, start = (np.array([r[i] for r in rows], dtype=np.int64) for i in (0, 1, 2))
    d, o, s = doc[row[member]], order[row[member]], start[row[member]] + step[member]
    by = np.lexsort((s, o, d, group))
    later = by[1:][group[by][1:] == group[by][:-1]]
    by = np.lexsort((s[later], o[later], d[later]))
    d, o, s = d[later][by], o[later][by], s[later][by]
    if not len(d):
        return None
    new = np.ones(len(d), dtype=bool)
    new[1:] = (d[1:] != d[:-1]) | (o[1:] != o[:-1]) | (s[1:] > s[:-1] + 1)
    at = np.flatnonzero(new)
    return d[at], o[at], s[at], s[np.append(at[1:], len(d)) - 1] - s[at] + 1


# --- the job ----------------------------------------------------------------

def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, ord, twin, body): ``ord`` orders different texts of one id and
    ``twin`` is the number of equal rows, here one; both are 0 and 1 for an id
    that occurs once. A null id sorts first."""
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("doc"),
                       F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("body"))
    many = rows.groupBy("doc").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select("doc")
    if many.isEmpty():
        return rows.select("doc", F.lit(0).alias("ord"), F.lit(1).cast("long").alias("twin"), "body")
    rows = rows.withColumn("th", F.xxhash64("body"))
    texts = rows.select("doc", "th").groupBy("doc", "th").agg(F.count(F.lit(1)).alias("twin"))
    texts = texts.withColumn("ord", F.row_number().over(Window.partitionBy("doc").orderBy("th")) - 1)
    once = rows.groupBy("doc", "th").agg(F.first("body").alias("body"))
    return shared_table(once.join(texts, ["doc", "th"]).select("doc", "ord", "twin", "body"), "suffix-texts")


def _common_anchors(rows: DataFrame, length: int, most: int = 4000, share: float = 0.005) -> list[int]:
    """Anchors of at least ``share`` of about ``most`` sampled documents. They
    steer the deal of rows to tasks (salting) and nothing else; the list is
    bounded by the sample."""
    total = rows.count()
    part = rows.select("body").sample(min(1.0, most / max(1, total)), seed=11)

    def anchors(frames):
        for b in frames:
            for slab in _slabs(b.column(0).to_pylist(), length):
                got = runs(slab, length)
                if got is not None:
                    key = np.unique(np.stack([got[0].astype(np.uint64), got[4]]), axis=1)[1]
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64))], names=["anchor"])
    least = max(20, int(min(most, total) * share))
    found = part.mapInArrow(anchors, "anchor long").groupBy("anchor").agg(F.count(F.lit(1)).alias("n")) \
        .where(F.col("n") >= least).select("anchor")
    return sorted(r["anchor"] for r in found.collect())


def repeated_runs(rows: DataFrame, length: int) -> DataFrame:
    """(anchor, content, doc, ord, at) of the runs whose anchor occurs again."""
    common = np.array(_common_anchors(rows, length), dtype=np.int64)

    def run(frames):
        for b in frames:
            doc, order = b.column(0).to_numpy(), b.column(1).to_numpy()
            for slab in _slabs(b.column(2).to_pylist(), length):
                got = runs(slab, length)
                if got is None:
                    continue
                row, start, count, again, anchor, content = got
                anchor = anchor.view(np.int64)
                hot = np.isin(anchor, common)
                salt = np.where(hot, 1 + content.view(np.int64) % 61, 0).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (anchor, salt, content.view(np.int64), doc[row], order[row].astype(np.int32),
                                           _pack(start, count, again))],
                    names=["anchor", "salt", "content", "doc", "ord", "at"])
    every = rows.select("doc", "ord", "body") \
        .mapInArrow(run, "anchor long, salt int, content long, doc long, ord int, at long")
    n = F.count(F.lit(1)).over(Window.partitionBy("anchor", "salt"))
    return every.withColumn("n", n).where((F.col("n") > 1) | (F.col("salt") > 0) | (F.col("at") % 2 == 1)) \
        .select("anchor", "content", "doc", "ord", "at")


def _sorted_repeats(texts: DataFrame, classes: DataFrame, length: int) -> DataFrame:
    """(doc, ord, start, count) of repeated windows among the classes' first
    runs, from sorting their suffixes."""
    sizes = classes.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    several = classes.join(sizes, "anchor", "left") \
        .where(F.col("n").isNotNull() | (F.col("first.at") % 2 == 1)) \
        .select(F.col("first.doc").alias("doc"), F.col("first.ord").alias("o"),
                F.struct("anchor", F.coalesce("n", F.lit(1)).alias("n"), F.col("first.at").alias("at")).alias("run"))
    per_doc = several.groupBy("doc", "o").agg(F.collect_list("run").alias("runs"))      # within one document
    held = texts.join(per_doc.select(F.col("doc").alias("d2"), "o", "runs"),
                      (F.col("doc") == F.col("d2")) & (F.col("ord") - F.col("o") == 0)) \
        .select("doc", "ord", "packed", "runs", "twin")      # the columns of the last join: one exchange

    def cut(frames):
        unzip = zstandard.ZstdDecompressor()
        names = ["anchor", "salt", "doc", "ord", "start", "count", "bytes"]
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary()]
        for b in frames:
            out, held = [], 0
            for i in range(b.num_rows):
                doc, order = b.column(0)[i].as_py(), b.column(1)[i].as_py()
                body = unzip.decompress(b.column(2)[i].as_py())
                s = b.column(3)[i].values
                anchor, n, at = (s.field(k).to_numpy() for k in ("anchor", "n", "at"))
                start, count, _ = _unpack(at)
                for a, k, p, c in zip(anchor.tolist(), n.tolist(), start.tolist(), count.tolist()):
                    part = body[p:p + c + length - 1]
                    held += len(part)
                    if k <= HOT:
                        out.append((a, 0, doc, order, p, c, part))
                        continue
                    parts = 1 + k * RUN // HOT
                    for w in range(c):
                        one = part[w:w + length]
                        out.append((a, 1 + xxhash.xxh32_intdigest(one) % parts, doc, order, p + w, 1, one))
                        held += length
                if held > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
                    out, held = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    buckets = held.mapInArrow(cut, "anchor long, salt int, doc long, ord int, start long, count int, bytes binary")

    def sort(frames):
        def flush(rows):
            got = _repeats(rows, length)
            if got is not None:
                d, o, s, c = got
                yield pa.RecordBatch.from_arrays([pa.array(d), pa.array(o.astype(np.int32)), pa.array(s), pa.array(c)],
                                                 names=["doc", "ord", "start", "count"])
        rows, held, key = [], 0, None
        for b in frames:
            for a, salt, *row in zip(*(c.to_pylist() for c in b.columns)):
                if (a, salt) != key and held > SORT_BYTES:      # buckets are never cut
                    yield from flush(rows)
                    rows, held = [], 0
                key = (a, salt)
                rows.append(tuple(row))
                held += len(row[-1])
        if rows:
            yield from flush(rows)

    return buckets.repartition("anchor", "salt").sortWithinPartitions("anchor", "salt") \
        .mapInArrow(sort, "doc long, ord int, start long, count long")


def kept_bytes(body: bytes, cover: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """(kept, bytes removed, removed stretches) after cutting [from, to) spans."""
    if not cover:
        return body, 0, 0
    edge = np.zeros(len(body) + 1, dtype=np.int32)
    a, b = np.array(cover).T
    np.add.at(edge, a, 1)
    np.add.at(edge, np.minimum(b, len(body)), -1)
    gone = np.cumsum(edge[:-1]) > 0
    spans = int(gone[0]) + int(np.count_nonzero(gone[1:] & ~gone[:-1]))
    return np.frombuffer(body, dtype=np.uint8)[~gone].tobytes(), int(gone.sum()), spans


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100,
                 with_text: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) per row of ``docs``, and
    ``kept`` (the remaining bytes) with ``with_text``.

    Texts are UTF-8 bytes (null: empty). A byte goes if a ``length``-byte string
    over it also starts earlier: in a smaller id, or in the same document before.
    Different texts of one id are ordered by their hash; of equal rows the first
    is the earlier one; a null id sorts first and stays null. Texts shorter than
    ``length`` stay whole. An empty table gives no rows; other columns are not
    used."""
    rows = _keyed(docs, id_col, text_col)
    dup = shared_table(repeated_runs(rows, length), "suffix-runs")
    classes = shared_table(dup.groupBy("anchor", "content")
                           .agg(F.min(F.struct("doc", "ord", "at")).alias("first")), "suffix-classes")

    def squeeze(frames):
        z = zstandard.ZstdCompressor(level=1, write_content_size=True)
        for b in frames:
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:3], pa.array([z.compress(x) for x in b.column(3).to_pylist()], pa.binary())],
                names=["doc", "ord", "twin", "packed"])
    texts = rows.mapInArrow(squeeze, "doc long, ord int, twin long, packed binary")
    more = _sorted_repeats(texts, classes, length)
    # per document: its repeated runs, those that are the first of their class, and stretches from the sort
    marks = dup.select("doc", "ord", F.lit(0).alias("kind"), "at", F.lit(0).cast("long").alias("count")) \
        .unionByName(classes.select("first.doc", "first.ord", F.lit(1).alias("kind"), F.col("first.at").alias("at"),
                                    F.lit(0).cast("long").alias("count"))) \
        .unionByName(more.select("doc", "ord", F.lit(2).alias("kind"), F.col("start").alias("at"), "count"))
    marks = marks.groupBy("doc", "ord").agg(F.collect_list(F.struct("kind", "at", "count")).alias("marks")) \
        .select(F.col("doc").alias("d2"), F.col("ord").alias("o"), "marks")
    joined = texts.join(marks, (F.col("doc") == F.col("d2")) & (F.col("ord") - F.col("o") == 0), "left") \
        .select("doc", "ord", "twin", "packed", "marks")

    def apply(frames):
        unzip = zstandard.ZstdDecompressor()
        for b in frames:
            out = []
            for doc, twin, packed, marks in zip(*(b.column(i) for i in (0, 2, 3, 4))):
                doc, body = doc.as_py(), unzip.decompress(packed.as_py())
                cover = []
                if marks.is_valid:
                    kind, at, count = (marks.values.field(k).to_numpy() for k in ("kind", "at", "count"))
                    start, n, _ = _unpack(np.setdiff1d(at[kind == 0], at[kind == 1]))
                    cover = list(zip(start.tolist(), (start + n + length - 1).tolist()))
                    cover += zip(at[kind == 2].tolist(), (at[kind == 2] + count[kind == 2] + length - 1).tolist())
                for k in range(twin.as_py()):
                    if k and len(body) >= length:       # equal to an earlier row
                        cover = [(0, len(body))]
                    kept, removed, spans = kept_bytes(body, cover)
                    out.append((None if doc == -(1 << 63) else doc, len(body), removed, spans,
                                hashlib.sha256(kept).hexdigest(), kept if with_text else None))
            if out:
                types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)],
                                                 names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])
    out = joined.mapInArrow(apply, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return out if with_text else out.drop("kept")

"""Toxicity: the nearest labelled examples by exact TF-IDF cosine, found with a
block-max inverted index; distance-weighted votes give calibrated scores and the
examples themselves are the evidence.

Terms are words and their first letters (4 to 9), so inflected forms share a
term. The index vocabulary is chosen on the labelled sample by a likelihood
ratio; document frequencies are counted over all documents."""

from __future__ import annotations

import uuid
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batches, one_per_id, shared_table, text_bytes

#: Bounds of the fit: labelled rows used, taken in hash order of their ids.
MAX_EXAMPLES = 12_000
BLOCK = 256
_EDGE = "".join(chr(i) for i in range(33, 127) if not chr(i).isalnum()) + "«»“”„‘’…–—¡¿"
_CACHE = 300_000


def word_terms(chunk: str) -> tuple[str, ...]:
    """The terms of one blank-free chunk: its word and its word beginnings."""
    w = chunk.strip(_EDGE).lower()
    if not w:
        return (chunk[0],) if chunk else ()       # marks alone: their first one
    return (w, *("^" + w[:n] for n in range(4, 10) if len(w) > n))


class _Lookup(dict):
    """chunk -> term numbers, learnt on demand, bounded."""

    def __init__(self, vocabulary: dict[str, int]):
        super().__init__()
        self.vocabulary = vocabulary
        # most words share no beginning with any term: one look tells
        self.heads = {t.lstrip("^")[:4] if len(t) > 1 else t for t in vocabulary}

    def __missing__(self, chunk: str):
        if len(self) > _CACHE:
            self.clear()
        word = chunk.strip(_EDGE).lower() or chunk[:1]
        v = self.vocabulary
        out = self[chunk] = tuple(v[t] for t in word_terms(chunk) if t in v) if word[:4] in self.heads else ()
        return out


_LOOKUPS: dict[str, _Lookup] = {}


def _lookup(key: str, vocabulary: dict[str, int]) -> _Lookup:
    """One lookup per worker process and fit: tasks share what is learnt."""
    if key not in _LOOKUPS:
        _LOOKUPS.clear()
        _LOOKUPS[key] = _Lookup(vocabulary)
    return _LOOKUPS[key]


def term_counts(text: str, lookup: _Lookup) -> Counter:
    return Counter([t for ts in map(lookup.__getitem__, text.split()) if ts for t in ts])


def labelled_rows(labels: DataFrame, label_col: str, held_out: Column, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, y) of all labelled rows that are not held out. Ids labelled twice
    count once (the larger label); null ids and null labels are left out."""
    return labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out) \
        .groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(F.max(label_col).cast("int").alias("y"))


def labelled_sample(labels: DataFrame, label_col: str, held_out: Column, bound: int,
                    id_col: str = "doc_id") -> DataFrame:
    """At most ``bound`` of the labelled rows, in hash order: the documented bound
    of the fit."""
    return labelled_rows(labels, label_col, held_out, id_col).orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)


class BlockMaxIndex:
    """Unit-length example vectors as an inverted index: per term its examples
    and weights, and per (block of examples, term) the largest weight."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], n_terms: int, block: int = BLOCK):
        self.n, self.n_terms, self.block = len(vectors), n_terms, block
        sizes = [len(t) for t, _ in vectors]
        example = np.repeat(np.arange(self.n), sizes)
        term, weight = (np.concatenate([v[i] for v in vectors]) if sum(sizes) else np.empty(0) for i in (0, 1))
        term = term.astype(np.int64)
        order = np.lexsort((example, term))
        self.example, self.weight = example[order], weight[order]
        self.first = np.searchsorted(term[order], np.arange(n_terms + 1))
        self.top = np.zeros((n_terms, -(-self.n // block)))
        np.maximum.at(self.top, (term, example // block), weight)

    def _cosines(self, terms: np.ndarray, weights: np.ndarray, alive: np.ndarray) -> np.ndarray:
        """Inner products with the examples of the blocks that are ``alive``."""
        if alive.sum() == 1:
            b = int(np.flatnonzero(alive)[0])
            cut = [slice(*(f + np.searchsorted(self.example[f:t], (b * self.block, (b + 1) * self.block))))
                   for f, t in zip(self.first[terms], self.first[terms + 1])]
        else:
            cut = [slice(f, t) for f, t in zip(self.first[terms], self.first[terms + 1])]
        example = np.concatenate([self.example[c] for c in cut])
        product = np.repeat(weights, [c.stop - c.start for c in cut]) * np.concatenate([self.weight[c] for c in cut])
        if alive.sum() > 1 and not alive.all():
            held = alive[example // self.block]
            example, product = example[held], product[held]
        return np.bincount(example, weights=product, minlength=self.n)

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int, skip: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """(examples, cosines) of the k nearest, exactly; ties to the smaller
        number. Examples that share no term are not returned. The block of the
        largest upper bound is scored first; of the others only those whose bound
        reaches the k-th cosine found there."""
        ids, sims, kth = np.empty(0, dtype=np.int64), np.empty(0), 1e-12
        bound = weights @ self.top[terms]
        if not len(bound):
            return ids, sims
        best = np.zeros(len(bound), dtype=bool)
        best[bound.argmax()] = True
        for alive in (best, None):
            if alive is None:
                alive = ~best & (bound * (1 + 1e-9) >= kth)
                if not alive.any():
                    break
            acc = self._cosines(terms, weights, alive)
            near = np.flatnonzero(acc >= kth - 1e-11)
            near = near[near != skip]
            ids, sims = np.concatenate([ids, near]), np.concatenate([sims, np.round(acc[near], 12)])
            reach = sims >= kth
            ids, sims = ids[reach], sims[reach]
            if len(ids) > 4 * k:         # all of the k best, ties included, stay
                reach = sims >= np.partition(sims, len(sims) - k)[len(sims) - k]
                ids, sims = ids[reach], sims[reach]
            keep = np.lexsort((ids, -sims))[:k]
            ids, sims = ids[keep], sims[keep]
            if len(ids) == k:
                kth = max(kth, sims[-1])
        return ids, sims


@dataclass
class ToxicityModel:
    """All that a task needs to score a text; its size is bounded by the sample."""
    vocabulary: dict[str, int]
    idf: np.ndarray
    index: BlockMaxIndex
    example_ids: np.ndarray
    labels: np.ndarray
    prior: float
    k: int = 15
    slope: float = 1.0
    shift: float = 0.0
    key: str = ""

    def vector(self, counts: Counter) -> tuple[np.ndarray, np.ndarray]:
        t = np.fromiter(counts.keys(), dtype=np.int64, count=len(counts))
        w = (1.0 + np.log(np.fromiter(counts.values(), dtype=np.float64, count=len(counts)))) * self.idf[t]
        norm = np.sqrt((w * w).sum())
        return t, w / norm if norm else w

    def vote(self, counts: Counter, skip: int = -1) -> tuple[float, np.ndarray]:
        """Log odds of the distance-weighted votes, the prior voting at distance one."""
        if counts:
            t, w = self.vector(counts)
            ids, sims = self.index.search(t, w, self.k, skip)
        else:
            ids, sims = np.empty(0, dtype=np.int64), np.empty(0)
        by = 1.0 / (1.05 - np.minimum(sims, 1.0))
        yes = (by * self.labels[ids]).sum() + self.prior / 1.05
        no = (by * (1 - self.labels[ids])).sum() + (1 - self.prior) / 1.05
        return float(np.log(yes / no)), ids

    def score(self, text: str | None) -> tuple[float, list[int]]:
        odds, ids = self.vote(term_counts(text or "", _lookup(self.key, self.vocabulary)))
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * odds + self.shift, -30, 30))), self.example_ids[ids[:5]].tolist()


def _likelihood_ratio(a, b, n1, n0):
    """G2 of a term found in ``a`` of n1 positive and ``b`` of n0 negative rows."""
    def part(o, e):
        return np.where(o > 0, o * np.log(np.maximum(o, 1e-9) / e), 0.0)
    p = (a + b) / (n1 + n0)
    return 2 * (part(a, n1 * p) + part(b, n0 * p) + part(n1 - a, n1 * (1 - p) + 1e-9) + part(n0 - b, n0 * (1 - p) + 1e-9))


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 30) -> tuple[float, float]:
    """Slope and shift of a one-input logistic fit (Newton, lightly damped)."""
    a = np.stack([x, np.ones_like(x)], axis=1)
    w = np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        g = a.T @ (p - y) + 1e-2 * (w - [1.0, 0.0])
        h = (a * (p * (1 - p))[:, None]).T @ a + 1e-2 * np.eye(2)
        w = w - np.linalg.solve(h, g)
    return (float(w[0]), float(w[1])) if w[0] > 0 else (1.0, 0.0)


def fit(docs: DataFrame, labels: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", max_examples: int = MAX_EXAMPLES, k: int = 15, least_ratio: float = 20.0) -> ToxicityModel:
    """Fit on at most ``max_examples`` labelled rows that are not ``held_out`` (a
    condition on ``labels``); document frequencies come from all of ``docs``.
    Without labelled rows every text scores the prior, zero."""
    # at most ``max_examples`` rows of 12 bytes
    sample = F.broadcast(shared_table(labelled_sample(labels, label_col, held_out, max_examples), "tox-sample"))
    texts = shared_table(one_per_id(text_bytes(docs.where(F.col(id_col).isNotNull()), id_col, text_col)
                                    .join(sample, "doc_id"), "doc_id", "body"), "tox-texts")

    def presence(frames):
        for b in batches(frames):
            seen, cache = ({}, {}), {}
            for body, y in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                found = set()
                for c in set(body.decode("utf-8", "replace").split()):
                    if c not in cache:
                        cache[c] = word_terms(c)
                    found.update(cache[c])
                mine = seen[1 if y else 0]
                for t in found:
                    mine[t] = mine.get(t, 0) + 1
            for y in (0, 1):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(seen[y]), pa.string()), pa.array([y] * len(seen[y]), pa.int32()),
                     pa.array(list(seen[y].values()), pa.int64())], names=["term", "y", "n"])

    sizes = {r["y"]: r["n"] for r in texts.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = sizes.get(1, 0), sum(v for y, v in sizes.items() if y != 1)
    per_term = texts.mapInArrow(presence, "term string, y int, n long").groupBy("term") \
        .agg(F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("a"),
             F.sum(F.when(F.col("y") != 1, F.col("n")).otherwise(0)).alias("b")).where(F.col("a") + F.col("b") >= 4)
    # terms of a bounded sample
    stats = per_term.orderBy("term").toPandas()
    chosen = stats[_likelihood_ratio(stats["a"].to_numpy(float), stats["b"].to_numpy(float), n1, n0) >= least_ratio] \
        if n1 and n0 else stats[:0]
    vocabulary, key = {t: i for i, t in enumerate(chosen["term"])}, uuid.uuid4().hex

    def frequencies(frames):
        lookup, total = _lookup(key, vocabulary), np.zeros(len(vocabulary) + 1, dtype=np.int64)
        for b in batches(frames):
            for body in b.column(1).to_pylist():
                found = {t for ts in map(lookup.__getitem__, set(body.decode("utf-8", "replace").split())) for t in ts}
                total[list(found)] += 1
                total[-1] += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["term", "n"])

    df = np.zeros(len(vocabulary) + 1)
    for r in text_bytes(docs, id_col, text_col).mapInArrow(frequencies, "term long, n long") \
            .groupBy("term").agg(F.sum("n").alias("n")).collect():      # a row per chosen term
        df[r["term"]] = r["n"]
    idf = np.log((1 + df[-1]) / (1 + df[:-1])) + 1.0

    def counted(frames):
        lookup = _lookup(key, vocabulary)
        for b in batches(frames):
            rows = [term_counts(x.decode("utf-8", "replace"), lookup) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array([list(c) for c in rows], pa.list_(pa.int64())),
                 pa.array([list(c.values()) for c in rows], pa.list_(pa.int64()))], names=["doc_id", "y", "t", "n"])

    # bounded by the sample and its chosen terms
    examples = sorted(texts.mapInArrow(counted, "doc_id long, y int, t array<long>, n array<long>").collect())
    prior = n1 / max(1, n1 + n0)
    counts = [Counter(dict(zip(r["t"], r["n"]))) for r in examples]
    model = ToxicityModel(vocabulary, idf, BlockMaxIndex([], len(vocabulary)), np.array([r["doc_id"] for r in examples], dtype=np.int64),
                          np.array([int(r["y"] == 1) for r in examples], dtype=np.int64), min(max(prior, 1e-3), 1 - 1e-3), k, key=key)
    model.index = BlockMaxIndex([model.vector(c) for c in counts], len(vocabulary))
    if n1 and n0:
        def leave_one_out(frames):
            for b in frames:
                at = b.column(0).to_pylist()
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array([model.vote(counts[i], i)[0] for i in at])],
                                                 names=["i", "odds"])
        spark = docs.sparkSession
        votes = spark.range(0, len(examples), 1, 16).mapInArrow(leave_one_out, "i long, odds double").toPandas()
        model.slope, model.shift = _logistic(votes["odds"].to_numpy(), model.labels[votes["i"].to_numpy()].astype(float))
    return model


def score_column(model: ToxicityModel, text: Column, spark) -> Column:
    """struct<score double, evidence array<long>>: the calibrated score and the
    ids of the nearest labelled examples. Null and empty texts score too."""
    held = spark.sparkContext.broadcast(model)       # bounded by the labelled sample

    @F.pandas_udf("struct<score:double,evidence:array<bigint>>")
    def run(parts: pd.Series) -> pd.DataFrame:
        m = held.value
        return pd.DataFrame([m.score(t) for t in parts], columns=["score", "evidence"])
    return run.asNondeterministic()(text)       # one evaluation, also under a filter


def toxicity_scores(docs: DataFrame, labels: DataFrame, held_out: Column, id_col: str = "doc_id",
                    text_col: str = "text", score_col: str = "score", evidence_col: str = "evidence", **options) -> DataFrame:
    """``docs`` with ``score_col`` (0 to 1, higher: more likely toxic) and
    ``evidence_col``; columns of these names in the input are replaced. Labels
    are learnt only where ``held_out`` is false; the score of a text depends on
    the text alone. Repeated rows score alike, a text of any length is scored
    whole; of different texts of a labelled id that of the smallest hash is learnt
    from; an empty table gives no rows."""
    model = fit(docs, labels, held_out, id_col, text_col, **options)
    kept = [c for c in docs.columns if c not in (score_col, evidence_col)]
    both = "__scored"
    while both in kept:
        both += "_"
    scored = docs.select(*kept, score_column(model, F.col(text_col), docs.sparkSession).alias(both))
    return scored.select(*kept, F.col(f"{both}.score").alias(score_col), F.col(f"{both}.evidence").alias(evidence_col))

"""Quality classifier by Bradley-Terry pairwise ranking: documents labelled good
are preferred to documents labelled bad, and weights are learnt by logistic loss
on the feature differences of such pairs. The score of a document is compared
with the score quantile at the share of bad labels."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import shared_table
from .toxicity import labelled_rows

#: Preference pairs of the fit: of each labelled row at least, and in all where there are few rows.
PAIRS_EACH, LEAST_PAIRS = 4, 100_000
#: Labelled rows of a block, inside which rows are paired.
BLOCK_ROWS = 1024
_MARKS = b".,!?;:|%&$*#@+=~^_/\\-()[]{}<>\"'"


def features(text: str | None) -> np.ndarray:
    """Form of a whole text: sizes, repetition, case, marks. Empty text: zeros."""
    body = (text or "").encode("utf-8", "replace")
    words = body.split()
    if not words:
        return np.zeros(24 + len(_MARKS), dtype=np.float64)
    byte = np.bincount(np.frombuffer(body, dtype=np.uint8), minlength=256)
    n, size = len(words), len(body)
    seen = Counter(words)
    lines = [x for x in body.split(b"\n") if x.strip()]
    unique_lines = set(lines)
    upper, lower = byte[65:91].sum(), byte[97:123].sum()
    pairs = len(set(zip(words, words[1:])))
    triples = len(set(zip(words, words[1:], words[2:])))
    top = sorted(seen.values(), reverse=True)
    lengths = np.fromiter(map(len, seen), dtype=np.float64, count=len(seen))
    same = sum(a == b for a, b in zip(words, words[1:]))
    head = [np.log(size), np.log(n), (size - n) / n, lengths.std(), lengths.max() ** 0.5, len(seen) / n,
            len(seen) / np.sqrt(n), same / n, pairs / max(1, n - 1), triples / max(1, n - 2), top[0] / n, sum(top[:5]) / n,
            upper / max(1, upper + lower), upper / n, byte[48:58].sum() / size, byte[128:].sum() / size,
            np.log(len(lines)), 1 - len(unique_lines) / len(lines), 1 - sum(map(len, unique_lines)) / sum(map(len, lines)),
            np.log(n / len(lines)), byte[9] / size, byte[:9].sum() / size, float(n < 20), float(n < 5)]
    marks = byte[list(_MARKS)] / n
    return np.concatenate([head, np.log1p(10 * marks)])


def _expand(x: np.ndarray) -> np.ndarray:
    """Standardised features with their squares: bad texts lie at either end."""
    x = np.clip(x, -6, 6)
    return np.concatenate([x, x * x / 3], axis=1)


def _pair_sums(d: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(curvature, slope) of the logistic loss over feature differences ``d``."""
    p = 1 / (1 + np.exp(np.clip(d @ w, -30, 30)))
    return (d * (p * (1 - p))[:, None]).T @ d, d.T @ p


def _newton(sums, size: int, damp: float, rounds: int) -> np.ndarray:
    """Damped Newton steps; ``sums(w)`` gives curvature and slope over all pairs."""
    w = np.zeros(size)
    for _ in range(rounds):
        curvature, slope = sums(w)
        step = np.linalg.solve(curvature + damp * np.eye(size), slope - damp * w)
        w = w + step * min(1.0, 5 / max(1e-9, np.linalg.norm(step)))
        if np.linalg.norm(step) < 1e-6:
            break
    return w


def bradley_terry(x: np.ndarray, good: np.ndarray, bad: np.ndarray, damp: float = 1.0, rounds: int = 25) -> np.ndarray:
    """Weights that maximise the likelihood of each ``good[i]`` being preferred to
    ``bad[i]`` (rows of ``x``), by Newton steps on the damped logistic loss."""
    d = x[good] - x[bad]
    return _newton(lambda w: _pair_sums(d, w), x.shape[1], damp, rounds)


class QualityModel:
    """Scaling, weights, the threshold and the steepness of the score."""

    def __init__(self, mean, scale, weights, threshold: float, steep: float):
        self.mean, self.scale, self.weights, self.threshold, self.steep = mean, scale, weights, threshold, steep

    def raw(self, x: np.ndarray) -> np.ndarray:
        return _expand((x - self.mean) / self.scale) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.steep * (self.raw(x) - self.threshold), -30, 30)))


def _steady(values) -> np.ndarray:
    """To 9 digits: what is below is the order of the sums."""
    return np.array([float(f"{v:.9g}") for v in values])


def block_pairs(y: np.ndarray, each: int) -> tuple[np.ndarray, np.ndarray]:
    """(good, bad) places: every row of the commoner label meets ``each`` rows of
    the other in turn (all, if fewer), so that each row is in a pair."""
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y != 1)
    if not len(good) or not len(bad):
        return good[:0], bad[:0]
    many, few = max(len(good), len(bad)), min(len(good), len(bad))
    i, j = (v.ravel() for v in np.meshgrid(np.arange(many), np.arange(min(each, few)), indexing="ij"))
    turn = (i + j) % few
    return (good[i], bad[turn]) if many == len(good) else (good[turn], bad[i])


def labelled_features(docs: DataFrame, marked: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, y, x): the features of every labelled document. Texts are measured
    where they lie; only their features are dealt out to meet the labels."""
    @F.pandas_udf("array<double>")
    def measured(parts: pd.Series) -> pd.Series:
        return parts.map(features)
    body = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.where(F.col(id_col).isNotNull()) \
        .select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("h"), measured(body).alias("x"))
    # of different texts of one id that of the smallest hash
    return rows.join(marked, "doc_id").groupBy("doc_id").agg(F.min(F.struct("h", "y", "x")).alias("r")) \
        .select("doc_id", "r.y", "r.x")


def _fit_weights(rows: DataFrame, mean: np.ndarray, scale: np.ndarray, n_good: int, n_bad: int, least_pairs: int,
                 block_rows: int, damp: float = 10.0, rounds: int = 25) -> np.ndarray:
    """Bradley-Terry weights over all ``rows``: dealt to blocks by the hash of
    their ids, each row is paired in its block, and a Newton round adds up the
    blocks. Where the rarer label has few rows for the blocks, its rows go to
    as many blocks as it takes to have some 50 in each (all, if fewer)."""
    n, few = n_good + n_bad, min(n_good, n_bad)
    blocks = -(-n // block_rows)
    copies = min(blocks, max(1, -(-50 * blocks // few)))
    each = max(PAIRS_EACH, -(-least_pairs // max(n_good, n_bad)))
    at = F.xxhash64("doc_id", F.lit(7))
    rare = (F.col("y") == 1) if n_good <= n_bad else (F.col("y") != 1)
    spread = F.sequence(F.lit(0), F.when(rare, F.lit(copies - 1)).otherwise(F.lit(0)))
    dealt = rows.select("doc_id", "y", "x", F.explode(spread).alias("c")) \
        .select(F.pmod(at + F.col("c"), F.lit(blocks)).alias("block"), at.alias("at"), "doc_id", "y", "x")

    def gather(table: pa.Table) -> pa.Table:
        table = table.sort_by([("at", "ascending"), ("doc_id", "ascending")])
        x = table["x"].combine_chunks().flatten().to_numpy()
        return pa.table({"y": pa.array([table["y"].to_numpy().astype(np.int32).tobytes()], pa.binary()),
                         "x": pa.array([x.tobytes()], pa.binary())})
    packed = shared_table(dealt.groupBy("block").applyInArrow(gather, "y binary, x binary"), "quality-blocks").rdd
    size = 2 * len(mean)

    def sums(w: np.ndarray):
        def add(total, block):
            y = np.frombuffer(block["y"], dtype=np.int32)
            x = _expand((np.frombuffer(block["x"], dtype=np.float64).reshape(len(y), -1) - mean) / scale)
            good, bad = block_pairs(y, each)
            for i in range(0, len(good), 20_000):
                more = _pair_sums(x[good[i:i + 20_000]] - x[bad[i:i + 20_000]], w)
                total = total[0] + more[0], total[1] + more[1]
            return total
        zero = np.zeros((size, size)), np.zeros(size)
        return packed.treeAggregate(zero, add, lambda a, b: (a[0] + b[0], a[1] + b[1]))
    return _steady(_newton(sums, size, damp, rounds))


def _ranked(scores: DataFrame, places: list[int]) -> dict[int, float]:
    """The values at these places of the sorted one-column ``scores``."""
    wanted = set(places)
    return {i: v for v, i in scores.orderBy(scores.columns[0]).rdd.map(lambda r: r[0]).zipWithIndex()
            .filter(lambda p: p[1] in wanted).collect()}


def fit(docs: DataFrame, labels: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", least_pairs: int = LEAST_PAIRS, block_rows: int = BLOCK_ROWS) -> QualityModel:
    """Fit on all labelled rows that are not ``held_out``: scaling, weights and
    threshold are sums and exact ranks over every one of them. With one label
    missing every score is 0.5 or more of the label that is there."""
    marked = labelled_rows(labels, label_col, held_out)
    rows = shared_table(labelled_features(docs, marked, id_col, text_col), "quality-rows")
    n_features = 24 + len(_MARKS)
    st = rows.agg(F.count_if(F.col("y") == 1), F.count_if(F.col("y") != 1),
                  *[f(F.col("x")[i]) for f in (F.avg, F.stddev_pop) for i in range(n_features)]).first()
    n_good, n_bad = st[0], st[1]
    n = n_good + n_bad
    mean, scale = (_steady(st[2:2 + n_features]), _steady(st[2 + n_features:]) + 1e-9) if n \
        else (np.zeros(n_features), np.ones(n_features))
    if not n_good or not n_bad:
        return QualityModel(mean, scale, np.zeros(2 * n_features), -1.0 if n_good or not n else 1.0, 1.0)
    w = _fit_weights(rows, mean, scale, n_good, n_bad, least_pairs, block_rows)
    model = QualityModel(mean, scale, w, 0.0, 1.0)

    @F.pandas_udf("double")
    def raw(x: pd.Series) -> pd.Series:
        return pd.Series(model.raw(np.stack(x))) if len(x) else pd.Series([], dtype=float)
    # the quantile of the scores at the share of bad labels, between its two neighbours, and where the middle 80 % end
    ends = [q * (n - 1) / 10 for q in (1, 9)]
    below = [int(e) for e in ends]
    s = _ranked(rows.select(raw("x").alias("s")), [n_bad - 1, n_bad, *below, *[min(i + 1, n - 1) for i in below]])
    low, high = (s[i] + (e - i) * (s[min(i + 1, n - 1)] - s[i]) for i, e in zip(below, ends))
    return QualityModel(mean, scale, w, (s[n_bad - 1] + s[n_bad]) / 2, 8.0 / max(1e-6, high - low))


def quality_scores(docs: DataFrame, labels: DataFrame, held_out: Column, id_col: str = "doc_id",
                   text_col: str = "text", score_col: str = "score", **options) -> DataFrame:
    """``docs`` with ``score_col`` (0 to 1, higher: more likely good; a column of
    that name is replaced). Labels are learnt only where ``held_out`` is false;
    the score depends on the text alone. Null texts score as empty ones, repeated
    rows alike, a text of any length is measured whole; of different texts of a
    labelled id that of the smallest hash is learnt from; an empty table gives no
    rows."""
    model = fit(docs, labels, held_out, id_col, text_col, **options)

    @F.pandas_udf("double")
    def run(parts: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.stack([features(t) for t in parts]))) if len(parts) else pd.Series([], dtype=float)
    kept = [c for c in docs.columns if c != score_col]
    return docs.select(*kept, run(F.coalesce(F.col(text_col), F.lit(""))).alias(score_col))

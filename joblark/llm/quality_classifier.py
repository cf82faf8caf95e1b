"""Quality classifier: regularised quadratic discriminant on text statistics.

Each text gives a vector of transformed statistics (``FEATURES``). From the moments of
the labelled rows, which Spark sums over all of them, each class gets a mean and a covariance
that is shrunk towards the pooled one (``SHRINKAGE``) and widened by ``RIDGE``. The
score is the logistic of the difference of log densities, Mahalanobis terms through
Cholesky factors that are computed once and sent with the scoring function.

Null texts count as empty and get a score like any other. Rows without label or with a
null id are scored but not learned from; repeated rows count and come back as often as
they occur. Without rows of a class its prior and the pooled moments decide. Other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from joblark.llm import hashing, stats
from joblark.llm.repeats import with_names
from joblark.session import materialize

FEATURES = (
    "log words", "log letters a word", "symbols", "lines said before", "words in repeated windows",
    "capitals", "exclamations", "words equal to the one before", "digits", "log share of distinct words",
)
SIZE = len(FEATURES)
SHRINKAGE = 0.1
RIDGE = 0.15
PRIOR_ROWS = 1.0

_CAPITALS = bytes(range(0x41, 0x5B))
_DIGITS = bytes(range(0x30, 0x3A))


def features(texts: list[bytes]) -> np.ndarray:
    """One row of ``FEATURES`` a text."""
    h, first, last = hashing.word_elements(texts)
    words = last - first
    many = np.maximum(words, 1)
    same = np.r_[0, np.cumsum(np.r_[False, h[1:] == h[:-1]])] if len(h) else np.zeros(1, int)
    again = np.where(words > 1, same[last] - same[np.minimum(first + 1, last)], 0)
    size = np.array([len(t) for t in texts])
    count = lambda drop: size - np.array([stats.without(t, drop) for t in texts])
    letters = np.array([stats.without(t, stats.SPACE + stats._CONTINUED) for t in texts])
    distinct = np.array([len(np.unique(h[a:b])) for a, b in zip(first, last)])
    share = lambda n: np.log1p(20 * n / many)
    return np.stack(
        [
            np.log1p(words), np.log(np.maximum(letters / many, 0.5)), share(count(stats.SYMBOLS)),
            share(np.array([stats.duplicate_lines(t) for t in texts])), share(stats.repeated_elements(h, first, last, 8)),
            share(count(_CAPITALS) / 5), share(count(b"!?")), share(again), share(count(_DIGITS) / 5),
            np.log(np.maximum(distinct, 1) / many),
        ],
        axis=1,
    )


def described(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *keep: Column) -> DataFrame:
    """``(doc_id, x, *keep)`` a row, written once."""
    names = docs.select(*keep).columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [features([r[0] for r in part]) for part in hashing.chunks((t,) for t in batch.column("text").to_pylist())]
            x = np.concatenate(parts) if parts else np.zeros((0, SIZE))
            offsets = pa.array(np.arange(0, (len(x) + 1) * SIZE, SIZE, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.ListArray.from_arrays(offsets, pa.array(x.ravel())), *(batch.column(n) for n in names)], ["doc_id", "x", *names]
            )

    texts = stats.texts_of(docs, text_col, F.col(id_col).cast("long").alias("doc_id"), *keep)
    return materialize(texts.mapInArrow(run, with_names("doc_id long, x array<double>", docs.select(*keep))), "features")


@dataclass(frozen=True)
class Discriminant:
    """Two Gaussian classes: means, inverses of Cholesky factors, log constants with priors."""

    means: np.ndarray
    factors: np.ndarray
    constants: np.ndarray

    @staticmethod
    def fit(moments: dict[int, tuple[float, list[float], list[float]]], shrinkage: float = SHRINKAGE, ridge: float = RIDGE) -> Discriminant:
        n = np.array([moments[c][0] if c in moments else 0.0 for c in (0, 1)])
        found = {c: stats.mean_and_covariance(*moments[c]) for c in moments}
        total = max(n.sum(), 1.0)
        centre = sum((moments[c][0] * found[c][0] for c in found), np.zeros(SIZE)) / total
        pooled = sum((moments[c][0] * found[c][1] for c in found), np.zeros((SIZE, SIZE))) / total
        means, factors, constants = [], [], []
        for c in (0, 1):
            mean, own = found.get(c, (centre, pooled))
            weight = shrinkage + (1 - shrinkage) * SIZE / (SIZE + n[c])
            cov = (1 - weight) * own + weight * pooled + ridge**2 * np.eye(SIZE)
            lower = np.linalg.cholesky(cov)
            means.append(mean)
            factors.append(np.linalg.inv(lower))
            constants.append(np.log((n[c] + PRIOR_ROWS) / (total + 2 * PRIOR_ROWS)) - np.log(np.diag(lower)).sum())
        return Discriminant(np.array(means), np.array(factors), np.array(constants))

    def score(self, x: np.ndarray) -> np.ndarray:
        logs = [k - 0.5 * np.square((x - m) @ f.T).sum(axis=1) for m, f, k in zip(self.means, self.factors, self.constants)]
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))


def fit(rows: DataFrame, label: str) -> Discriminant:
    """From rows ``(x, label)``, label 0 or 1; others are left out."""
    groups = rows.where(F.col(label).isin(0, 1)).groupBy(F.col(label).cast("int").alias("label")).agg(*stats.moments(F.col("x"), SIZE)).collect()
    return Discriminant.fit({g.label: (g.n, g.sums, g.products) for g in groups})


def scored(rows: DataFrame, model: Discriminant) -> DataFrame:
    """``rows`` with their score in place of x."""
    names = [c for c in rows.columns if c != "x"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy().reshape(-1, SIZE)
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(model.score(x))], [*names, "score"])

    return rows.mapInArrow(run, with_names("", rows.select(*names)).removeprefix(", ") + ", score double")


def quality_scores(docs: DataFrame, labels: DataFrame, held_out: Column, *keep: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """``(doc_id, held_out, *keep, score)`` a row, learned from labelled rows that are not held out."""
    rows = described(docs, id_col, text_col, F.coalesce(held_out, F.lit(False)).alias("held_out"), *keep)
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    return scored(rows, fit(rows.where(~F.col("held_out")).select("doc_id", "x").join(known, "doc_id"), "label"))

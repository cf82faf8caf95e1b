"""Quality rules: base limits, then robust multivariate outliers a language and source.

The vector of a document: log of its words, letters a word, and symbols,
duplicate lines and repeated words, each on a log scale of its share. Per (lang,
source) a minimum-covariance-determinant estimate is sought from several starts: medians with
median deviations as scales, and with correlations of all standardised vectors under tanh or cut to length one, and
``RANDOM`` sets of ``SIZE + 1`` documents, those whose vectors have the least hash under as many seeds.
A concentration step keeps the ``support`` share of documents nearest in Mahalanobis distance and
takes their mean and covariance. The covariance is regularised by a target that stays the same for all steps, the corpus's
(``prior`` rows' worth), and no deviation counts as less than ``FLOOR``, so that statistics that hardly vary do
not reject by themselves. After ``trial`` steps the start of a group with the smallest determinant goes on until its determinant
no longer falls, at most ``steps`` steps in all; the estimate with the smallest determinant that was met counts. All documents
that pass the base take part; every step is one aggregation for the cuts and one for
the moments of all groups and starts. Beyond the ``level`` quantile of chi-square a document is rejected.

Null texts have no words and fail the base. Null lang or source is a group of its own. Repeated rows
come back as often as they occur and count as often. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from joblark.llm import hashing, stats
from joblark.session import counted, materialize

MIN_WORDS = 20
REPEAT_WINDOW = 8
MAX_REPEAT_PERCENT = 30

SUPPORT = 0.75
STEPS = 30
TRIAL = 2
RANDOM = 12
BROADCAST_ESTIMATES = 50_000  # some 20 MB; more are joined by their group
STARTS = ("scales", "tanh", "signs", *(f"random{i}" for i in range(RANDOM)))
FALL = 1e-3  # a fall of the log determinant by less ends the steps; cuts are exact to some 1e-4 of the ranks
PRIOR = 50.0
LEVEL = 0.9999
# Least deviation of each statistic: log words, log letters a word, then three log shares.
FLOOR = [0.3, 0.05, 0.15, 0.45, 0.45]
SIZE = len(FLOOR)

_STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", groups: tuple[str, str] = ("lang", "source")) -> DataFrame:
    """``(doc_id, g1, g2, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            repeats = [stats.repeated_words([r[0] for r in part], REPEAT_WINDOW) for part in hashing.chunks((t,) for t in texts)]
            columns = [
                [len(t.split()) for t in texts],
                [stats.without(t, stats.SPACE + stats._CONTINUED) for t in texts],
                [len(t) - stats.without(t, stats.SYMBOLS) for t in texts],
                [stats.duplicate_lines(t) for t in texts],
                np.concatenate(repeats) if repeats else [],
            ]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "g1", "g2")), *(pa.array(c, pa.int64()) for c in columns)],
                ["doc_id", "g1", "g2", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"],
            )

    texts = stats.texts_of(docs, text_col, F.col(id_col).cast("long").alias("doc_id"), *(F.col(g).cast("string").alias(n) for g, n in zip(groups, ("g1", "g2"))))
    return texts.mapInArrow(run, "doc_id long, g1 string, g2 string, " + _STATS)


def vector() -> Column:
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    share = lambda c: F.log1p(20 * F.col(c) / words)
    return F.array(F.log(words), F.log(F.greatest(F.col("word_chars") / words, F.lit(0.5))), share("n_symbols"), share("n_dup_lines"), share("n_repeat_words"))


def _distance(x: Column, mean: Column, inverse: Column) -> Column:
    """Squared Mahalanobis distance; ``inverse`` holds the matrix by rows."""
    d = [x[i] - mean[i] for i in range(SIZE)]
    total = F.lit(0.0)
    for i in range(SIZE):
        for j in range(SIZE):
            total = total + d[i] * d[j] * inverse[i * SIZE + j]
    return total


_ESTIMATE = "g1 string, g2 string, start string, mean array<double>, inverse array<double>, logdet double"
_STEP = "g1 string, g2 string, start string, last double, mean array<double>, inverse array<double>, logdet double, own_mean array<double>, own_inverse array<double>"


def _estimated(target: list[float], correct: float, prior: float, centre: list[float]) -> Callable:
    """Estimates from moments, and what becomes of them when the mean is drawn to ``centre``
    like the covariance to the target (``own_mean``, ``own_inverse``)."""
    goal, floor = np.array(target).reshape(SIZE, SIZE), np.diag(np.square(FLOOR))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                mean, cov = stats.mean_and_covariance(row["n"], row["sums"], row["products"])
                share = row["n"] / (row["n"] + prior)
                cov = share * cov * correct + (1 - share) * goal + floor
                off = mean - np.array(centre)
                drawn = cov + share * (1 - share) * np.outer(off, off)
                inverse, own = (np.linalg.inv(c).ravel().tolist() for c in (cov, drawn))
                out.append((mean.tolist(), inverse, float(np.linalg.slogdet(cov)[1]), (mean - (1 - share) * off).tolist(), own))
            kind = pa.list_(pa.float64())
            columns = zip(*out) if out else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("g1", "g2", "start", "last")), *(pa.array(c, k) for c, k in zip(columns, (kind, kind, pa.float64(), kind, kind)))],
                ["g1", "g2", "start", "last", "mean", "inverse", "logdet", "own_mean", "own_inverse"],
            )

    return run


def _with_group(rows: DataFrame, of_group: DataFrame, how: str = "left") -> DataFrame:
    """A join by language and source, whose nulls are a group."""
    right = of_group.withColumnsRenamed({"g1": "r1", "g2": "r2"})
    same = F.col("g1").eqNullSafe(F.col("r1")) & F.col("g2").eqNullSafe(F.col("r2"))
    return rows.join(right, same, how).drop("r1", "r2")


def _started(starts: tuple[str, ...]) -> Callable:
    """First estimates of every group: its medians, median deviations and correlations ``r_<start>``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                scale = np.sqrt(np.square(1.4826 * np.array(row["mad"])) + np.square(FLOOR))
                for start in starts:
                    shape = np.eye(SIZE)
                    if start.startswith("random"):
                        picked = np.array(row["picks"][int(start[6:]) * (SIZE + 1) :][: SIZE + 1])
                        inverse = np.linalg.inv(np.cov(picked.T) + np.diag(np.square(FLOOR)))
                        out.append((row["g1"], row["g2"], start, picked.mean(axis=0).tolist(), inverse.ravel().tolist(), float("inf")))
                        continue
                    if start != "scales":
                        _, cov = stats.mean_and_covariance(row["n"], row[f"{start}_sums"], row[f"{start}_products"])
                        size = np.sqrt(np.diag(cov)) + 1e-6
                        shape = cov / np.outer(size, size) * 0.99  # so that it has an inverse
                        np.fill_diagonal(shape, 1.0)
                    inverse = np.linalg.inv(shape * np.outer(scale, scale))
                    out.append((row["g1"], row["g2"], start, row["mean"], inverse.ravel().tolist(), float("inf")))
            kinds = [pa.string(), pa.string(), pa.string(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.float64()]
            columns = list(zip(*out)) if out else [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["g1", "g2", "start", "mean", "inverse", "logdet"])

    return run


def first_estimates(fit: DataFrame, starts: tuple[str, ...]) -> DataFrame:
    """``(g1, g2, start, mean, inverse, logdet)`` from medians, and moments that outliers cannot move far."""
    near = [F.percentile_approx(F.col("x")[i], 0.5, 1000).alias(f"m{i}") for i in range(SIZE)]
    centre = fit.groupBy("g1", "g2").agg(F.array(*near).alias("mean"))
    off = [F.col("x")[i] - F.col("mean")[i] for i in range(SIZE)]
    mad = F.array(*(F.percentile_approx(F.abs(d), 0.5, 1000) for d in off)).alias("mad")
    spread = materialize(_with_group(fit, centre).groupBy("g1", "g2").agg(F.first("mean").alias("mean"), mad), "spread")
    if starts == ("scales",):
        return spread.mapInArrow(_started(starts), _ESTIMATE)
    z = [d / F.sqrt(F.pow(1.4826 * F.col("mad")[i], 2) + FLOOR[i] ** 2) for i, d in enumerate(off)]
    length = F.sqrt(reduce(lambda a, b: a + b, (v * v for v in z)))
    forms = {"tanh": [F.tanh(v) for v in z], "signs": [F.when(length > 0, v / length).otherwise(0.0) for v in z]}
    moments = []
    for name, values in forms.items():
        n, sums, products = stats.moments(F.col(name), SIZE)
        moments += [sums.alias(f"{name}_sums"), products.alias(f"{name}_products")]
    shaped = _with_group(fit, spread).select("g1", "g2", "x", "mean", "mad", *(F.array(*v).alias(k) for k, v in forms.items()))
    picks = F.array(*(F.min_by("x", F.xxhash64(F.lit(j), F.col("x"))) for j in range(RANDOM * (SIZE + 1)))).alias("picks")
    found = shaped.groupBy("g1", "g2").agg(F.first("mean").alias("mean"), F.first("mad").alias("mad"), n, picks, *moments)
    return found.mapInArrow(_started(starts), _ESTIMATE)


def _concentrated(fit: DataFrame, now: DataFrame, support: float, small: bool) -> DataFrame:
    """Moments ``(g1, g2, start, last, n, sums, products)`` of the rows nearest to each estimate, whose log determinant is ``last``."""
    at = ["g1", "g2", "start", "last"]
    estimates = F.broadcast(now.withColumnRenamed("logdet", "last")) if small else now.withColumnRenamed("logdet", "last")
    measured = _with_group(fit, estimates, "inner").select(*at, "x", _distance(F.col("x"), F.col("mean"), F.col("inverse")).alias("d"))
    cut = measured.groupBy(*at).agg(F.percentile_approx("d", support, 10_000).alias("cut"))
    right = cut.withColumnsRenamed({c: f"_{c}" for c in at})
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in at))
    return measured.join(F.broadcast(right) if small else right, same).where("d <= cut").groupBy(*at).agg(*stats.moments(F.col("x"), SIZE))


def _pooled(groups: DataFrame) -> tuple[list[float], np.ndarray] | None:
    """Mean and covariance of all groups' moments together: one row reaches the driver."""
    pairs = SIZE * (SIZE + 1) // 2
    total = groups.agg(
        F.sum("n").alias("n"), *(F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(SIZE)),
        *(F.sum(F.col("products")[i]).alias(f"p{i}") for i in range(pairs)),
    ).first()
    if not total.n:
        return None
    mean, cov = stats.mean_and_covariance(total.n, [total[f"s{i}"] for i in range(SIZE)], [total[f"p{i}"] for i in range(pairs)])
    return mean.tolist(), cov


def _least(estimates: DataFrame) -> DataFrame:
    """Of each group's estimates, which are few, the one with the smallest determinant."""
    rest = F.struct(*(c for c in estimates.columns if c not in ("g1", "g2")))
    return estimates.groupBy("g1", "g2").agg(F.min_by(rest, F.struct("logdet", "step", "start")).alias("e")).select("g1", "g2", "e.*")


def minimum_covariance(fit: DataFrame, support: float = SUPPORT, steps: int = STEPS, prior: float = PRIOR, starts: tuple[str, ...] = STARTS, trial: int = TRIAL) -> DataFrame:
    """``(g1, g2, start, step, mean, inverse, logdet, own_mean, own_inverse)``: the estimate of the smallest determinant
    that was met in each group, and what becomes of it when groups of few rows are drawn to the corpus."""
    reach = stats.chi_square_quantile(support, SIZE)
    correct = support / stats.chi_square_cdf(reach, SIZE + 2)
    now, left = counted(first_estimates(fit, starts), "starts")
    seen, goal = [], None
    for step in range(1, steps + 1):
        moments = materialize(_concentrated(fit, now, support, left <= BROADCAST_ESTIMATES), "moments")
        if goal is None:
            goal = _pooled(moments.where(F.col("start") == starts[0]))
            if goal is None:
                break
        target = (goal[1] * correct).ravel().tolist()
        fresh = moments.mapInArrow(_estimated(target, correct, prior, goal[0]), _STEP).withColumn("step", F.lit(step))
        seen.append(materialize(fresh, "estimates"))
        now = seen[-1].where(F.col("logdet") < F.col("last") - FALL)
        if step == trial:  # the best start of a group goes on
            best = _least(reduce(DataFrame.unionByName, seen)).select("g1", "g2", F.col("start").alias("best"))
            now = _with_group(now, best, "inner").where(F.col("start") == F.col("best"))
        now, left = counted(now.select("g1", "g2", "start", "mean", "inverse", "logdet"), "falling")
        if not left:
            break
    if not seen:  # no rows
        return now.withColumns({"step": F.lit(0), "own_mean": F.col("mean"), "own_inverse": F.col("inverse")})
    return _least(reduce(DataFrame.unionByName, seen))


def outlier_distances(rows: DataFrame, support: float = SUPPORT, steps: int = STEPS, prior: float = PRIOR, starts: tuple[str, ...] = STARTS[:1]) -> DataFrame:
    """``rows`` (g1, g2, fit, x) with the squared robust distance of each x."""
    found = minimum_covariance(rows.where("fit"), support, steps, prior, starts)
    found = found.select("g1", "g2", F.col("own_mean").alias("mean"), F.col("own_inverse").alias("inverse"))
    return _with_group(rows, found).withColumn("distance", _distance(F.col("x"), F.col("mean"), F.col("inverse"))).drop("mean", "inverse")


def quality_rules(docs: DataFrame, level: float = LEVEL, id_col: str = "doc_id", text_col: str = "text", groups: tuple[str, str] = ("lang", "source")) -> DataFrame:
    """``(doc_id, g1, g2, n_words, ..., base_failed, x, distance, kept)`` a row."""
    found = statistics(docs, id_col, text_col, groups)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    rows = materialize(found.withColumns({"base_failed": failed, "fit": ~failed, "x": vector()}), "statistics")
    far = F.col("distance") > stats.chi_square_quantile(level, SIZE)
    return outlier_distances(rows, starts=STARTS).withColumn("kept", ~F.col("base_failed") & ~F.coalesce(far, F.lit(False))).drop("fit")

"""Quality rules and quality classifier."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from joblark.llm import quality_classifier as qc
from joblark.llm import quality_rules as qr
from joblark.llm import stats

DATA = "/root/testdata/sf0.01"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(text):
    text, words = text or "", words_of(text)
    grams = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often, hit = Counter(grams), set()
    for i, g in enumerate(grams):
        if often[g] > 1:
            hit.update(range(i, i + 8))
    lines = [x for x in text.split("\n") if words_of(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit))


ODD = [None, "", " \n\t\x0b\x0c\r ", "a\n\na\n a\na", "#*$%&|<>", "é日 é日\x00\x1f x", "a " * 500, "x" * 50_000, "\n" * 100]


def test_base_statistics(spark):
    rng = random.Random(1)
    texts = ODD + ["".join(rng.choice(["a", "b", " ", "é", "\n", "#", " a b"]) for _ in range(rng.randint(0, 300))) for _ in range(150)]
    rows = [(i, t, None if i % 7 == 0 else f"l{i % 3}", f"s{i % 2}") for i, t in enumerate(texts)] + [(None, "a b", "l1", "s1"), (5, texts[5], "l0", "s0")]
    df = spark.createDataFrame([(*r, 1, True) for r in rows], "doc_id long, text string, lang string, source string, g1 int, kept boolean").repartition(3)
    got = qr.quality_rules(df).collect()
    assert len(got) == len(rows)
    of = {r[0]: r[1] for r in rows}
    for r in got:
        want = brute(of[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert r.kept in (True, False) and not (r.base_failed and r.kept)
    assert qr.quality_rules(df.limit(0)).count() == 0


def test_outliers_do_not_move_the_estimate(spark):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(400):
        x = rng.normal(size=5) * [0.5, 0.1, 0.2, 0.2, 0.2] + [5, 1.5, 0, 0, 0]
        bad = i % 5 == 0
        rows.append(("a", None if i % 2 else "s", True, (x + [0, 0, 6, 0, 0] if bad else x).tolist(), bad))
    df = spark.createDataFrame(rows, "g1 string, g2 string, fit boolean, x array<double>, bad boolean")
    cut = stats.chi_square_quantile(qr.LEVEL, 5)
    got = qr.outlier_distances(df).collect()
    assert all((r.distance > cut) == r.bad for r in got)


def test_one_step_against_numpy(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 5)) * [1, 0.2, 0.5, 1, 1]
    df = spark.createDataFrame([("a", "b", True, v.tolist()) for v in x], "g1 string, g2 string, fit boolean, x array<double>")
    got = np.array(sorted(r.distance for r in qr.outlier_distances(df, steps=1).collect()))
    lower = lambda v: np.sort(v, axis=0)[int(np.ceil(len(v) / 2)) - 1]
    centre = lower(x)
    scale = (1.4826 * lower(np.abs(x - centre))) ** 2 + np.square(qr.FLOOR)
    d = ((x - centre) ** 2 / scale).sum(axis=1)
    kept = x[np.argsort(d)[: int(np.ceil(0.75 * len(x)))]]
    correct = 0.75 / stats.chi_square_cdf(stats.chi_square_quantile(0.75, 5), 7)
    cov = np.cov(kept.T, bias=True) * correct + np.diag(np.square(qr.FLOOR))
    diff = x - kept.mean(axis=0)
    assert got == pytest.approx(np.sort(np.einsum("ij,jk,ik->i", diff, np.linalg.inv(cov), diff)), rel=1e-6)


def concentrated(x, mean, inverse, prior, steps=30):
    """Steps on one group, whose own first covariance is the target: log determinants and estimates."""
    correct, goal, out, last = 0.75 / stats.chi_square_cdf(stats.chi_square_quantile(0.75, 5), 7), None, [], np.inf
    for _ in range(steps):
        d = np.einsum("ij,jk,ik->i", x - mean, inverse, x - mean)
        kept = x[d <= np.sort(d)[int(np.ceil(0.75 * len(x))) - 1]]
        mean, cov = kept.mean(axis=0), np.cov(kept.T, bias=True) * correct
        goal = cov if goal is None else goal
        share = len(kept) / (len(kept) + prior)
        whole = share * cov + (1 - share) * goal + np.diag(np.square(qr.FLOOR))
        inverse, logdet = np.linalg.inv(whole), np.linalg.slogdet(whole)[1]
        out.append((logdet, mean, inverse))
        if logdet >= last - qr.FALL:
            break
        last = logdet
    return min(out, key=lambda o: o[0])


def crooked(seed, n=300, share=0.2):
    """Correlated rows, of which some lie together where each value alone is not far off."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 5)) @ (np.eye(5) + 0.9 * np.tri(5, k=-1))
    bad = int(n * share)
    x[:bad] = rng.normal(size=(bad, 5)) * 0.2 + [2.0, -2.0, 2.0, -2.0, 2.0]
    return x, np.arange(n) < bad


def group_rows(x, g1, g2="s"):
    return [(g1, g2, True, v.tolist()) for v in x]


SCHEMA = "g1 string, g2 string, fit boolean, x array<double>"


def test_steps_go_on_until_the_determinant_no_longer_falls(spark):
    x, _ = crooked(5)
    df = spark.createDataFrame(group_rows(x, "a"), SCHEMA)
    first = qr.first_estimates(df, ("scales",)).first()
    want = concentrated(x, np.array(first["mean"]), np.array(first["inverse"]).reshape(5, 5), qr.PRIOR)
    got = qr.minimum_covariance(df, starts=("scales",)).first()
    assert got["step"] > 1 and got["logdet"] == pytest.approx(want[0], rel=1e-6)
    assert got["mean"] == pytest.approx(want[1]) and got["inverse"] == pytest.approx(want[2].ravel(), rel=1e-5)


def test_starts_against_numpy(spark):
    x, _ = crooked(6, 200)
    got = {r["start"]: r for r in qr.first_estimates(spark.createDataFrame(group_rows(x, None, None), SCHEMA), qr.STARTS).collect()}
    lower = lambda v: np.sort(v, axis=0)[int(np.ceil(len(v) / 2)) - 1]
    centre = lower(x)
    scale = np.sqrt((1.4826 * lower(np.abs(x - centre))) ** 2 + np.square(qr.FLOOR))
    z = (x - centre) / scale
    for name, v in (("tanh", np.tanh(z)), ("signs", z / np.linalg.norm(z, axis=1, keepdims=True))):
        shape = np.corrcoef(v.T) * 0.99
        np.fill_diagonal(shape, 1.0)
        assert got[name]["mean"] == pytest.approx(centre)
        assert np.linalg.inv(np.array(got[name]["inverse"]).reshape(5, 5)) == pytest.approx(shape * np.outer(scale, scale), rel=1e-3, abs=1e-3)


def test_the_smallest_determinant_of_all_starts_counts(spark):
    groups = {"a": crooked(7), "b": crooked(8, 200, 0.1), "c": (np.ones((3, 5)), None), "d": (np.zeros((1, 5)), None)}
    df = spark.createDataFrame([r for g, (x, _) in groups.items() for r in group_rows(x, g, None if g == "b" else "s")], SCHEMA)
    got = {r["g1"]: r for r in qr.minimum_covariance(df, prior=5.0).collect()}
    alone = {r["g1"]: r for r in qr.minimum_covariance(df, prior=5.0, starts=("scales",)).collect()}
    assert set(got) == set(alone) == set(groups)
    assert all(got[g]["logdet"] <= alone[g]["logdet"] + qr.FALL for g in groups)
    assert got["a"]["logdet"] < alone["a"]["logdet"] - 0.1  # the medians alone lead to a worse one
    cut = stats.chi_square_quantile(0.99, 5)
    rows = qr.outlier_distances(df, prior=5.0, starts=qr.STARTS).where("g1 in ('a', 'b')").collect()
    assert len(rows) == 500
    far = {(r["g1"], tuple(r["x"])) for r in rows if r["distance"] > cut}
    planted = {(g, tuple(v)) for g in "ab" for v, bad in zip(*groups[g]) if bad}
    assert planted <= far and len(far - planted) < 30


def test_no_rows_to_fit(spark):
    df = spark.createDataFrame([("a", "s", False, [1.0] * 5)], SCHEMA)
    assert [r["distance"] for r in qr.outlier_distances(df, starts=qr.STARTS).collect()] == [None]
    assert qr.minimum_covariance(df.where("fit")).count() == 0


def test_chi_square():
    assert stats.chi_square_quantile(0.95, 2) == pytest.approx(5.991464547)
    assert stats.chi_square_quantile(0.99, 5) == pytest.approx(15.08627247)


def test_rules_on_labelled_documents(spark):
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    kept = {r.quality: r.share for r in qr.quality_rules(docs).join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert kept[1] > 0.95 and kept[0] < 0.2


def test_discriminant_against_densities():
    rng = np.random.default_rng(4)
    data = {0: rng.normal(size=(400, qc.SIZE)) * 2 + 1, 1: rng.normal(size=(900, qc.SIZE))}
    upper = np.triu_indices(qc.SIZE)
    moments = {c: (float(len(x)), x.sum(axis=0).tolist(), (x.T @ x)[upper].tolist()) for c, x in data.items()}
    model = qc.Discriminant.fit(moments, shrinkage=0.0, ridge=0.0)
    x = np.concatenate([data[0][:20], data[1][:20]])
    logs, pooled = [], sum(len(d) * np.cov(d.T, bias=True) for d in data.values()) / 1300
    for c, d in data.items():
        w = qc.SIZE / (qc.SIZE + len(d))
        cov = (1 - w) * np.cov(d.T, bias=True) + w * pooled
        diff = x - d.mean(axis=0)
        logs.append(np.log((len(d) + 1) / 1302) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * np.einsum("ij,jk,ik->i", diff, np.linalg.inv(cov), diff))
    assert model.score(x) == pytest.approx(1 / (1 + np.exp(logs[0] - logs[1])))


def test_features_of_odd_texts():
    x = qc.features([(t or "").encode() for t in ODD])
    assert x.shape == (len(ODD), qc.SIZE) and np.isfinite(x).all()
    assert np.array_equal(x, np.concatenate([qc.features([(t or "").encode()]) for t in ODD]))


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    rows = qc.quality_scores(docs, labels, held).join(labels, "doc_id").where("held_out").collect()
    assert sum((r.score >= 0.3) == r.quality for r in rows) / len(rows) > 0.95


@pytest.mark.parametrize("labels", [[], [(1, 1)], [(1, 0), (2, None), (None, 1)]])
def test_scores_without_enough_labels(spark, labels):
    rows = [(1, "a b c", "x"), (2, None, "x"), (2, "", "x"), (None, "z", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, x string")
    known = spark.createDataFrame(labels, "doc_id long, quality int")
    got = qc.quality_scores(df, known, F.col("doc_id") == 9).collect()
    assert len(got) == 4 and all(0 <= r.score <= 1 and r.held_out is False for r in got)
    assert qc.quality_scores(df.limit(0), known, F.lit(False)).count() == 0

"""Statistics of whole texts, and moments of vectors kept in array columns."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from joblark.llm import hashing
from joblark.llm.hashing import U

SPACE = b" \t\n\r\x0b\x0c"
SYMBOLS = b"#*$%&|<>"
_CONTINUED = bytes(range(0x80, 0xC0))


def without(text: bytes, drop: bytes) -> int:
    return len(text.translate(None, drop))


def repeated_words(texts: list[bytes], window: int) -> np.ndarray:
    """Words inside windows that occur twice or more in their text, first included."""
    return repeated_elements(*hashing.word_elements(texts), window)


def repeated_elements(h: np.ndarray, first: np.ndarray, last: np.ndarray, window: int) -> np.ndarray:
    grams = hashing.run_hashes(h, window)
    n = np.maximum(last - first - window + 1, 0)
    if not n.sum():
        return np.zeros(len(first), np.int64)
    owner = np.repeat(np.arange(len(first)), n)
    at = np.repeat(first, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    keys = hashing.mix(grams[at] + owner.astype(U) * hashing._ODD[0])
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    again = at[order[np.r_[False, same] | np.r_[same, False]]]
    edge = np.zeros(len(h) + 1, np.int32)
    np.add.at(edge, again, 1)
    np.subtract.at(edge, again + window, 1)
    inside = np.r_[0, np.cumsum(np.cumsum(edge[:-1]) > 0)]
    return inside[last] - inside[first]


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return len(lines) - len(set(lines))


def moments(vector: Column, size: int) -> list[Column]:
    """Count, sums and sums of products of an array column, as aggregates."""
    sums = [F.sum(vector[i]) for i in range(size)]
    products = [F.sum(vector[i] * vector[j]) for i in range(size) for j in range(i, size)]
    return [F.count(F.lit(1)).cast("double").alias("n"), F.array(*sums).alias("sums"), F.array(*products).alias("products")]


def mean_and_covariance(n: float, sums: list[float], products: list[float]) -> tuple[np.ndarray, np.ndarray]:
    size = len(sums)
    mean = np.array(sums, float) / max(n, 1)
    square = np.zeros((size, size))
    square[np.triu_indices(size)] = np.array(products, float) / max(n, 1)
    square = square + np.triu(square, 1).T
    return mean, square - np.outer(mean, mean)


def chi_square_cdf(x: float, degrees: float) -> float:
    """By the series of the lower incomplete gamma function."""
    if x <= 0:
        return 0.0
    a, half = degrees / 2, x / 2
    term = total = 1 / a
    k = a
    while term > total * 1e-15:
        k += 1
        term *= half / k
        total += term
    return min(1.0, total * math.exp(a * math.log(half) - half - math.lgamma(a)))


def chi_square_quantile(p: float, degrees: float) -> float:
    low, high = 0.0, degrees + 1
    while chi_square_cdf(high, degrees) < p:
        high *= 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square_cdf(middle, degrees) < p else (low, middle)
    return high


def texts_of(docs: DataFrame, text_col: str, *columns: Column) -> DataFrame:
    """The given columns and ``text`` as bytes, null as empty."""
    return docs.select(*columns, F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))

"""Language ID: error-correcting output codes over byte n-gram classifiers.

Every language gets a codeword of +1/-1 bits: all distinct splits up to
``EXHAUSTIVE`` languages, beyond that random words far from each other. A bit's classifier is
linear in hashed letter trigrams of the folded text: the log ratio of their
smoothed frequencies in the languages on either side. Frequencies are counted by
Spark over all labelled texts and stay rows a language and trigram, of which there may be any number: weights are
summed where a trigram's rows meet, margins where a language's do. The driver gets the model alone, a row of
bits a trigram (``BUCKETS`` of them) and one a language; a language has some 6 log2 bits. The mean margin of a text is decoded by
its exponential loss against each codeword, every bit weighted by how well it
sets that language apart. ``score`` is the winner's share of the weights of all
languages, ``ambiguous`` says that it is under ``AMBIGUOUS``.

A null text or one without a letter is ``und`` with score 0, and so is everything if nothing could be
learned. Rows with null lang or text are not learned from. Repeated rows count and come back as
often as they occur. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from joblark.llm import hashing
from joblark.session import materialize

UNDETERMINED = "und"
BUCKETS = 1 << 16
HELD_LANGUAGES = 200  # counters a task holds before it hands them on
PAIRS = 1 << 20  # texts by languages that are decoded at once
CODE_PAIRS = 2_000_000
EXHAUSTIVE = 5
SMOOTHING = 0.5
SHARPNESS = 6.0
AMBIGUOUS = 0.7

_LETTER = regex.compile(r"\p{L}")
_FOLD = np.array([b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)], np.uint8)


def trigrams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of letter trigrams (not of three blanks), and each text's first and past-last one."""
    lens = np.array([len(t) + 2 for t in texts], np.int64)
    buf = _FOLD[np.frombuffer(b"".join(b" " + t + b" " for t in texts), np.uint8)]
    # capitals of the Latin-1 letters, whose second byte in UTF-8 is 0x80 to 0x9E
    second = np.r_[False, buf[:-1] == 0xC3] & (buf >= 0x80) & (buf <= 0x9E) & (buf != 0x97)
    buf = (buf | second.astype(np.uint8) << 5).astype(np.uint32)
    code = buf[:-2] << 16 | buf[1:-1] << 8 | buf[2:]
    ends = np.cumsum(lens)
    use = code != 0x202020
    inner = ends[:-1]
    for at in (inner - 1, inner - 2):  # not across texts
        use[at[(at >= 0) & (at < len(use))]] = False
    before = np.r_[0, np.cumsum(use)]
    code = (code[use] * np.uint32(2654435761)) >> np.uint32(16)
    edge = lambda x: before[np.clip(x, 0, len(use))]
    return code, edge(ends - lens), edge(ends)


def codewords(languages: int) -> np.ndarray:
    """Languages by bits of +1 and -1; every bit has both."""
    if languages <= EXHAUSTIVE:
        bits = [[1 if not i or n >> (i - 1) & 1 else -1 for i in range(languages)] for n in range(2 ** max(0, languages - 1) - 1)]
        return np.array(bits, float).reshape(len(bits), languages).T
    rng = np.random.default_rng(languages)
    size = 6 * int(np.ceil(np.log2(languages)))
    best, apart = None, -1.0
    tries = min(50, CODE_PAIRS // languages**2)  # many languages lie far apart in any draw
    for _ in range(max(1, tries)):
        words = rng.choice([-1.0, 1.0], (languages, size))
        words[0] = np.where(np.abs(words.sum(axis=0)) == languages, -words[0], words[0])
        nearest = (size - (words @ words.T - 2 * size * np.eye(languages))).min() if tries > 1 else 0.0
        if nearest > apart:
            best, apart = words, nearest
    return best


@dataclass(frozen=True)
class Decoder:
    languages: list[str]
    words: np.ndarray
    weights: np.ndarray
    trust: np.ndarray
    scale: np.ndarray

    @staticmethod
    def of(languages: list[str], words: np.ndarray, weights: np.ndarray, means: np.ndarray) -> Decoder:
        """``means`` holds the mean of a language's own texts at every bit."""
        margins = words * means
        scale = np.abs(margins).mean(axis=0) + 1e-9 if margins.size else np.zeros(margins.shape[1])
        trust = np.clip(margins / scale, 0.05, None)
        return Decoder(languages, words, weights, trust / np.maximum(trust.sum(axis=1, keepdims=True), 1e-9), scale)

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The index of the language with the least loss, and its share."""
        if len(self.languages) < 2:
            return np.zeros(len(margins), int), np.ones(len(margins))
        step = max(1, PAIRS // len(self.languages))
        parts = [self._decoded(margins[i : i + step]) for i in range(0, max(1, len(margins)), step)]
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    def _decoded(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        m = np.clip(margins / self.scale, -4, 4)
        up = self.words > 0  # the loss of a bit is exp(-m) where the word has +1, exp(m) elsewhere
        loss = np.exp(-m) @ (self.trust * up).T + np.exp(m) @ (self.trust * ~up).T
        shares = np.exp(-SHARPNESS * (loss - loss.min(axis=1, keepdims=True)))
        shares /= shares.sum(axis=1, keepdims=True)
        best = loss.argmin(axis=1)
        return best, shares[np.arange(len(best)), best]

    def predict(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        code, first, last = trigrams(texts)
        bits = self.words.shape[1]
        margins = np.zeros((len(texts), bits))
        full = last > first
        if full.any() and bits:
            sums = np.add.reduceat(self.weights[code], first[full], axis=0, dtype=np.float64)
            margins[full] = sums / (last - first)[full, None]
        return self.decode(margins)


def counted(docs: DataFrame) -> DataFrame:
    """``(lang, bucket, n)`` over rows (lang, text); each task adds up its own first."""

    def handed_on(held: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for k, row in held.items():
            at = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays([pa.array([k] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(row[at])], ["lang", "bucket", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            rows = zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist())
            for part in hashing.chunks(rows):
                code, first, last = trigrams([r[1] for r in part])
                names = sorted({r[0] for r in part})
                number = {k: i for i, k in enumerate(names)}
                owner = np.repeat([number[r[0]] for r in part], last - first)
                for low in range(0, len(names), HELD_LANGUAGES):
                    some = names[low : low + HELD_LANGUAGES]
                    own = (owner >= low) & (owner < low + len(some))
                    sums = np.bincount((owner[own] - low) * BUCKETS + code[own], minlength=len(some) * BUCKETS).reshape(len(some), BUCKETS)
                    for k, row in zip(some, sums):
                        held[k] = held[k] + row if k in held else row.copy()
                    if len(held) > HELD_LANGUAGES:
                        yield from handed_on(held)
                        held = {}
        yield from handed_on(held)

    return docs.mapInArrow(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def _weights(counts: DataFrame, number: dict[str, int], total: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Trigrams by bits: the log ratio of the mean smoothed frequencies on either side."""
    up = words > 0
    sides = np.maximum(np.array([up.sum(axis=0), (~up).sum(axis=0)]), 1)
    least = np.array([(SMOOTHING / total) @ up, (SMOOTHING / total) @ ~up])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            at = np.array([number[k] for k in batch.column("lang").to_pylist()], np.int64)
            share = batch.column("n").to_numpy() / total[at]
            for bucket, i, x in zip(batch.column("bucket").to_pylist(), at.tolist(), share.tolist()):
                held = sums.setdefault(bucket, np.zeros((2, words.shape[1])))
                held += np.where(np.array([up[i], ~up[i]]), x, 0.0)
        logs = [np.log((held + least) / sides) for held in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(sums, pa.int32()), pa.array([(x[0] - x[1]).tolist() for x in logs], pa.list_(pa.float64()))], ["bucket", "weights"])

    met = counts.repartition("bucket").sortWithinPartitions("bucket", "lang")
    found = met.mapInArrow(run, "bucket int, weights array<double>").toArrow()
    high, low = np.log(least / sides)  # of trigrams that were not seen
    weights = np.tile((high - low).astype(np.float32), (BUCKETS, 1))
    if found.num_rows:
        weights[found.column("bucket").to_numpy()] = np.array(found.column("weights").to_pylist(), np.float32)
    return weights


def _means(counts: DataFrame, number: dict[str, int], total: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Languages by bits: the weight that a language's trigrams have on average."""
    shared = counts.sparkSession.sparkContext.broadcast(weights)  # BUCKETS rows, whatever the corpus
    least = SMOOTHING * weights.sum(axis=0, dtype=np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist())
            n, rows = batch.column("n").to_numpy()[:, None], shared.value[batch.column("bucket").to_numpy()]
            edges = np.r_[0, np.flatnonzero(langs[1:] != langs[:-1]) + 1, len(langs)] if len(langs) else [0]
            for first, last in zip(edges[:-1], edges[1:]):
                part = (n[first:last] * rows[first:last]).sum(axis=0, dtype=np.float64)
                sums[str(langs[first])] = sums.get(str(langs[first]), 0.0) + part
        means = [((held + least) / total[number[k]]).tolist() for k, held in sums.items()]
        yield pa.RecordBatch.from_arrays([pa.array(sums, pa.string()), pa.array(means, pa.list_(pa.float64()))], ["lang", "mean"])

    found = counts.repartition("lang").sortWithinPartitions("lang", "bucket").mapInArrow(run, "lang string, mean array<double>").toArrow()
    means = np.tile(least, (len(total), 1)) / total[:, None]
    for k, mean in zip(found.column("lang").to_pylist(), found.column("mean").to_pylist()):
        means[number[k]] = mean
    return means


def fit(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> Decoder:
    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    pairs = known.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").cast("binary").alias("text"))
    counts = materialize(counted(pairs), "trigrams")
    totals = sorted(tuple(r) for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect())  # a row a language
    names = [k for k, _ in totals]
    number, words = {k: i for i, k in enumerate(names)}, codewords(len(names))
    total = np.array([n for _, n in totals], float) + SMOOTHING * BUCKETS
    if len(names) < 2:
        return Decoder.of(names, words, np.zeros((BUCKETS, words.shape[1]), np.float32), np.zeros(words.shape))
    weights = _weights(counts, number, total, words)
    return Decoder.of(names, words, weights, _means(counts, number, total, weights))


def languages(docs: DataFrame, model: Decoder, *keep: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, *keep, lang_pred, score, ambiguous)`` a row."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), *keep, F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    names = texts.columns[:-1]
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in texts.select(*names).schema)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = batch.column("_text").to_pylist()
            best, share = [], []
            for part in hashing.chunks((t.encode(),) for t in texts):
                b, s = model.predict([r[0] for r in part])
                best += b.tolist()
                share += s.tolist()
            known = [bool(model.languages) and _LETTER.search(t) is not None for t in texts]
            score = [s if k else 0.0 for s, k in zip(share, known)]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(n) for n in names),
                    pa.array([model.languages[b] if k else UNDETERMINED for b, k in zip(best, known)], pa.string()),
                    pa.array(score, pa.float64()), pa.array([s < AMBIGUOUS for s in score], pa.bool_()),
                ],
                [*names, "lang_pred", "score", "ambiguous"],
            )

    return texts.mapInArrow(run, f"{kinds}, lang_pred string, score double, ambiguous boolean")

"""Toxicity: Levenshtein automata intersected with a lexicon trie, scored in context.

Learning, from at most ``FIT_ROWS`` labelled texts of each label (those whose id hashes
lowest): a term is a word, or a stem (``prefix*``), that toxic texts hold in at least
``MIN_CONTEXTS`` different neighbourhoods and clean texts hardly ever. Counting
neighbourhoods and not texts keeps the words of a text with many copies out. Terms come from
two thirds of the sample. On the last third a logistic regression learns what matches are worth: the
log odds of exact terms, stems, misspellings by number of edits, quoted matches, and how
dense they are; its intercept is moved to the labels' true ratio.

Scoring: words that are no term and under no stem are run against the trie of the strong terms. The
automaton accepts up to ``edits(len(term))`` insertions, deletions or substitutions; its
states run down the trie, so that terms share the work. A word that holds none of the pieces one
of which such edits must leave whole is passed over. Words that several clean texts of the
sample hold are never misspellings. Quotation marks among the ``CONTEXT`` words on either
side of a match make it a quotation.

Null and empty texts have no match. Null ids are not learned from but scored. Repeated rows come
back as often as they occur. Without labelled rows of both kinds there are no terms and
every text scores the prior. Other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from joblark.session import materialize

FIT_ROWS = 10_000
MIN_CONTEXTS = 5
MIN_ODDS = 3.0
STEM_SIZES = (4, 5, 6)
STEM_WORDS = 8
STEM_CONTEXTS = 30
STEM_ODDS = 3.0
# Terms that misspellings are looked for: not under a stem, seen often.
STRONG_ODDS = 4.0
STRONG_CONTEXTS = 15
MAX_TERMS = 5_000
CONTEXT = 6
CACHE = 300_000
# Terms a task adds up before it hands them on.
HELD = 300_000
RIDGE = 1.0

_WORD = re.compile(r"[^\W_]+")
_QUOTE = re.compile(r"[\"\u201c\u201d\u201e\u00ab\u00bb\u2039\u203a]")


def edits(size: int) -> int:
    """Edits that a term of so many letters allows."""
    return 0 if size < 5 else 1 if size < 9 else 2


class Trie:
    """Strong terms by letters; ``matches`` intersects it with a word's Levenshtein automaton."""

    def __init__(self, words: Iterable[str]):
        self.root: dict = {}
        self.deepest = 0
        # pieces of terms, one of which the allowed edits leave whole: where it may begin
        # (from the start, or for the last piece from the end of the word)
        self.pieces: list[tuple[bool, int, range, set[str]]] = []
        held: dict[tuple[bool, int, int, int], set[str]] = {}
        for word in words:
            k = edits(len(word))
            if not k:
                continue
            node = self.root
            for letter in word:
                node = node.setdefault(letter, {})
            node[""] = word
            self.deepest = max(self.deepest, k)
            cuts = [i * len(word) // (k + 1) for i in range(k + 2)]
            for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
                last, shift = i == k, 0 if k == 1 else k
                at = len(word) - b if last else a
                held.setdefault((last, b - a, max(0, at - shift), at + shift), set()).add(word[a:b])
        for (last, size, low, high), found in sorted(held.items()):
            self.pieces.append((last, size, range(low, high + 1), found))

    def may_match(self, word: str) -> bool:
        """False only if no term is within its edits."""
        for last, size, places, found in self.pieces:
            for at in places:
                if (word[len(word) - size - at : len(word) - at] if last else word[at : at + size]) in found:
                    return True
        return False

    def matches(self, word: str) -> list[tuple[str, int]]:
        """Terms within their allowed edits, with the number of edits.

        Bit i of state j: i letters of the word are read with up to j edits.
        """
        places: dict[str, int] = {}
        for i, letter in enumerate(word):
            places[letter] = places.get(letter, 0) | 1 << i
        full, end = (2 << len(word)) - 1, 1 << len(word)
        found, stack = [], [(self.root, [(2 << j) - 1 & full for j in range(self.deepest + 1)])]
        while stack:
            node, states = stack.pop()
            for letter, child in node.items():
                if not letter:
                    near = next((j for j, s in enumerate(states[: edits(len(child)) + 1]) if s & end), None)
                    if near is not None:
                        found.append((child, near))
                    continue
                here = places.get(letter, 0)
                now = [(states[0] & here) << 1]
                for j in range(1, len(states)):
                    # the same letter; another one; a letter of the term left out; one of the word too many
                    now.append(((states[j] & here) << 1 | states[j - 1] << 1 | states[j - 1] | now[j - 1] << 1) & full)
                if now[-1]:
                    stack.append((child, now))
        return sorted(found, key=lambda m: (m[1], m[0]))


KINDS = ("exact", "stem", "edit1", "edit2", "quoted")


@dataclass
class Lexicon:
    """Terms with their log odds, the strong ones, words that are no misspellings, and the regression."""

    terms: dict[str, float] = field(default_factory=dict)
    strong: tuple[str, ...] = ()
    innocent: frozenset[str] = frozenset()
    intercept: float = 0.0
    weights: tuple[float, ...] = ()

    def __post_init__(self):
        self.trie = Trie(self.strong)
        self.stems = {t[:-1] for t in self.terms if t.endswith("*")}
        self.sizes = sorted({len(t) for t in self.stems})
        self.hits: dict[str, tuple[str, str]] = {}
        self.passed: set[str] = set()

    def __reduce__(self):
        return Lexicon, (self.terms, self.strong, self.innocent, self.intercept, self.weights)

    def look_up(self, word: str) -> tuple[str, str] | None:
        """The term that a lower-case word matches, and how: exact, stem, or edits."""
        if word in self.terms:
            return word, "exact"
        for n in self.sizes:
            if word[:n] in self.stems:
                return word[:n] + "*", "stem"
        if word in self.innocent or not self.trie.may_match(word):
            return None
        near = self.trie.matches(word)
        return (near[0][0], f"edit{near[0][1]}") if near else None

    def spot(self, words: set[str]) -> set[str]:
        """Those of the words that match a term."""
        for w in words - self.passed:
            if w in self.hits:
                continue
            hit = self.look_up(w)
            if hit:
                self.hits[w] = hit
            else:
                self.passed.add(w)
        out = words & self.hits.keys()
        if len(self.passed) > CACHE:
            self.passed.clear()
        return out

    def find(self, text: str) -> tuple[list[dict], int]:
        """Matches in a text (where, which term, how, if quoted), and its number of words."""
        low = text.lower()
        words = _WORD.findall(low)
        spotted = self.spot(set(words))
        if not spotted:
            return [], len(words)
        if len(low) != len(text):  # a letter whose lower case is longer: keep places
            low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
        places = [m.span() for m in _WORD.finditer(low)]
        out = []
        for i, (a, b) in enumerate(places):
            if low[a:b] not in spotted:
                continue
            term, how = self.hits[low[a:b]]
            before = text[places[max(0, i - CONTEXT)][0] : a]
            after = text[b : places[min(len(places) - 1, i + CONTEXT)][1] + 1]
            quoted = bool(_QUOTE.search(before)) and bool(_QUOTE.search(after))
            out.append({"start": a, "end": b, "term": term, "word": low[a:b], "how": how, "quoted": quoted})
        if len(self.hits) > CACHE:
            self.hits.clear()
        return out, len(words)

    def features(self, matches: list[dict], n_words: int) -> list[float]:
        """Per kind the log odds of its different words, and the density of all."""
        kinds = dict.fromkeys(KINDS, 0.0)
        for word, term, kind in {(m["word"], m["term"], "quoted" if m["quoted"] else m["how"]) for m in matches}:
            kinds[kind] += max(0.0, self.terms.get(term, 0.0)) / 5
        return [*(math.log1p(kinds[k]) for k in KINDS), math.log1p(100 * len(matches) / max(n_words, 20)), float(bool(matches)) * math.log1p(n_words / 100)]

    def score(self, features: list[float]) -> float:
        total = self.intercept + sum(w * x for w, x in zip(self.weights, features))
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, total))))


def regression(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE) -> np.ndarray:
    """Intercept and weights of a ridge logistic regression, by Newton steps."""
    x = np.column_stack([np.ones(len(x)), x])
    penalty = np.diag([1e-6] + [ridge] * (x.shape[1] - 1))
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _gathered(toxic: bool):
    """Per task: toxic texts give (term, word, neighbourhood) once, clean ones numbers of texts a term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[str, str, str]] = set()
        count: Counter = Counter()

        def held() -> Iterator[pa.RecordBatch]:
            rows = [(*x, 0) for x in seen] if toxic else [(t, "", "", n) for t, n in count.items()]
            for i in range(0, len(rows), 50_000):
                part = list(zip(*rows[i : i + 50_000]))
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.string()) for c in part[:3]), pa.array(part[3], pa.int64())], ["term", "word", "around", "n"])
            seen.clear()
            count.clear()

        for batch in batches:
            for text in batch.column("text").to_pylist():
                if len(seen) + len(count) > HELD:
                    yield from held()
                words = _WORD.findall(text.lower())
                if not toxic:
                    distinct = set(words)
                    count.update(distinct)
                    count.update({w[:n] + "*" for w in distinct for n in STEM_SIZES if len(w) >= n})
                    continue
                for i, w in enumerate(words):
                    around = " ".join(words[max(0, i - 1) : i] + ["_"] + words[i + 1 : i + 2])
                    seen.add((w, w, around))
                    seen.update((w[:n] + "*", w, around) for n in STEM_SIZES if len(w) >= n)
        yield from held()

    return run


def _sample(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """``(doc_id, label, text)`` of the ``rows`` labelled documents of each label whose ids hash lowest."""
    known = labels.where("doc_id is not null and label in (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = None
    for label in (0, 1):
        part = known.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
        chosen = part if chosen is None else chosen.unionByName(part)
    # at most two times ``rows`` rows of 12 bytes
    return docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text")


def _terms(texts: DataFrame, bad: int, good: int) -> tuple[Lexicon, DataFrame]:
    """The terms of the texts (label, text), and the clean texts' number of texts a term."""
    wire = "term string, word string, around string, n long"
    hits = texts.where("label = 1").select("text").mapInArrow(_gathered(True), wire).select("term", "word", "around").distinct()
    toxic = hits.groupBy("term").agg(F.countDistinct("around").alias("contexts"), F.countDistinct("word").alias("words")).where(F.col("contexts") >= MIN_CONTEXTS)
    clean = texts.where("label = 0").select("text").mapInArrow(_gathered(False), wire).groupBy("term").agg(F.sum("n").alias("n"))
    odds = F.log((F.least("contexts", F.lit(bad)) + 0.5) / (bad + 1)) - F.log((F.coalesce("n", F.lit(0)) + 0.5) / (good + 1))
    stem = F.endswith("term", F.lit("*"))
    wanted = F.when(stem, (odds >= STEM_ODDS) & (F.col("words") >= STEM_WORDS) & (F.col("contexts") >= STEM_CONTEXTS)).otherwise(odds >= MIN_ODDS)
    found = toxic.join(clean, "term", "left").withColumn("odds", odds).where(wanted).orderBy(F.desc("odds"), F.desc("contexts"), "term").limit(MAX_TERMS).collect()
    stems = {r.term[:-1] for r in found if r.term.endswith("*")}
    strong = [r.term for r in found if not r.term.endswith("*") and r.odds >= STRONG_ODDS and r.contexts >= STRONG_CONTEXTS and not any(r.term[:n] in stems for n in STEM_SIZES)]
    return Lexicon({r.term: float(r.odds) for r in found}, tuple(sorted(strong))), clean.where(~stem)


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Lexicon:
    """From ``docs`` (doc_id, text) and ``labels`` (doc_id, label)."""
    sample = materialize(_sample(docs.where("doc_id is not null and text is not null"), labels, rows), "sample").withColumn(
        "last", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(3)) == 0
    )
    count = {(r.label, r["last"]): r.n for r in sample.groupBy("label", "last").agg(F.count(F.lit(1)).alias("n")).collect()}
    everyone = {r.label: r.n for r in labels.where("label in (0, 1)").groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    prior = math.log((everyone.get(1, 0) + 1) / (everyone.get(0, 0) + 1))
    if not all(count.get((label, last)) for label in (0, 1) for last in (False, True)):
        return Lexicon(intercept=prior)
    texts = sample.select("label", "text", "last")
    lexicon, clean = _terms(texts.where("not last"), count[1, False], count[0, False])

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = sorted(w for w in lexicon.spot(set(batch.column("term").to_pylist())) if lexicon.hits[w][1].startswith("edit"))
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string())], ["term"])

    # words that several clean texts hold and the trie would take for a misspelling
    innocent = frozenset(r.term for r in clean.where(F.col("n") >= 2).select("term").mapInArrow(alike, "term string").collect())
    lexicon = Lexicon(lexicon.terms, lexicon.strong, innocent)

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [lexicon.features(*lexicon.find(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(x, pa.list_(pa.float64()))], ["label", "x"])

    seen = texts.where("last").select("label", "text").mapInArrow(described, "label int, x array<double>").collect()
    w = regression(np.array([r.x for r in seen]), np.array([float(r.label) for r in seen]))
    sampled = math.log(count[1, True] / count[0, True])
    return Lexicon(lexicon.terms, lexicon.strong, innocent, float(w[0]) + prior - sampled, tuple(float(x) for x in w[1:]))


def toxicity(docs: DataFrame, lexicon: Lexicon, *keep: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, *keep, score, matches)`` a row; matches in code points, half open."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), *keep, F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    names = texts.columns[:-1]
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in texts.select(*names).schema)
    match = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("term", pa.string()), ("word", pa.string()), ("how", pa.string()), ("quoted", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [lexicon.find(t) for t in batch.column("_text").to_pylist()]
            scores = [lexicon.score(lexicon.features(m, n)) for m, n in found]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(scores, pa.float64()), pa.array([m for m, _ in found], match)], [*names, "score", "matches"]
            )

    return texts.mapInArrow(run, f"{kinds}, score double, matches array<struct<start: int, end: int, term: string, word: string, how: string, quoted: boolean>>")

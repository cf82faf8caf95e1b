"""Benchmark decontamination: one Aho-Corasick automaton over normalised test items.

Normalised words: A-Z lowered, runs of letters, digits and all non-ASCII. A
window is ``length`` consecutive words of an item (all of a shorter one). The
automaton's symbols are words of the benchmark, every other word is symbol 0, so a text is
normalised and scanned once; word numbers lead back to places in the original.

The benchmark is a stated set: its words are counted, and more than
``block_words`` of them are dealt over several automata, one scan each. The first scan hands all
rows on, those after it only the hits of a text, which are joined back to every row with that text. Null texts and items have no words, a null item_id is written
as an empty string, rows repeating an item_id are one item. Rows of documents come back as often
as they occur; rows repeating doc_id and text have one result. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache, reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from joblark.llm.repeats import keyed, with_names
from joblark.session import materialize

LENGTH = 10
BLOCK_WORDS = 200_000

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_WORDS_SQL = _WORD.pattern.decode()
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)


def normal_words(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class Scanner:
    """Words to symbols, and the automaton over windows of symbols."""

    def __init__(self, items: tuple[tuple[str, bytes], ...], length: int):
        self.symbols: dict[bytes, int] = {}
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        owners: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            key = tuple(self.symbols.setdefault(w, len(self.symbols) + 1) for w in normal_words(text))
            for i in range(max(1, len(key) - length + 1) if key else 0):
                owners.setdefault(key[i : i + length], set()).add(item)
        for window, names in owners.items():
            self.automaton.add_word(window, (len(window), names))
        if owners:
            self.automaton.make_automaton()
        self.empty = not owners

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Runs of words inside windows, and the items whose windows occur."""
        runs: list[tuple[int, int]] = []
        items: set[str] = set()
        if self.empty or not words:
            return runs, items
        get = self.symbols.get
        hits = [(end + 1 - size, end + 1, names) for end, (size, names) in self.automaton.iter(tuple([get(w, 0) for w in words]))]
        for start, end, names in sorted(hits, key=lambda h: h[:2]):
            items |= names
            if runs and start < runs[-1][1]:
                runs[-1] = (runs[-1][0], max(end, runs[-1][1]))
            else:
                runs.append((start, end))
        return runs, items


@lru_cache(maxsize=2)
def scanner(items: tuple[tuple[str, bytes], ...], length: int) -> Scanner:
    return Scanner(items, length)


def _in_original(text: bytes, runs: list[tuple[int, int]]) -> list[dict]:
    """The runs as code points of the text."""
    if not runs:
        return []
    places = [m.span() for m in _WORD.finditer(text)]
    out, at, chars = [], 0, 0
    for start, end in runs:
        edges = []
        for place in (places[start][0], places[end - 1][1]):
            chars += len(text[at:place].decode())
            at = place
            edges.append(chars)
        out.append({"start": edges[0], "end": edges[1]})
    return out


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_FOUND = ("runs", "spans", "items")
_OUT = (
    "id long, doc long, tag long, n_words long, runs array<struct<start: long, end: long>>, "
    "spans array<struct<start: long, end: long>>, items array<string>"
)


def _scan(texts: DataFrame, kept: DataFrame, items: tuple[tuple[str, bytes], ...], length: int) -> DataFrame:
    names = kept.columns
    shared = texts.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner(shared.value, length).scan
        for batch in batches:
            count, runs, spans, of_items = [], [], [], []
            for value in batch.column("text"):
                body = value.as_py()
                words = normal_words(body)
                hit, of = scan(words)
                count.append(len(words))
                runs.append([{"start": s, "end": e} for s, e in hit])
                spans.append(_in_original(body, hit))
                of_items.append(sorted(of))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("id", "doc", "tag")), pa.array(count, pa.int64()), pa.array(runs, _SPANS), pa.array(spans, _SPANS), pa.array(of_items, pa.list_(pa.string())), *(batch.column(n) for n in names)],
                ["id", "doc", "tag", "n_words", "runs", "spans", "items", *names],
            )

    return texts.mapInArrow(run, with_names(_OUT, kept))


def _union(spans: str) -> str:
    """SQL that joins overlapping spans of a sorted array."""
    return (
        f"aggregate(array_sort({spans}), cast(array() as array<struct<start: bigint, end: bigint>>), (a, s) -> "
        "case when size(a) > 0 and s.start < element_at(a, -1).end then "
        "concat(slice(a, 1, size(a) - 1), array(named_struct('start', element_at(a, -1).start, 'end', greatest(element_at(a, -1).end, s.end)))) "
        "else concat(a, array(s)) end)"
    )


def contamination(
    docs: DataFrame, benchmark: DataFrame, *keep: Column, length: int = LENGTH, block_words: int = BLOCK_WORDS,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """``(doc_id, n_words, runs, spans, items, *keep)`` a row: runs of words and spans of code points
    (half open) inside windows of the benchmark, and the sorted ids of the items they are from."""
    tests = benchmark.select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
        F.coalesce(F.col(item_text_col).cast("string"), F.lit("")).alias("text"),
    )
    total = tests.agg(F.sum(F.size(F.regexp_extract_all("text", F.lit(_WORDS_SQL), F.lit(0))))).first()[0] or 0
    blocks = -(-total // block_words) or 1
    dealt = tests.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks)).cast("int"))
    texts, kept, none = keyed(docs, id_col, text_col, *keep), docs.select(*keep), docs.select()

    def scanned(block: int, rows: DataFrame, kept: DataFrame) -> DataFrame:
        own = dealt.where(F.col("block") == block).select("item", F.col("text").cast("binary").alias("text")).collect()
        return _scan(rows, kept, tuple(sorted((r.item, bytes(r.text)) for r in own)), length)

    every = scanned(0, texts, kept)
    if blocks > 1:
        # the other blocks give narrow hits, one a text, which are joined back to all its rows
        narrow = texts.select("id", "doc", "tag", "text")
        hits = [materialize(scanned(k, narrow, none).where(F.size("runs") > 0).select("doc", "tag", *_FOUND), "hits") for k in range(1, blocks)]
        more = reduce(DataFrame.unionByName, hits).groupBy("doc", "tag").agg(*(F.flatten(F.collect_set(c)).alias(f"_more_{c}") for c in _FOUND))
        every = every.join(more, ["doc", "tag"], "left").withColumns({c: F.concat(c, F.coalesce(f"_more_{c}", F.array())) for c in _FOUND})
        every = every.withColumns({"runs": F.expr(_union("runs")), "spans": F.expr(_union("spans")), "items": F.array_sort(F.array_distinct("items"))})
    return every.select(F.col("id").alias("doc_id"), "n_words", *_FOUND, *kept.columns)

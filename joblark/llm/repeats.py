"""Exact repeats of ``length`` consecutive elements (bytes or words) in a corpus.

Every window of ``length`` elements has one anchor: the leftmost smallest hash of
its runs of ``gram`` elements (winnowing). Equal windows have equal anchors at
equal offsets, so only documents that share an anchor's hash can share a window.
The windows of one anchor occurrence are consecutive; an occurrence stands for
them all as one entry ``(key, cls, doc, tag, pos, n)``: hash of the anchor, hash of the whole
stretch the windows cover, id and hash of the text, place of the first window, their number.

1. ``Levels`` collapses entries of one class (same stretch) inside each task, then
   once more after a shuffle on the anchor: members of a class share every window.
   At most one entry a class leaves a task, so a passage that a third of all
   documents hold comes to its anchor's partition once for each task.
2. Of classes that share an anchor but not the stretch, one stretch each is sent to the
   anchor's partition and compared window by window.

Entries are told apart by ``key`` and ``cls`` together: windows by 128 bits, stretches by 64 bits among those
of one anchor.
3. What is marked meets its text in one join.

A document is its doc_id and the 64-bit hash of its text: rows that repeat both count as
one document; of different texts under one doc_id the order is that of the hash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from joblark.llm import hashing
from joblark.llm.hashing import U
from joblark.session import materialize

ENTRY = np.dtype([("cls", U), ("key", U), ("doc", np.int64), ("tag", np.int64), ("pos", np.int64), ("n", np.int32), ("seen", bool)])
MARKED, REQUEST, CANDIDATE, SEEN = 0, 1, 2, 3

# Bits that hold any place in a text.
POS_BITS = 40
# Longer texts are cut into pieces that overlap by length - 1, to bound memory.
PIECE = 1 << 22

_WIRE = "kind tinyint, key long, cls long, doc long, tag long, pos long, n int"
_FOUND = "kind tinyint, key long, doc long, tag long, pos long, n int"


class Levels:
    """A logarithmic family of sorted runs of entries, one for each class.

    ``insert`` sorts a batch, scans it against every level, and merges levels of
    like size, so that there are O(log) of them. It returns the entries whose
    windows repeat: with ``every`` all members of a class of two or more, else all
    but the first in (doc, tag, pos). Batches may come in any order.
    """

    def __init__(self, every: bool):
        self.every = every
        self.runs: list[tuple[np.ndarray, np.ndarray]] = []

    def insert(self, batch: np.ndarray) -> np.ndarray:
        order = np.lexsort((batch["pos"], batch["tag"], batch["doc"], batch["cls"]))
        if (~_alike(batch[order]) & (np.diff(batch["cls"][order]) == 0)).any():  # one hash of different entries
            order = np.lexsort((batch["pos"], batch["tag"], batch["doc"], batch["key"], batch["cls"]))
        batch = batch[order]
        if len(batch) > 1:
            same = _alike(batch)
            twin = same & (batch["doc"][1:] == batch["doc"][:-1]) & (batch["tag"][1:] == batch["tag"][:-1]) & (batch["pos"][1:] == batch["pos"][:-1])
            if twin.any():
                batch["seen"][:-1] |= twin & batch["seen"][1:]
                batch = batch[np.r_[True, ~twin]]
        first = np.ones(len(batch), bool)
        first[1:] = ~_alike(batch)
        marked = []
        if self.every:
            shared = ~first
            shared[:-1] |= ~first[1:]
            marked.append(batch[shared & ~batch["seen"]])
            batch["seen"] |= shared
        else:
            marked.append(batch[~first])
        fresh = batch[first]
        for cls, rows in self.runs:
            at, hit = _places(cls, rows["key"], fresh)
            if not hit.any():
                continue
            at, new, fresh = at[hit], fresh[hit], fresh[~hit]
            old = rows[at]
            other = (old["doc"] != new["doc"]) | (old["tag"] != new["tag"]) | (old["pos"] != new["pos"])
            if self.every:
                marked += [new[other & ~new["seen"]], old[other & ~old["seen"]]]
                rows["seen"][at] |= other | new["seen"]
            else:
                later = (new["tag"] > old["tag"]) | (new["tag"] == old["tag"]) & (new["pos"] > old["pos"])
                later = (new["doc"] > old["doc"]) | (new["doc"] == old["doc"]) & later
                earlier = other & ~later
                marked += [new[later], old[earlier]]
                rows[at[earlier]] = new[earlier]
        if len(fresh):
            self.runs.append((np.ascontiguousarray(fresh["cls"]), fresh))
        while len(self.runs) > 1 and len(self.runs[-2][0]) <= 2 * len(self.runs[-1][0]):
            (a, x), (b, y) = self.runs[-2:]
            cls = np.concatenate([a, b])
            order = np.argsort(cls, kind="stable")
            self.runs[-2:] = [(cls[order], np.concatenate([x, y])[order])]
        return np.concatenate(marked)

    def entries(self) -> np.ndarray:
        return np.concatenate([np.zeros(0, ENTRY), *(rows for _, rows in self.runs)])


def _alike(rows: np.ndarray) -> np.ndarray:
    """Which entries are of the class of the one before, from the second on."""
    return (rows["cls"][1:] == rows["cls"][:-1]) & (rows["key"][1:] == rows["key"][:-1])


def _places(cls: np.ndarray, key: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where a run sorted by ``cls`` holds the wanted classes, and whether it does."""
    at = np.searchsorted(cls, wanted["cls"])
    hit, left = np.zeros(len(wanted), bool), np.arange(len(wanted))
    while len(left):  # more than once only where different entries have one hash
        left = left[at[left] < len(cls)]
        left = left[cls[at[left]] == wanted["cls"][left]]
        same = key[at[left]] == wanted["key"][left]
        hit[left[same]] = True
        left = left[~same]
        at[left] += 1
    return at, hit


def stretches(h: np.ndarray, first: np.ndarray, last: np.ndarray, length: int, gram: int) -> tuple:
    """Anchors of all windows inside the texts: key, class, first window, number of windows."""
    none = (np.zeros(0, U), np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, np.int64))
    fits = last - first >= length
    if not fits.any():
        return none
    grams = hashing.run_hashes(h, gram)
    place = U((1 << 24) - 1)
    anchor = hashing.sliding_min(grams & ~place | np.arange(len(grams), dtype=U), length - gram + 1) & place
    step = np.zeros(len(anchor) + 1, np.int8)
    step[first[fits]] += 1
    step[last[fits] - length + 1] -= 1
    inside = np.cumsum(step[:-1], dtype=np.int8) > 0
    same = (anchor[1:] == anchor[:-1]) & inside[1:] & inside[:-1]
    ws = np.flatnonzero(inside & ~np.r_[False, same])
    we = np.flatnonzero(inside & ~np.r_[same, False])
    key = grams[anchor[ws].astype(np.int64)]
    whole = window_hashes(grams, length, gram)
    n = we - ws + 1
    cls = hashing.mix(whole[ws] * hashing._ODD[1] + hashing.mix(whole[we] + n.astype(U)))
    return key, cls, ws, n


def window_hashes(grams: np.ndarray, length: int, gram: int) -> np.ndarray:
    """Hashes of runs of ``length`` from those of runs of ``gram``."""
    size = gram
    while size * 2 <= length:
        grams = hashing.join_runs(grams, size)
        size *= 2
    return hashing.join_runs(grams, length - size) if size < length else grams


def second_hashes(grams: np.ndarray, length: int, gram: int) -> np.ndarray:
    """Other hashes of the same runs, for 128 bits together."""
    steps = [*range(0, length - gram, gram), length - gram]
    count = max(0, len(grams) - (length - gram))
    out = np.zeros(count, U)
    for s in steps:
        out = hashing.mix(out + grams[s : s + count] * hashing._ODD[0])
    return out


def spanned(marked: np.ndarray) -> np.ndarray:
    """Marked entries with neighbours of one document put together."""
    if len(marked) < 2:
        return marked
    marked = marked[np.lexsort((marked["pos"], marked["tag"], marked["doc"]))]
    after = (marked["doc"][1:] == marked["doc"][:-1]) & (marked["tag"][1:] == marked["tag"][:-1]) & (marked["pos"][1:] == marked["pos"][:-1] + marked["n"][:-1])
    start = np.flatnonzero(np.r_[True, ~after])
    out = marked[start]
    out["n"] = np.add.reduceat(marked["n"], start)
    return out


def _wire(rows: np.ndarray, kind) -> pa.RecordBatch:
    key = rows["key"] if not np.isscalar(kind) or kind != MARKED else hashing.mix(rows["pos"].astype(U) + rows["tag"].astype(U) + rows["doc"].astype(U) * hashing._ODD[0])
    kinds = np.full(len(rows), kind, np.int8) if np.isscalar(kind) else kind
    return pa.RecordBatch.from_arrays(
        [pa.array(kinds), *(pa.array(np.ascontiguousarray(x).view(np.int64)) for x in (key, rows["cls"], rows["doc"], rows["tag"], rows["pos"])), pa.array(np.ascontiguousarray(rows["n"]))],
        ["kind", "key", "cls", "doc", "tag", "pos", "n"],
    )


def _found(rows: np.ndarray, kind: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(rows), kind, np.int8)), pa.array(np.ascontiguousarray(rows["key"]).view(np.int64)), *(pa.array(np.ascontiguousarray(rows[c])) for c in ("doc", "tag", "pos", "n"))],
        ["kind", "key", "doc", "tag", "pos", "n"],
    )


def _entries(batch: pa.RecordBatch, rows: np.ndarray) -> np.ndarray:
    out = np.zeros(int(rows.sum()), ENTRY)
    for name in ("key", "cls"):
        out[name] = batch.column(name).to_numpy()[rows].view(U)
    for name in ("doc", "tag", "pos", "n"):
        out[name] = batch.column(name).to_numpy()[rows]
    out["seen"] = batch.column("kind").to_numpy()[rows] == SEEN
    return out


def _pieces(batch: pa.RecordBatch, overlap: int, by_word: bool) -> Iterator[tuple]:
    """(doc, tag, place of the first element, bytes) of a batch's texts."""
    for doc, tag, text in zip(batch.column("doc").to_pylist(), batch.column("tag").to_pylist(), batch.column("text")):
        body = text.as_py()
        if len(body) <= PIECE:
            yield doc, tag, 0, body
        elif by_word:
            words = body.split()
            for i in range(0, max(1, len(words) - overlap), PIECE // 8):
                yield doc, tag, i, b" ".join(words[i : i + PIECE // 8 + overlap])
        else:
            for i in range(0, max(1, len(body) - overlap), PIECE):
                yield doc, tag, i, body[i : i + PIECE + overlap]


def _anchored(length: int, gram: int, by_word: bool, every: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = Levels(every)
        for batch in batches:
            for rows in hashing.chunks(_pieces(batch, length - 1, by_word)):
                h, first, last = (hashing.word_elements if by_word else hashing.byte_elements)([r[-1] for r in rows])
                key, cls, ws, n = stretches(h, first, last, length, gram)
                if not len(key):
                    continue
                at = np.searchsorted(first, ws, side="right") - 1
                found = np.zeros(len(key), ENTRY)
                found["key"], found["cls"], found["n"] = key, cls, n
                found["doc"] = np.array([r[0] for r in rows], np.int64)[at]
                found["tag"] = np.array([r[1] for r in rows], np.int64)[at]
                found["pos"] = np.array([r[2] for r in rows], np.int64)[at] + ws - first[at]
                marked = spanned(levels.insert(found))
                if len(marked):
                    yield _wire(marked, MARKED)
        held = levels.entries()
        for i in range(0, len(held), 100_000):
            part = held[i : i + 100_000]
            yield _wire(part, np.where(part["seen"], SEEN, CANDIDATE).astype(np.int8))

    return run


def _collapsed(every: bool) -> Callable:
    """One partition's candidates in levels; classes that share an anchor are asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = Levels(every)
        for batch in batches:
            kind = batch.column("kind").to_numpy()
            passed = kind == MARKED
            if passed.any():
                yield batch.filter(pa.array(passed)).select(["kind", "key", "doc", "tag", "pos", "n"])
            if not passed.all():
                marked = spanned(levels.insert(_entries(batch, ~passed)))
                if len(marked):
                    yield _found(marked, MARKED)
        held = levels.entries()
        if len(held) > 1:
            held = held[np.argsort(held["key"], kind="stable")]
            same = held["key"][1:] == held["key"][:-1]
            held = held[np.r_[False, same] | np.r_[same, False]]
            if len(held):
                yield _found(held, REQUEST)

    return run


def _stretches_of(length: int, by_word: bool) -> Callable:
    """The bytes of the stretches asked for, to be compared where their anchor's others are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, asked in enumerate(batch.column("asked").to_pylist()):
                doc, tag, body = batch.column("doc")[i].as_py(), batch.column("tag")[i].as_py(), batch.column("text")[i].as_py()
                if by_word:
                    words = body.split()
                    bodies = [b" ".join(words[w["ws"] : w["ws"] + w["n"] + length - 1]) for w in asked]
                else:
                    bodies = [body[w["ws"] : w["ws"] + w["n"] + length - 1] for w in asked]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([w["key"] for w in asked]), pa.array([doc] * len(asked)), pa.array([tag] * len(asked)), pa.array([w["ws"] for w in asked]), pa.array(bodies, pa.binary())],
                    ["key", "doc", "tag", "pos", "body"],
                )

    return run


def _compared(length: int, gram: int, by_word: bool, every: bool) -> Callable:
    """Stretches that share an anchor, window by window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = Levels(every)
        for batch in batches:
            for part in hashing.chunks(zip(*(batch.column(c).to_pylist() for c in ("doc", "tag", "pos", "body")))):
                h, first, last = (hashing.word_elements if by_word else hashing.byte_elements)([r[-1] for r in part])
                grams = hashing.run_hashes(h, gram)
                one, two = window_hashes(grams, length, gram), second_hashes(grams, length, gram)
                n = last - first - length + 1
                offset = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                at = np.repeat(first, n) + offset
                found = np.zeros(len(at), ENTRY)
                found["key"], found["cls"], found["n"] = one[at], hashing.mix(two[at] + one[at] * hashing._ODD[3]), 1
                found["doc"] = np.repeat(np.array([r[0] for r in part], np.int64), n)
                found["tag"] = np.repeat(np.array([r[1] for r in part], np.int64), n)
                found["pos"] = np.repeat(np.array([r[2] for r in part], np.int64), n) + offset
                marked = spanned(levels.insert(found))
                if len(marked):
                    yield _found(marked, MARKED)

    return run


def keyed(docs: DataFrame, id_col: str, text_col: str, *keep: Column) -> DataFrame:
    """``(id, doc, tag, text, *keep)``: null ids count as the smallest, null texts as empty."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63))).alias("doc"),
        F.xxhash64(text).alias("tag"),
        text.cast("binary").alias("text"),
        *keep,
    )


def with_names(types: str, kept: DataFrame) -> str:
    """A schema for a Python function that hands the columns of ``kept`` on."""
    return ", ".join([types, *(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)])


def _of_document(found: DataFrame, kind: int, name: str, *more: str) -> DataFrame:
    """One row a document: the places found in it, whose number its length bounds."""
    return (
        found.where(F.col("kind") == kind)
        .groupBy("doc", "tag")
        .agg(F.collect_list(F.struct(F.col("pos").alias("ws"), "n", *more)).alias(name))
    )


def repeated_windows(texts: DataFrame, length: int, gram: int, by_word: bool, every: bool) -> DataFrame:
    """``(doc, tag, ranges)``: first windows and numbers of windows that repeat.

    ``texts`` comes from ``keyed``. Documents without repeats have no row.
    """
    anchored = texts.select("doc", "tag", "text").mapInArrow(_anchored(length, gram, by_word, every), _WIRE)
    found = materialize(anchored.repartition("key").mapInArrow(_collapsed(every), _FOUND), "repeats")
    asked = _of_document(found, REQUEST, "asked", "key")
    single = (
        texts.select("doc", "tag", "text").join(asked, ["doc", "tag"]).select("doc", "tag", "text", "asked")
        .mapInArrow(_stretches_of(length, by_word), "key long, doc long, tag long, pos long, body binary")
        .repartition("key").mapInArrow(_compared(length, gram, by_word, every), _FOUND)
    )
    marked = materialize(found.where(F.col("kind") == MARKED).unionByName(single), "marked")
    return _of_document(marked, MARKED, "ranges")


def merged(ranges: list[dict] | None, length: int) -> list[tuple[int, int]]:
    """Half-open spans of elements that the windows of ``ranges`` cover."""
    out: list[tuple[int, int]] = []
    for r in sorted(ranges or (), key=lambda r: r["ws"]):
        start, end = r["ws"], r["ws"] + r["n"] - 1 + length
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out

"""BPE encoding and decoding: tree concatenation of pieces encoded in parallel.

A text of more than ``leaf`` code points is cut into leaves, which other tasks encode.
Neighbouring encodings are then joined in a balanced tree. At a join the last
``k`` tokens of the left and the first ``k`` of the right are decoded and encoded
anew as one string; ``k`` doubles until the window's first tokens are the left
side's own and its last tokens the right side's own, or a side is used up.
Every pair of neighbours in the result is then one that the encoder itself put side by side,
in the window or outside, and a sequence of tokens is the encoding of its text just
when all its neighbours are (merges act on neighbours, in the order of their ranks).

Leaves are encoded with the ranks of the vocabulary file, whose tokens must be in the order of the
merges; this is checked. Null texts count as empty. Repeated rows come
back as often as they occur. Other columns are ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
LEAF = 1 << 15
WINDOW = 16
AGREED = 2


def byte_symbols() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Codec:
    """A byte-level BPE vocabulary with its added tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, symbols = spec["model"], byte_symbols()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(symbols[c] for c in token): i for token, i in model["vocab"].items() if token not in self.special}
        for at, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            if model["vocab"][left + right] != 256 + at:
                raise ValueError(f"{path}: tokens are not in the order of the merges")
        self.ranks = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.bytes_of = [b""] * (max([*ranks.values(), *self.special.values()]) + 1)
        for token, i in ranks.items():
            self.bytes_of[i] = token
        for text, i in self.special.items():
            self.bytes_of[i] = text.encode()
        longest_first = sorted(self.special, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if self.special else None

    def encode(self, text: str) -> list[int]:
        if self.cut is None or not self.cut.search(text):
            return self.ranks.encode_ordinary(text)
        ids: list[int] = []
        for at, part in enumerate(self.cut.split(text)):
            ids += [self.special[part]] if at % 2 else self.ranks.encode_ordinary(part)
        return ids

    def decode(self, ids) -> str:
        return b"".join([self.bytes_of[i] for i in ids]).decode("utf-8", "replace")

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two strings' concatenation from theirs."""
        k = WINDOW
        while left and right:
            a, b = max(0, len(left) - k), min(k, len(right))
            # whole characters only
            while a and self.bytes_of[left[a]][0] & 0xC0 == 0x80:
                a -= 1
            while b < len(right) and self.bytes_of[right[b]][0] & 0xC0 == 0x80:
                b += 1
            middle = self.encode(self.decode(left[a:] + right[:b]))
            if (not a or middle[:AGREED] == left[a : a + AGREED]) and (b == len(right) or middle[-AGREED:] == right[b - AGREED : b]):
                return left[:a] + middle + right[b:]
            k *= 2
        return left + right

    def concatenate(self, parts: list[list[int]]) -> list[int]:
        while len(parts) > 1:
            parts = [self.join(*parts[i : i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
        return parts[0] if parts else []


@lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    return Codec(path)


def leaves(text: str, size: int) -> list[str]:
    return [text[i : i + size] for i in range(0, len(text), size)]


_OUT = "doc_id long, ids array<int>, decoded string"


def _rows(doc_ids, encoded: list[list[int]], with_code: Codec) -> pa.RecordBatch:
    sizes = np.cumsum([0, *map(len, encoded)], dtype=np.int32)
    flat = np.fromiter((i for ids in encoded for i in ids), np.int32, int(sizes[-1]))
    return pa.RecordBatch.from_arrays(
        [doc_ids, pa.ListArray.from_arrays(pa.array(sizes), pa.array(flat)), pa.array([with_code.decode(ids) for ids in encoded], pa.string())],
        ["doc_id", "ids", "decoded"],
    )


def encode_documents(docs: DataFrame, vocabulary: str = VOCABULARY, leaf: int = LEAF, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, ids array<int>, decoded string)`` a row."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(vocabulary)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                yield _rows(part.column("doc_id"), [code.encode(t.as_py()) for t in part.column("text")], code)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                parts = leaves(row["text"], leaf)
                n = len(parts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row[c]] * n, pa.int64()) for c in ("doc_id", "h1", "h2")] + [pa.array(range(n), pa.int32()), pa.array(parts, pa.string())],
                    ["doc_id", "h1", "h2", "part", "piece"],
                )

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(vocabulary)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                ids = [np.array(code.encode(t.as_py()), np.int32).tobytes() for t in part.column("piece")]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("doc_id", "h1", "h2", "part")), pa.array(ids, pa.binary())], ["doc_id", "h1", "h2", "part", "ids"])

    def joined(table: pa.Table) -> pa.Table:
        code = codec(vocabulary)
        table = table.sort_by("part")
        number = table.column("part").to_pylist()
        copies = number.count(0)
        parts = [np.frombuffer(x.as_py(), np.int32).tolist() for x in table.column("ids").take(pa.array(range(0, len(number), copies)))]
        ids = code.concatenate(parts)
        doc_id = pa.array(table.column("doc_id").to_pylist()[:copies], pa.int64())
        return pa.Table.from_batches([_rows(doc_id, [ids] * copies, code)])

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    long = F.char_length("text") > leaf
    short = rows.where(~long).mapInArrow(whole, _OUT)
    # a cut text is known by doc_id and 128 bits of its hash, so that a repeated task names it alike
    pieces = rows.where(long).select("doc_id", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2"), "text").mapInArrow(
        split, "doc_id long, h1 long, h2 long, part int, piece string"
    )
    parts = pieces.repartition("h1", "h2", "part").mapInArrow(encoded, "doc_id long, h1 long, h2 long, part int, ids binary")
    return short.unionByName(parts.groupBy("doc_id", "h1", "h2").applyInArrow(joined, _OUT))

"""Harmonic packing: documents as token ids in sequences of at most ``capacity`` ids.

A remainder of t ids belongs to class k = ceil(capacity / t), that is to the lengths
from capacity / k to below capacity / (k - 1); k documents of that class fill one
sequence. Slot j of such a sequence takes the ids between ``j * capacity // k`` and
``(j + 1) * capacity // k``, which is never more than t, so the k slots fill it to the last id.
What a slot leaves of a document is again a remainder, of a class with shorter lengths:
it loses at least half of itself each time. Ids beyond whole multiples of the capacity come last; a full
multiple is class 1.

Every task fills sequences of its own, so nothing is shuffled and a task that runs again
makes the same ones. A task keeps the open sequence of each class (some 2 * sqrt(capacity) of
them, each below the capacity). When its documents end, it puts what these hold one after the other, cuts
it at the capacity, and cuts the last, shorter stretch into powers of two, longest first,
which need no padding: no sequence of this packing does.

Ids are the tokenizer's, then ``end_id``. A text of Latin letters is cut into words by the tokenizer's own
rules, and the ids of a word are looked up: its words do not affect each other. Every other text, and one
that holds a special token's string, goes through the library as a whole.

Null texts count as empty and give the end id alone. Rows that repeat a doc_id, or have none, are packed like others, each
under the id it has; so are repeated rows. No rows, no sequences. Other columns are ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
CAPACITY = 4096
END_ID = 2
ID_BYTES = 4
SEQUENCES_A_TASK = 1 << 33
_KNOWN_WORDS = 1 << 20
_ROWS_A_BATCH = 1024

# Texts of these characters are the same after composition (NFC), have one lower-case form each, and white
# space, letters and digits in them are the same to Python's expressions and to the tokenizer's.
_OTHER = re.compile(r"[^\t-\r\x20-\x7e\xc0-\xd6\xd8-\xf6\xf8-\xff–—‘’“”…]")
_WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+|[0-9]|[^\sa-z0-9\xc0-\xd6\xd8-\xf6\xf8-\xff]+")
_WORD_RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"  # the vocabulary file's own


def _bytes_of(ids: list[int]) -> bytes:
    return b"".join([i.to_bytes(ID_BYTES, "little") for i in ids])


class Words(dict):
    """The ids of words, as bytes, learned from the tokenizer when first asked for."""

    def __init__(self, tokenizer: Tokenizer):
        super().__init__()
        self.tokenizer = tokenizer

    def __missing__(self, word: str) -> bytes:
        if len(self) >= _KNOWN_WORDS:
            self.clear()
        found = self[word] = _bytes_of(self.tokenizer.encode(word, add_special_tokens=False).ids)
        return found


class Encoder:
    """Texts to ids as little-endian bytes, the same as the tokenizers library's."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = re.compile("|".join(re.escape(t["content"]) for t in spec["added_tokens"]) or r"(?!)")
        steps = (spec["pre_tokenizer"] or {}).get("pretokenizers") or [{}]
        self.by_word = steps[0].get("pattern") == {"Regex": _WORD_RULE} and {"type": "Lowercase"} in (spec["normalizer"] or {}).get("normalizers", [])
        self.words = Words(self.tokenizer)

    def encode(self, text: str) -> bytes:
        if self.by_word and not _OTHER.search(text) and not self.special.search(text):
            return b"".join(map(self.words.__getitem__, _WORD.findall(text.lower())))
        return _bytes_of(self.tokenizer.encode(text, add_special_tokens=False).ids)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


class Packer:
    """The open sequences of one task. ``put`` is told of every piece: document, start, ids, its document's
    ids in all, sequence, offset."""

    def __init__(self, capacity: int, put: Callable[..., None], first_sequence: int = 0):
        self.capacity, self.put, self.next_sequence = capacity, put, first_sequence
        self.open: dict[int, list[tuple]] = {}

    def _sequence(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc_id, start, ids, total in pieces:
            self.put(doc_id, start, ids, total, self.next_sequence, offset)
            offset += len(ids) // ID_BYTES
        self.next_sequence += 1

    def add(self, doc_id: int | None, ids: bytes) -> None:
        total, start = len(ids) // ID_BYTES, 0
        while start < total:
            k = -(-self.capacity // min(total - start, self.capacity))
            held = self.open.setdefault(k, [])
            j = len(held)
            end = start + (j + 1) * self.capacity // k - j * self.capacity // k
            held.append((doc_id, start, ids[start * ID_BYTES : end * ID_BYTES], total))
            start = end
            if j + 1 == k:
                self._sequence(self.open.pop(k))

    def close(self) -> None:
        """Sequences of what is still open."""
        rest = [piece for k in sorted(self.open) for piece in self.open[k]]
        self.open.clear()
        left = sum(len(p[2]) for p in rest) // ID_BYTES
        sizes = [self.capacity] * (left // self.capacity)
        left %= self.capacity
        sizes += [1 << b for b in reversed(range(left.bit_length())) if left >> b & 1]
        at = 0  # ids of the first piece that are used
        rest.reverse()
        for size in sizes:
            pieces = []
            while size:
                doc_id, start, ids, total = rest[-1]
                n = min(size, len(ids) // ID_BYTES - at)
                pieces.append((doc_id, start + at, ids[at * ID_BYTES : (at + n) * ID_BYTES], total))
                size -= n
                at += n
                if at * ID_BYTES == len(ids):
                    rest.pop()
                    at = 0
            self._sequence(pieces)


_OUT = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
])


def pack_documents(
    docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, start, length, ids, doc_tokens, sequence_id, offset)`` a piece; ``ids`` are unsigned
    32-bit numbers, least byte first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, end = encoder(vocabulary), _bytes_of([end_id])
        made: list[tuple] = []

        def put(doc_id, start, ids, total, sequence, offset):
            made.append((doc_id, start, len(ids) // ID_BYTES, ids, total, sequence, offset))

        def taken(least: int) -> Iterator[pa.RecordBatch]:
            while len(made) >= max(least, 1):
                part, made[:_ROWS_A_BATCH] = made[:_ROWS_A_BATCH], []
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), _OUT)], schema=_OUT)

        packer = Packer(capacity, put, TaskContext.get().partitionId() * SEQUENCES_A_TASK)
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                packer.add(doc_id, code.encode(text.as_py()) + end)
                yield from taken(_ROWS_A_BATCH)
        packer.close()
        yield from taken(1)

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    return rows.mapInArrow(run, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")

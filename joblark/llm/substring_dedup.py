"""Substring dedup: words inside a stretch that occurs twice or more are removed.

Method: seed and extend. Documents meet on winnowed anchors (hashes of ``gram``
words). A seed extends both ways over the windows it anchors, neighbouring stretches
join, and what is left are the maximal repeats of ``length`` words or more.

Null texts have no words, null ids count as the smallest; rows repeating doc_id and
text are one document. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame

from joblark.llm import repeats

LENGTH = 35
GRAM = 12
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def _kept(length: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            out = {"n_words": [], "kept_words": [], "kept": [], "spans": []}
            for i, ranges in enumerate(batch.column("ranges").to_pylist()):
                body = texts[i].as_py()
                words, cut = body.split(), repeats.merged(ranges, length)
                out["n_words"].append(len(words))
                out["spans"].append([{"start": s, "end": e} for s, e in cut])
                if not cut:
                    out["kept_words"].append(b" ".join(words).decode())
                    out["kept"].append(body.decode())
                    continue
                places = [m.start() for m in _WORD.finditer(body)] + [len(body)]
                parts, left, at = [], [], 0
                for start, end in cut:
                    parts.append(body[(places[at] if at else 0) : places[start]])
                    left += words[at:start]
                    at = end
                parts.append(body[places[at] :])
                out["kept_words"].append(b" ".join(left + words[at:]).decode())
                out["kept"].append(b"".join(parts).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *(batch.column(n) for n in names), pa.array(out["n_words"], pa.int64()), pa.array(out["kept_words"], pa.string()), pa.array(out["kept"], pa.string()), pa.array(out["spans"], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                ["doc_id", *names, "n_words", "kept_words", "kept", "spans"],
            )

    return run


def substring_dedup(docs: DataFrame, *keep: Column, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, *keep, n_words, kept_words, kept, spans)`` a row.

    ``spans`` are maximal runs of words (first, past last) covered by windows of
    ``length`` words that also start elsewhere. ``kept`` is the text without them in
    its own spacing, ``kept_words`` its words with one space between.
    """
    texts, kept = repeats.keyed(docs, id_col, text_col, *keep), docs.select(*keep)
    found = repeats.repeated_windows(texts, length, gram, by_word=True, every=True)
    types = repeats.with_names("doc_id long", kept) + ", n_words long, kept_words string, kept string, spans array<struct<start: long, end: long>>"
    return texts.join(found, ["doc", "tag"], "left").select("id", "text", "ranges", *kept.columns).mapInArrow(_kept(length, kept.columns), types)

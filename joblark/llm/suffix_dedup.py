"""Suffix-array dedup: bytes that repeat an earlier stretch are removed.

Method: a logarithmic family of indexes. The suffixes that start at winnowed
anchors are ordered by fingerprints of their leading bytes instead of by the bytes
(blocks of equal leading bytes, all that matching needs, are the same). Each batch
of texts becomes such a sparse suffix array, is scanned against the existing
levels, and levels of like size merge geometrically (``repeats.Levels``), first in
the task that reads the texts, then in the partition that owns the anchor.

Null texts count as empty, null ids as the smallest; rows repeating doc_id and text
are one document. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from joblark.llm import repeats

LENGTH = 100
GRAM = 32


def _kept(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, kept = [], []
            texts = batch.column("text")
            for i, ranges in enumerate(batch.column("ranges").to_pylist()):
                body, cut, parts, at = texts[i].as_py(), repeats.merged(ranges, length), [], 0
                for start, end in cut:
                    parts.append(body[at:start])
                    at = end
                kept.append(b"".join(parts) + body[at:] if cut else body)
                spans.append([{"start": s, "end": e} for s, e in cut])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([len(t) for t in texts], pa.int64()) if not len(texts) else pa.compute.binary_length(texts).cast(pa.int64()), pa.array(kept, pa.binary()), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                ["doc_id", "n_bytes", "kept", "spans"],
            )

    return run


def suffix_dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, kept binary, spans array<struct<start, end>>)`` a row.

    ``spans`` are the maximal byte runs covered by a string of ``length`` bytes that
    also starts earlier: in a smaller doc_id, or before in the same text.
    """
    texts = repeats.keyed(docs, id_col, text_col)
    found = repeats.repeated_windows(texts, length, gram, by_word=False, every=False)
    return (
        texts.join(found, ["doc", "tag"], "left").select("id", "text", "ranges")
        .mapInArrow(_kept(length), "doc_id long, n_bytes long, kept binary, spans array<struct<start: long, end: long>>")
    )

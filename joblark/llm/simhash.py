"""SimHash near-dedup: ball hashing that meets in the middle, and its components.

Fingerprint: 64-bit majority over XXH64 (seed 42) of 4-word shingles of the text
with A-Z lowered; fewer words than four are one shingle, no words give zero.

Fingerprints within ``radius`` bits are linked. Of the three blocks of a
fingerprint (21, 21 and 22 bits) some two hold at most half of the bits that
differ (2 of 4). So every fingerprint emits, for each two blocks, all variants within
half of that (1 flip): 130 keys of 42 or 43 bits, shuffled and met there. Members of
a bucket are verified on all 64 bits. A bucket of more than ``CROWD`` members is not
paired off: its members emit the full ball, all variants of 64 bits within half the
radius (2,081), where members of one bucket are within the radius by the triangle
inequality, so that a star of links says all. No step makes the pairs of a group.

Links join fingerprints, not documents: copies share one. Components come from
alternating large-star and small-star rounds over tables in the shared folder.

``first_rows`` keeps one row of each component.

Null texts have no words; null ids are smaller than all others, and a component
with one has a null id. Repeated rows come back as often as they occur. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from joblark.llm.repeats import with_names
from joblark.session import materialize

SHINGLE = 4
RADIUS = 4
SEED = 42
# Members of a bucket that are compared in pairs; larger buckets take the full ball.
CROWD = 32
# Fingerprints whose variants one task writes.
PRINTS = 50_000

U = np.uint64
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_SMALLEST = -(2**63)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    starts = (ends - size)[: len(words) - shingle + 1].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :].tolist())], U)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 4096):
        part = hashes[i : i + 4096]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(U)[0])


def fingerprints(docs: DataFrame, *keep: Column, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fp, *keep)``: the fingerprint as a signed long."""
    kept = docs.select(*keep)
    names = kept.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(t.as_py() or b"", shingle) for t in batch.column("text")]
            prints = pa.array(np.array(values, U).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), prints, *(batch.column(n) for n in names)], ["doc_id", "fp", *names])

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"), *keep)
    return texts.mapInArrow(run, with_names("doc_id long, fp long", kept))


def _balls(bits: list[int], flips: int) -> np.ndarray:
    """Masks that flip up to ``flips`` of the given bits."""
    return np.array([sum(1 << b for b in c) for k in range(flips + 1) for c in combinations(bits, k)], U)


def _blocks(radius: int) -> list[tuple[np.ndarray, np.uint64]]:
    """For each two of three blocks: the flips, and the mask that keeps their bits."""
    blocks = [list(range(0, 21)), list(range(21, 42)), list(range(42, 64))]
    half = (2 * radius // 3 + 1) // 2
    return [(_balls(a + b, half), U(sum(1 << x for x in a + b))) for a, b in combinations(blocks, 2)]


def _emit(balls: list[tuple[np.ndarray, np.uint64]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fp").to_numpy().view(U)
            for i in range(0, len(fps), 2048):
                part = fps[i : i + 2048]
                for which, (flips, keep) in enumerate(balls):
                    keys = ((part & keep)[:, None] ^ flips[None, :]).ravel()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(keys), which, np.int8)), pa.array(keys.view(np.int64)), pa.array(np.repeat(part, len(flips)).view(np.int64))],
                        ["which", "key", "fp"],
                    )

    return run


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Fingerprints of a sorted partition with the number of their bucket, whole buckets at a time
    but for one that spans batches, which comes in parts under the same number."""
    held_fp, held_key, number = np.zeros(0, U), None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        fp = batch.column("fp").to_numpy().view(U)
        key = np.stack([batch.column("which").to_numpy().astype(np.int64), batch.column("key").to_numpy()])
        new = np.ones(len(fp), bool)
        new[1:] = (key[:, 1:] != key[:, :-1]).any(axis=0)
        if held_key is not None and (key[:, 0] == held_key).all():
            new[0] = False
        bucket = number + np.cumsum(new)
        yield fp, bucket
        number, held_key = int(bucket[-1]), key[:, -1].copy()


def _meet(radius: int, crowd: int):
    """Links inside buckets of up to ``crowd``; members of larger ones, linked to themselves."""

    def pairs(fp: np.ndarray, bucket: np.ndarray) -> Iterator[pa.RecordBatch]:
        start = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        size = np.diff(np.r_[start, len(fp)])
        large = np.repeat(size > crowd, size)
        left, right = [fp[large]], [fp[large]]
        for step in range(1, min(crowd, int(size.max()))):
            at = np.flatnonzero((bucket[step:] == bucket[:-step]) & ~large[step:])
            a, b = fp[at], fp[at + step]
            near = np.bitwise_count(a ^ b) <= radius
            left.append(np.minimum(a[near], b[near]))
            right.append(np.maximum(a[near], b[near]))
        both = np.unique(np.stack([np.concatenate(left), np.concatenate(right)]), axis=1)
        if both.shape[1]:
            yield pa.RecordBatch.from_arrays([pa.array(x.copy().view(np.int64)) for x in both], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fp, bucket = np.zeros(0, U), np.zeros(0, np.int64)
        for more, number in _runs(batches):
            fp, bucket = np.concatenate([fp, more]), np.concatenate([bucket, number])
            last = int(np.searchsorted(bucket, bucket[-1]))
            if last:
                yield from pairs(fp[:last], bucket[:last])
            fp, bucket = fp[last:], bucket[last:]
        if len(fp):
            yield from pairs(fp, bucket)

    return run


def _star(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first member of each bucket with each of the others."""
    centre, number = U(0), -1
    for fp, bucket in _runs(batches):
        start = np.flatnonzero(np.r_[bucket[0] != number, bucket[1:] != bucket[:-1]])
        heads = np.r_[centre, fp[start]]
        of = heads[np.searchsorted(start, np.arange(len(fp)), side="right")]
        both = np.unique(np.stack([of, fp])[:, of != fp], axis=1)
        if both.shape[1]:
            yield pa.RecordBatch.from_arrays([pa.array(x.copy().view(np.int64)) for x in both], ["a", "b"])
        centre, number = of[-1], bucket[-1]


def near_prints(fps: DataFrame, radius: int = RADIUS, crowd: int = CROWD) -> tuple[DataFrame, DataFrame]:
    """``(a, b)`` signed fingerprints within ``radius`` bits, but for pairs of crowded ones; ``(fp)`` those."""
    if radius not in (2, 4):
        raise ValueError("the blocks are laid out for a radius of 2 or 4 bits")
    fps = materialize(fps.select("fp").distinct(), "prints")
    # a print becomes 130 rows: as many tasks as keep each of them small
    tasks = max(fps.sparkSession.sparkContext.defaultParallelism, -(-fps.count() // PRINTS))
    variants = fps.repartition(tasks, "fp").mapInArrow(_emit(_blocks(radius)), "which tinyint, key long, fp long")
    met = materialize(
        variants.repartition("which", "key").sortWithinPartitions("which", "key").mapInArrow(_meet(radius, crowd), "a long, b long"), "met"
    )
    return met.where("a <> b").distinct(), met.where("a = b").select(F.col("a").alias("fp")).distinct()


def links(fps: DataFrame, radius: int = RADIUS, crowd: int = CROWD) -> DataFrame:
    """``(a, b)`` signed fingerprints within ``radius`` bits: pairs, or stars that connect the same."""
    near, crowded = near_prints(fps, radius, crowd)
    ball = [(_balls(list(range(64)), radius // 2), U(2**64 - 1))]
    full = crowded.mapInArrow(_emit(ball), "which tinyint, key long, fp long")
    # in one bucket of the full ball all are within the radius: a star links them
    star = full.repartition("key").sortWithinPartitions("which", "key", "fp").mapInArrow(_star, "a long, b long")
    return near.unionByName(star).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)``: the smallest node reachable, for every node of ``(a, b)``."""
    spark = edges.sparkSession
    edges = materialize(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    held = None
    while True:
        # large star: larger neighbours of a node go to the smallest of its neighbourhood
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low.hint("merge"), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: a node and its smaller neighbours go to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low.hint("merge"), "u")
        edges = materialize(
            small.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).where("u <> v").distinct(), "edges"
        )
        state = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if held == (state.n, state.h):
            break
        held = (state.n, state.h)
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def near_duplicates(
    docs: DataFrame, *keep: Column, radius: int = RADIUS, shingle: int = SHINGLE, crowd: int = CROWD, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``(doc_id, fp, component_id, root, *keep)`` a row; ``component_id`` is the smallest doc_id reachable and
    ``root`` the smallest fingerprint, which names the component also where rows share a doc_id."""
    found = materialize(fingerprints(docs, *keep, shingle=shingle, id_col=id_col, text_col=text_col), "fingerprints")
    first = F.min(F.coalesce("doc_id", F.lit(_SMALLEST))).alias("first")
    classes = materialize(found.groupBy("fp").agg(first), "classes")
    joined = components(links(classes, radius, crowd)).join(classes.withColumnRenamed("fp", "node"), "node")
    least = joined.groupBy("root").agg(F.min("first").alias("least"))
    moved = joined.join(least, "root").select(F.col("node").alias("fp"), "root", "least")
    of_class = classes.join(moved, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), F.coalesce("least", "first").alias("component_id"))
    component = F.nullif("component_id", F.lit(_SMALLEST)).alias("component_id")
    return found.join(of_class, "fp").select("doc_id", "fp", component, "root", *docs.select(*keep).columns)


def first_rows(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component, with the columns of ``docs``: that of the smallest doc_id, among rows of
    one doc_id that of the smallest hash of all columns. Rows alike in all columns are one."""
    whole = F.xxhash64(*(F.col(f"`{f.name}`") for f in docs.schema if not isinstance(f.dataType, MapType))).alias("_whole")
    found = near_duplicates(docs, whole, radius=radius, shingle=shingle, id_col=id_col, text_col=text_col)
    # a minimum a component, taken in part before the shuffle however many copies there are
    least = found.groupBy("root").agg(F.min(F.struct(F.coalesce("doc_id", F.lit(_SMALLEST)).alias("_doc"), "_whole")).alias("least"))
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_SMALLEST)).alias("_doc"), whole, row)
    return rows.join(least.select("least.*"), ["_doc", "_whole"], "left_semi").dropDuplicates(["_doc", "_whole"]).select("_row.*")


def hexadecimal(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))

"""Tests of membership in a large key set that move none of the rows tested.

A blocked Bloom filter over the keys: a key's hash picks one 64-bit word and a second one sets
``BITS`` bits in it. An aggregation ORs the words, which are broadcast in chunks. Its size is that of the
keys up to ``MAX_BYTES``, however many there are; beyond that more rows are hit falsely. A
row that is not hit is surely no member. Which of those that are hit are members is settled exactly, on their keys alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from joblark.operators.joins import skew_join
from joblark.session import counted, materialize

BITS = 4
BITS_A_KEY = 16
CHUNK_WORDS = 1024
MAX_BYTES = 64 << 20


@dataclass(frozen=True)
class Bloom:
    """``words``: ``(chunk, words)``, ``n_words`` in all."""

    words: DataFrame
    on: tuple[str, ...]
    n_words: int

    @property
    def n_bytes(self) -> int:
        return 8 * self.n_words

    @staticmethod
    def of(keys: DataFrame, on: tuple[str, ...], count: int, max_bytes: int = MAX_BYTES) -> Bloom:
        """A filter over ``count`` keys; keys with a null in them match nothing and are left out."""
        wanted = -(-count * BITS_A_KEY // 64)
        n_words = -(-max(1, min(wanted, max_bytes // 8)) // CHUNK_WORDS) * CHUNK_WORDS
        given = keys.dropna(subset=[*on]).select(_word(on, n_words).alias("word"), _mask(on).alias("mask"))
        empty = keys.sparkSession.range(n_words).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("mask"))
        ored = given.unionByName(empty).groupBy("word").agg(F.bit_or("mask").alias("mask"))
        chunk = ored.groupBy(F.expr(f"word div {CHUNK_WORDS}").alias("chunk")).agg(
            F.sort_array(F.collect_list(F.struct("word", "mask"))).alias("words")  # CHUNK_WORDS of them
        )
        return Bloom(materialize(chunk.select("chunk", F.col("words.mask").alias("words")), "bloom"), tuple(on), n_words)

    def flag(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` with whether each row may be a member; nulls are none."""
        word = _word(self.on, self.n_words)
        near = df.withColumn("_chunk", F.floor(word / CHUNK_WORDS).cast("long"))
        joined = near.join(F.broadcast(self.words.withColumnsRenamed({"chunk": "_chunk", "words": "_words"})), "_chunk", "left")
        mask = _mask(self.on)
        held = F.get("_words", (word % CHUNK_WORDS).cast("int")).bitwiseAND(mask) == mask
        whole = [F.col(c).isNotNull() for c in self.on]
        for c in whole:
            held = held & c
        return joined.withColumn(name, F.coalesce(held, F.lit(False))).drop("_chunk", "_words")


def _word(on: tuple[str, ...], n_words: int) -> Column:
    return F.pmod(F.xxhash64(*on), F.lit(n_words).cast("long"))


def _mask(on: tuple[str, ...]) -> Column:
    second = F.xxhash64(F.lit("mask"), *on)
    mask = F.lit(0).cast("long")
    for i in range(BITS):
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(second, 6 * i).bitwiseAND(F.lit(63).cast("long")).cast("int"))
        mask = mask.bitwiseOR(bit)
    return mask


def without_members(rows: DataFrame, keys: DataFrame, on: tuple[str, ...], count: int, limit: int, spread: list[str],
                    max_bytes: int = MAX_BYTES) -> DataFrame | None:
    """The ``rows`` whose key is none of ``count`` distinct ``keys``, by broadcasts only: of the keys themselves
    up to ``limit``, else of a filter over them and of the keys it hits falsely. None when these, too, exceed ``limit``.
    ``rows`` is read twice, the first time for its key columns."""
    if count <= limit:
        return rows.join(F.broadcast(keys.select(*on)), [*on], "left_anti")
    bloom = Bloom.of(keys, on, count, max_bytes)
    hit = bloom.flag(rows.select(*dict.fromkeys([*on, *spread])), "_hit").where("_hit").drop("_hit")
    false, count = counted(skew_join(hit, keys.select(*on), [*on], "left_anti", spread).select(*on).distinct(), "false_hits")
    if count > limit:
        return None
    flagged = bloom.flag(rows, "_hit").join(F.broadcast(false.withColumn("_false", F.lit(True))), [*on], "left")
    return flagged.where(~F.col("_hit") | F.col("_false")).drop("_hit", "_false")


def likely_members(rows: DataFrame, keys: DataFrame, on: tuple[str, ...], count: int, max_bytes: int = MAX_BYTES) -> DataFrame:
    """All ``rows`` whose key is one of ``keys``, and those that a filter over them hits falsely."""
    return Bloom.of(keys, on, count, max_bytes).flag(rows, "_hit").where("_hit").drop("_hit")

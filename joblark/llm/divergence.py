"""Source divergence audit: how far each source's terms are from those of the other sources of its language.

Terms are runs of ASCII letters and of all characters beyond ASCII, with A-Z in lower case. Per language the terms that
stand in at least ``min_docs`` of its documents are kept. With V kept terms, and N their occurrences in a group, a term with c
occurrences there has p = 1 + floor(SCALE * (c + 2) / (N + 2 * V)). Two of these, p and q, diverge by
floor((p - q)^2 / (p + q)).

Mappers fold whole documents into stripes, one a (language, term): in how many documents it stands,
and how often in each source. A mapper whose stripes exceed ``stripe_cells`` counts spills them as rows and begins anew. Rows of
one key meet by a shuffle and a sort, and are added up as they stream by, so no task holds
more than one stripe and a batch. The merged stripes, dealt into buckets by a hash of the
term, then emit divergences: each bucket gets the totals of its language's groups ahead
of its stripes. A task adds up what its buckets' terms contribute to each pair of sources, and keeps the ``top`` terms of each
group. What tasks emit is added up and ranked. Sources of a language beyond ``tile`` are compared tile by tile.

All numbers are exact: sums are 64-bit integers, and the scaled quotient is found by long
division, three digits a step, so that it holds for counts up to 2^53.

Null texts, languages and sources count as ''. Repeated rows count as often as they occur. A group without
terms, or in a language without kept terms, takes part like any other; with no kept term every pair's value is 0 and no
term is listed. Ties rank by the item's bytes. No rows, no result. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from joblark.operators.joins import sized_join
from joblark.session import materialize

SCALE = 1_000_000_000
MIN_DOCS = 10
TOP = 10
STRIPE_CELLS = 1 << 20
TERMS_A_BUCKET = 1 << 8
TILE = 256

_TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")  # bytes: all of a character beyond ASCII belong to a term
_ROWS_A_BATCH = 4096
_TERMS_AT_ONCE = 512

STRIPE = "lang string, term string, df long, sources array<string>, counts array<long>"


def terms_of(text: bytes) -> list[bytes]:
    return _TERM.findall(text.lower())  # of bytes, that is A-Z alone


# ---- stripes -----------------------------------------------------------------------


def _text(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary()).cast(pa.string())


def _stripe_batch(langs: pa.Array, terms: pa.Array, df: np.ndarray, stripe: np.ndarray, sources: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
    """Rows of stripes from their cells, which ``stripe`` numbers in ascending order."""
    ends = np.cumsum(np.bincount(stripe, minlength=len(df)), dtype=np.int32)
    ends = pa.array(np.concatenate([np.zeros(1, np.int32), ends]))
    return pa.RecordBatch.from_arrays(
        [langs, terms, pa.array(df, pa.int64()), pa.ListArray.from_arrays(ends, sources), pa.ListArray.from_arrays(ends, pa.array(counts, pa.int64()))],
        ["lang", "term", "df", "sources", "counts"],
    )


class Fold:
    """What a mapper has read since its last spill: in how many documents of a language each term
    stands, and how often in each source."""

    def __init__(self):
        self.df: dict[str, Counter] = {}
        self.counts: dict[str, dict[str, Counter]] = {}

    def add(self, lang: str, source: str, text: bytes) -> None:
        terms = terms_of(text)
        if lang not in self.df:
            self.df[lang], self.counts[lang] = Counter(), {}
        self.df[lang].update(set(terms))
        own = self.counts[lang]
        if source not in own:
            own[source] = Counter()
        own[source].update(terms)

    def cells(self) -> int:
        return sum(len(c) for own in self.counts.values() for c in own.values())

    def stripes(self) -> Iterator[pa.RecordBatch]:
        for lang, df in self.df.items():
            if not df:
                continue
            number = {term: i for i, term in enumerate(df)}
            own = self.counts[lang]
            at = np.concatenate([np.fromiter(map(number.__getitem__, c), np.int64, len(c)) for c in own.values()])
            counts = np.concatenate([np.fromiter(c.values(), np.int64, len(c)) for c in own.values()])
            source = np.repeat(np.arange(len(own)), [len(c) for c in own.values()])
            order = np.argsort(at, kind="stable")
            batch = _stripe_batch(
                pa.array([lang], pa.string()).take(pa.array(np.zeros(len(df), np.int32))), _text(list(df)), np.fromiter(df.values(), np.int64, len(df)),
                at[order], pa.array(list(own), pa.string()).take(pa.array(source[order])), counts[order],
            )
            for start in range(0, batch.num_rows, _ROWS_A_BATCH):
                yield batch.slice(start, _ROWS_A_BATCH)


def _changes(column: pa.Array) -> np.ndarray:
    """Whether each value but the first differs from the one before it."""
    return pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)


def added(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Sorted stripes with those of one key added up."""
    first = np.concatenate([[True], _changes(batch.column("lang")) | _changes(batch.column("term"))])
    at = np.flatnonzero(first)
    stripe = np.repeat(np.cumsum(first) - 1, pc.list_value_length(batch.column("sources")).to_numpy())
    sources = batch.column("sources").flatten().dictionary_encode()
    code = sources.indices.to_numpy()
    order = np.lexsort((code, stripe))
    stripe, code = stripe[order], code[order]
    cell = np.flatnonzero(np.concatenate([[True], (stripe[1:] != stripe[:-1]) | (code[1:] != code[:-1])])) if len(code) else code
    counts = batch.column("counts").flatten().to_numpy()[order]
    return _stripe_batch(
        batch.column("lang").take(pa.array(at)), batch.column("term").take(pa.array(at)), np.add.reduceat(batch.column("df").to_numpy(), at),
        stripe[cell], sources.dictionary.take(pa.array(code[cell])), np.add.reduceat(counts, cell) if len(cell) else counts,
    )


def stripes(docs: DataFrame, stripe_cells: int = STRIPE_CELLS, min_docs: int = 1) -> DataFrame:
    """Merged stripes ``(lang, term, df, sources, counts)`` of ``docs`` ``(lang, source, text)``."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, unseen = Fold(), 0
        for batch in batches:
            langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
            for lang, source, text in zip(langs, sources, batch.column("text")):
                text = text.as_buffer().to_pybytes()
                held.add(lang, source, text)
                unseen += len(text) // 2  # no text has more terms
                if unseen >= stripe_cells:
                    if held.cells() >= stripe_cells:
                        yield from held.stripes()
                        held = Fold()
                    unseen = 0
        yield from held.stripes()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the last stripe of a batch may go on in the next one
        last = None
        for batch in batches:
            if batch.num_rows:
                if last is not None:
                    batch = pa.concat_batches([last, batch])
                whole = added(batch)
                last = whole.slice(whole.num_rows - 1)
                done = whole.slice(0, whole.num_rows - 1)
                yield done.filter(pc.greater_equal(done.column("df"), min_docs))
        if last is not None:
            yield last.filter(pc.greater_equal(last.column("df"), min_docs))

    mapped = docs.select("lang", "source", "text").mapInArrow(fold, STRIPE)
    return mapped.repartition("lang", "term").sortWithinPartitions("lang", "term").mapInArrow(merge, STRIPE)


# ---- divergences -------------------------------------------------------------------


def scaled(counts: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * (counts + 2) / whole), without going beyond 64 bits."""
    out, rest = np.divmod(counts + 2, whole)
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, whole)
        out = out * 1000 + digits
    return out + 1


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


_EMITTED = "lang string, source string, part string, item string, value long"


class Share:
    """What the terms of a task contribute to a tile of source pairs of one language."""

    def __init__(self, lang: str, rows: bool, top: int):
        self.lang, self.with_terms, self.top = lang, rows, top
        self.names: list[list[str]] = [[], []]  # the tile's sources, across and down
        self.totals: list[list[int]] = [[], []]
        self.lang_total = self.n_terms = 0
        self.sums: np.ndarray | None = None
        self.best: dict[int, list[tuple[int, str]]] = {}

    def add(self, terms: pa.Array, sources: pa.ListArray, counts: pa.ListArray) -> None:
        row = np.repeat(np.arange(len(terms)), pc.list_value_length(sources).to_numpy())
        found, own = sources.flatten().dictionary_encode(), counts.flatten().to_numpy()
        sides = []
        for names, totals in zip(self.names, self.totals):
            at = {s: i for i, s in enumerate(names)}
            place = np.array([at.get(s, -1) for s in found.dictionary.to_pylist()], np.int64)[found.indices.to_numpy()]
            matrix = np.zeros((len(terms), len(names)), np.int64)
            matrix[row[place >= 0], place[place >= 0]] = own[place >= 0]
            sides.append((matrix, scaled(matrix, np.array(totals, np.int64) + 2 * self.n_terms)))
        (mine, p), (_, q) = sides
        if self.sums is None:
            self.sums = np.zeros((p.shape[1], q.shape[1]), np.int64)
        for i in range(p.shape[1]):
            self.sums[i] += divergence(p[:, i : i + 1], q).sum(axis=0)
        if self.with_terms:
            whole = np.zeros(len(terms), np.int64)
            np.add.at(whole, row, own)
            q = scaled(whole, np.int64(self.lang_total + 2 * self.n_terms))
            for i in range(p.shape[1]):
                more = np.flatnonzero((mine[:, i] > 0) & (p[:, i] > q))
                value = divergence(p[more, i], q[more])
                if len(value) > self.top:  # ties with the last one that counts stay
                    least = np.partition(value, -self.top)[-self.top]
                    more, value = more[value >= least], value[value >= least]
                # Python compares texts by code point, which is the order of their UTF-8 bytes
                best = [*self.best.get(i, []), *zip((-value).tolist(), terms.take(pa.array(more)).to_pylist())]
                self.best[i] = sorted(best)[: self.top]

    def rows(self) -> list[tuple]:
        out = []
        if self.sums is not None:
            a, b = self.names
            out += [(self.lang, a[i], "pair", b[j], int(v)) for i, row in enumerate(self.sums) for j, v in enumerate(row) if a[i] != b[j]]
        return out + [(self.lang, self.names[0][i], "term", term, -v) for i, best in self.best.items() for v, term in best]


def contributions(kept: DataFrame, totals: DataFrame, top: int, tile: int, terms_a_bucket: int) -> DataFrame:
    """``(lang, source, part, item, value)``, to be added up over buckets for pairs, from kept stripes
    and ``totals`` ``(lang, source, n, n_terms, lang_n, at)``; ``at`` numbers the sources of a language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emitted(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
            for at in range(0, len(rows), _ROWS_A_BATCH):
                columns = zip(*rows[at : at + _ROWS_A_BATCH])
                kinds = [pa.string()] * 4 + [pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["lang", "source", "part", "item", "value"])

        # buckets of one language and tile follow each other, and add to the same sums
        key, share, first = None, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            lang, source, terms = batch.column("lang"), batch.column("source"), batch.column("term")
            across, down, bucket, kind = (batch.column(c).to_numpy() for c in ("across", "down", "bucket", "kind"))
            runs = _changes(lang) | np.any([c[1:] != c[:-1] for c in (across, down, bucket, kind)], axis=0)
            edges = [0, *(np.flatnonzero(runs) + 1).tolist(), batch.num_rows]
            for a, b in zip(edges, edges[1:]):
                now = (lang[a].as_py(), across[a], down[a])
                if now != key:
                    if share is not None:
                        yield from emitted(share.rows())
                    key, first, share = now, bucket[a], Share(now[0], now[2] == 0, top)
                if kind[a] == 2:
                    for at in range(a, b, _TERMS_AT_ONCE):
                        n = min(_TERMS_AT_ONCE, b - at)
                        share.add(terms.slice(at, n), batch.column("sources").slice(at, n), batch.column("counts").slice(at, n))
                elif bucket[a] == first:
                    share.names[kind[a]] += source.slice(a, b - a).to_pylist()
                    share.totals[kind[a]] += batch.column("n").slice(a, b - a).to_pylist()
                    share.lang_total, share.n_terms = batch.column("lang_n")[a].as_py(), batch.column("n_terms")[a].as_py()
        if share is not None:
            yield from emitted(share.rows())

    tiles = totals.groupBy("lang").agg(F.max(F.expr(f"at div {tile}")).alias("tiles"), F.max("n_terms").alias("_terms")).where("_terms > 0")
    tiles = tiles.withColumn("buckets", F.expr(f"_terms div {terms_a_bucket}"))
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles")))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("buckets")))
    place = totals.withColumn("tile", F.expr(f"at div {tile}"))
    blank = {c: F.lit(None) for c in ("term", "sources", "counts")}
    heads = [
        place.join(tiles, "lang").withColumn(mine, F.col("tile")).withColumn(other, each).withColumn("bucket", every).select(
            "lang", "across", "down", "bucket", F.lit(kind).alias("kind"), "source", "n", "lang_n", "n_terms",
            *(v.cast(t).alias(c) for (c, v), t in zip(blank.items(), ("string", "array<string>", "array<long>"))),
        )
        for kind, (mine, other) in enumerate((("across", "down"), ("down", "across")))
    ]
    none = F.lit(None).cast("long")
    body = sized_join(kept, tiles, ["lang"], "left", ["term"]).withColumn("across", each).withColumn("down", each).select(
        "lang", "across", "down", F.pmod(F.xxhash64("term"), F.col("buckets") + 1).alias("bucket"), F.lit(2).alias("kind"),
        F.lit(None).cast("string").alias("source"), none.alias("n"), none.alias("lang_n"), none.alias("n_terms"), "term", "sources", "counts",
    )
    keys = ["lang", "across", "down", "bucket"]
    dealt = heads[0].unionByName(heads[1]).unionByName(body).repartition(*keys).sortWithinPartitions(*keys, "kind", "source")
    return dealt.mapInArrow(run, _EMITTED)


def source_divergence(
    docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
    stripe_cells: int = STRIPE_CELLS, tile: int = TILE, terms_a_bucket: int = TERMS_A_BUCKET,
) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: part ``pair`` for each other source of the language,
    part ``term`` for the terms a source has more of than its language."""

    def named(name: str) -> Column:
        return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))

    docs = docs.select(named(lang_col).alias("lang"), named(source_col).alias("source"), named(text_col).alias("text"))
    kept = materialize(stripes(docs, stripe_cells, min_docs), "stripes")
    cells = kept.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("c")).groupBy("lang", F.col("c.sources").alias("source")).agg(F.sum("c.counts").alias("n"))
    groups = docs.select("lang", "source").distinct().join(cells, ["lang", "source"], "left")
    n_terms = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("n_terms"))
    by_lang = Window.partitionBy("lang")  # one row a source
    totals = materialize(
        groups.join(n_terms, "lang", "left").select(
            "lang", "source", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("n_terms", F.lit(0)).alias("n_terms"),
            F.sum(F.coalesce("n", F.lit(0))).over(by_lang).alias("lang_n"), (F.row_number().over(by_lang.orderBy("source")) - 1).alias("at"),
        ),
        "totals",
    )
    found = contributions(kept, totals, top, tile, terms_a_bucket)
    whole = found.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))  # a term is in one bucket
    # no kept term: nothing was compared, and all pairs are alike
    wordless = totals.where("n_terms = 0").select("lang", "source")
    alike = wordless.join(wordless.withColumnRenamed("source", "item"), "lang").where("source <> item").select(
        "lang", "source", F.lit("pair").alias("part"), "item", F.lit(0).cast("long").alias("value")
    )
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    ranked = whole.unionByName(alike).withColumn("rank", rank)
    return ranked.where((F.col("part") == "pair") | (F.col("rank") <= top))

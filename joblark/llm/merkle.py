"""Merkle manifest of a dataset: a tree of digests a group of rows, and one over the groups' roots.

A leaf is the SHA-256 of a row's fields (see ``encoded``); a parent is that of its children's digests
as lower-case hex, put one after the other. Leaves of a group ascend by their order column. While a
group has several nodes, every ``arity`` consecutive ones, the last run maybe fewer or one, get a parent. The node that is
left is the group's root. The group roots, by group (null first, else by bytes), make a tree in the same way.

Every level is one table of narrow rows ``(g, size, i, digest)``. A node at place i sits in slot i % arity of its run. For each of
the arity - 1 shifts one equijoin on (g, i of the sibling) brings a sibling's digest: for binary
trees that place is i XOR 1, else the slot is moved on by the shift and wraps. The rows of slot zero, which then know
their run, emit the parents. Places are unique, so no key of these joins is hot, whatever the share of a group.

Leaves are numbered without a window over a group: rows are sorted by range over all tasks, and a
row's place is its place in its task's share of the group plus the shares before.

A path goes from a node up to the root: per level the digests of the siblings before and after the
node. Paths are handed down from the top, one join a level. Folding a leaf along its path gives the root, and another root
if the leaf differs.

Null order values come first. Rows that tie in it are ordered by their leaf; rows that tie in both are the same
row, and each takes a place. A group of one row has its leaf as its root, and a single group its root as the
whole root. No rows, no leaves. Columns that are not named are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from joblark.session import materialize

ARITY = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    """SHA-256, as 32 bytes, of texts put one after the other."""
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def hexadecimal(c: Column) -> Column:
    return F.lower(F.hex(c))


def encoded(value: Column) -> Column:
    """A field as text: ``-`` if null, else its size in UTF-8 bytes, a colon and itself."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: dict[str, Column] | tuple[str, ...] = FIELDS, **changed: Column) -> Column:
    """The leaf of a row, some of its fields ``changed``."""
    return digest(*(encoded(changed.get(name, F.col(f"`{name}`"))) for name in fields))


def group_key(group: Column) -> Column:
    """Not null, and in the order of the groups: null first, else by bytes."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


# ---- places ------------------------------------------------------------------------


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with the ``size`` of their group ``g`` and their place ``i`` in it, from 0.

    ``rows`` has to be a written table: its bounds are sampled before it is sorted.
    """
    placed = materialize(
        rows.repartitionByRange("g", *order).sortWithinPartitions("g", *order).withColumns(
            {"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}
        ),
        "placed",
    )
    # one row a task and group in it
    before = Window.partitionBy("g").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shares = placed.groupBy("g", "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n")).select(
        "g", "_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"),
        F.sum("_n").over(Window.partitionBy("g")).alias("size"),
    )
    return placed.join(shares, ["g", "_part"]).withColumn("i", F.col("_at") - F.col("_first") + F.col("_shift")).drop("_part", "_at", "_first", "_shift")


# ---- levels ------------------------------------------------------------------------


def with_siblings(level: DataFrame, arity: int = ARITY) -> DataFrame:
    """A level's nodes with ``before`` and ``after``: the digests of their siblings, in order."""
    slot = F.col("i") % arity
    shifts = range(1, arity)
    joined = level
    for shift in shifts:
        place = F.col("i").bitwiseXOR(F.lit(1).cast("long")) if arity == 2 else F.col("i") - slot + (slot + shift) % arity
        sibling = level.select("g", F.col("i").alias(f"_i{shift}"), F.col("digest").alias(f"_d{shift}"))
        joined = joined.withColumn(f"_i{shift}", place).join(sibling, ["g", f"_i{shift}"], "left")
    # the sibling of a shift stands after the node unless its slot has wrapped
    wraps = [slot + shift >= arity for shift in shifts]
    digests = [F.col(f"_d{shift}") for shift in shifts]
    # by slot: those that wrapped come first, from slot zero on
    before = F.array(*(F.when(w, d) for w, d in zip(wraps, digests)))
    after = F.array(*(F.when(~w, d) for w, d in zip(wraps, digests)))
    return joined.select(*level.columns, F.array_compact(before).alias("before"), F.array_compact(after).alias("after"))


def _joined_hex(digests: Column) -> Column:
    return F.array_join(F.transform(digests, hexadecimal), "")


def parents(level: DataFrame, arity: int = ARITY) -> DataFrame:
    """The next level, from the slot-zero rows of one with siblings."""
    return level.where(F.col("i") % arity == 0).select(
        "g", F.expr(f"(size + {arity - 1}) div {arity}").alias("size"), F.expr(f"i div {arity}").alias("i"),
        digest(hexadecimal(F.col("digest")), _joined_hex(F.col("after"))).alias("digest"),
    )


def grow(leaves: DataFrame, arity: int = ARITY) -> tuple[list[DataFrame], DataFrame]:
    """The levels of every group's tree up from its leaves ``(g, size, i, digest, ...)``, each with
    siblings, and the groups' roots ``(g, digest)``. Groups of one leaf are in no level."""
    levels, roots = [], leaves.where("size = 1").select("g", "digest")
    height = leaves.agg(F.max("size").alias("n")).first()["n"] or 0
    nodes = leaves.where("size > 1")
    while height > 1:
        level = materialize(with_siblings(nodes, arity), "level")
        levels.append(level)
        roots = roots.unionByName(parents(level.where(F.col("size") <= arity), arity).select("g", "digest"))
        nodes = parents(level.where(F.col("size") > arity), arity)
        height = -(-height // arity)
    return levels, roots


PATH = "array<struct<before:array<binary>,after:array<binary>>>"


def hand_down(levels: list[DataFrame], tops: DataFrame, arity: int = ARITY) -> DataFrame:
    """The lowest level's own columns with the ``path`` of each node, given ``tops``
    ``(g, path, ...)`` of the trees' roots, whose other columns come along."""
    step = F.array(F.struct("before", "after"))
    tops = tops.withColumnRenamed("path", "_path")
    kept = [c for c in tops.columns if c not in ("g", "_path")]
    lowest = [c for c in levels[0].columns if c not in ("before", "after")]
    above = None
    for level in reversed(levels):
        own = [c for c in (lowest if level is levels[0] else ("g", "i"))]
        columns = [*own, F.concat(step, "_path").alias("path"), *kept]
        # the parent of a run is its tree's root when the run is the whole level
        paths = level.where(F.col("size") <= arity).join(tops, "g").select(*columns)
        if above is not None:
            upper = above.select("g", F.col("i").alias("_p"), F.col("path").alias("_path"), *kept)
            rest = level.where(F.col("size") > arity).withColumn("_p", F.expr(f"i div {arity}"))
            paths = paths.unionByName(rest.join(upper, ["g", "_p"]).select(*columns))
        # the paths of the lowest level, the longest and the most, are not written
        above = paths if level is levels[0] else materialize(paths, "paths")
    return above


def fold(start: Column, path: Column) -> Column:
    """The root that a digest leads to along a path."""
    return F.aggregate(path, start, lambda own, at: digest(_joined_hex(at["before"]), hexadecimal(own), _joined_hex(at["after"])))


def proof_text(path: Column) -> Column:
    """The siblings of a path as hex, level by level, each level from left to right."""
    return F.array_join(F.transform(path, lambda at: F.concat(_joined_hex(at["before"]), _joined_hex(at["after"]))), "")


def manifest(
    rows: DataFrame, group: str = "source", order: str = "doc_id", fields: tuple[str, ...] = FIELDS, arity: int = ARITY,
    kept: dict[str, Column] | None = None,
) -> DataFrame:
    """``(g, i, digest, order value, *kept, path, subroot, root)`` a row; ``kept`` are narrow columns to hand on,
    computed from the row in the same scan. Digests are binary, ``path`` is a ``PATH``."""
    if arity < 2:
        raise ValueError("a run has at least two nodes")
    kept = kept or {}
    named = {"g": group_key(F.col(f"`{group}`")), "at": F.col(f"`{order}`"), "digest": leaf(fields)}
    if clash := kept.keys() & {*named, "i", "size", "path", "subroot", "root"}:
        raise ValueError(f"names of the manifest's own columns: {sorted(clash)}")
    narrow = materialize(rows.select(*(c.alias(n) for n, c in (named | kept).items())), "leaves")
    leaves = materialize(numbered(narrow, ["at", "digest"]), "numbered")
    levels, roots = grow(leaves, arity)
    # the groups' roots are the leaves of the upper tree
    subroots = materialize(roots.select(F.lit("").alias("g"), F.col("g").alias("at"), "digest"), "subroots")
    upper_leaves = materialize(numbered(subroots, ["at"]), "upper_leaves")
    upper, root = grow(upper_leaves, arity)
    top = root.select("g", F.array().cast(PATH).alias("path"), F.col("digest").alias("root"))
    placed = hand_down(upper, top, arity) if upper else upper_leaves.join(top, "g")
    of_group = materialize(placed.select(F.col("at").alias("g"), "path", F.col("digest").alias("subroot"), "root"), "group_paths")
    # a group of one row has its leaf as its root
    found = leaves.where("size = 1").join(of_group, "g")
    if levels:
        found = found.unionByName(hand_down(levels, of_group, arity))
    return found.select("g", "i", "at", "digest", *kept, "path", "subroot", "root")

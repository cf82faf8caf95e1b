import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from joblark.llm import merkle


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(nodes, arity):
    """The root, and per leaf its siblings' digests before and after, level by level."""
    paths = [[] for _ in nodes]
    level, at = list(nodes), list(range(len(nodes)))
    while len(level) > 1:
        for leaf, i in enumerate(at):
            p = i - i % arity
            paths[leaf].append((level[p:i], level[i + 1 : p + arity]))
        level = [sha("".join(level[p : p + arity])) for p in range(0, len(level), arity)]
        at = [i // arity for i in at]
    return level[0], paths


def expected(rows, arity):
    """``(doc_id, leaf, subroot, root, siblings)`` of every row."""
    groups = defaultdict(list)
    for row in rows:
        groups[row[1]].append((row[0], sha("".join(map(field, row)))))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    built = {}
    for name in names:
        own = sorted(groups[name], key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        built[name] = (own, *tree([leaf for _, leaf in own], arity))
    root, upper = tree([built[n][1] for n in names], arity)
    out = []
    for name, above in zip(names, upper):
        own, subroot, paths = built[name]
        out += [(d, leaf, subroot, root, path + above) for (d, leaf), path in zip(own, paths)]
    return out


def found(df, arity):
    got = merkle.manifest(df, arity=arity, kept={"doc_id": F.col("doc_id")})
    got = got.withColumn("folded", merkle.fold(F.col("digest"), F.col("path"))).withColumn("proof", merkle.proof_text(F.col("path")))
    return sorted(
        (str(r.doc_id), r.digest.hex(), r.subroot.hex(), r.root.hex(), r.proof, r.folded.hex(), [([d.hex() for d in p.before], [d.hex() for d in p.after]) for p in r.path])
        for r in got.collect()
    )


def rows_of(sizes, seed=0):
    rng = random.Random(seed)
    rows = [(i, s, rng.choice(["en", None]), rng.choice([None, i]), rng.choice([None, "", "é\n|:" * rng.randint(1, 4)])) for s, n in sizes.items() for i in range(n)]
    rng.shuffle(rows)
    return rows


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


@pytest.mark.parametrize("arity", [2, 3, 5])
@pytest.mark.parametrize("sizes", [{None: 10, "b": 1, "": 28, "é": 3, "a": 2, "Z": 9}, {"one": 40}, {"x": 1}])
def test_manifest(spark, sizes, arity):
    rows = rows_of(sizes)
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"size": F.lit(1), "path": F.lit("x"), "digest": F.lit(2)}).repartition(5)
    want = sorted((str(d), leaf, sub, root, "".join("".join(b + a) for b, a in path), root, path) for d, leaf, sub, root, path in expected(rows, arity))
    assert found(df, arity) == want


def test_null_and_repeated_ids(spark):
    rows = [(None, "s", "en", 1, "t")] * 3 + [(None, "s", "en", 1, "u"), (5, "s", "en", 1, "t"), (5, "s", "en", 1, "t"), (5, "s", None, 1, "t"), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = sorted((str(d), leaf, sub, root, "".join("".join(b + a) for b, a in path), root, path) for d, leaf, sub, root, path in expected(rows, 3))
    assert found(df, 3) == want


def test_a_changed_row_leads_to_another_root(spark):
    rows = rows_of({"a": 20, "b": 4})
    df = spark.createDataFrame(rows, SCHEMA)
    got = merkle.manifest(df, kept={"other": merkle.leaf(text=F.concat("text", F.lit("!")))})
    ends = got.select("root", merkle.fold(F.col("other"), F.col("path")).alias("end"), (F.col("other") == F.col("digest")).alias("same")).collect()
    assert {r.same for r in ends} == {True, False, None} - {None}
    assert all((r.end == r.root) == r.same for r in ends)


def test_empty_table_and_names(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert merkle.manifest(df).count() == 0
    with pytest.raises(ValueError):
        merkle.manifest(df, arity=1)
    with pytest.raises(ValueError):
        merkle.manifest(df, kept={"root": F.lit(1)})


def test_places_do_not_depend_on_tasks(spark):
    df = spark.range(1000).select(F.lit("g").alias("g"), (F.col("id") * 7919 % 1000).alias("at"))
    got = {r["at"]: (r["i"], r["size"]) for r in merkle.numbered(df, ["at"]).collect()}
    assert got == {n: (n, 1000) for n in range(1000)}

import random

import pytest
from pyspark.sql import functions as F

from joblark.llm import toxicity as tx

DATA = "/root/testdata/sf0.1"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_trie_against_distances():
    rng = random.Random(1)
    terms = ["trash", "idiot", "abc", "worthless", "disgusting", "aaaaa", "ababababa", "straß", "stupid"]
    trie = tx.Trie(terms)
    words = {""}
    for t in terms:
        for _ in range(400):
            w = list(t)
            for _ in range(rng.randint(0, 3)):
                at = rng.randint(0, len(w))
                kind = rng.random()
                if kind < 0.4:
                    w.insert(at, rng.choice("abstß"))
                elif w and kind < 0.7:
                    w.pop(min(at, len(w) - 1))
                elif w:
                    w[min(at, len(w) - 1)] = rng.choice("abstß")
            words.add("".join(w))
    for w in words:
        want = sorted(((t, distance(w, t)) for t in terms if 0 < tx.edits(len(t)) and distance(w, t) <= tx.edits(len(t))), key=lambda m: (m[1], m[0]))
        assert trie.matches(w) == want
        assert trie.may_match(w) or not want


def test_context_and_places():
    lexicon = tx.Lexicon({"idiot": 6.0, "vequ*": 5.0}, ("idiot",), frozenset({"idiom"}), -2.0, (2.0, 1.0, 1.0, 1.0, 0.1, 0.0, 0.0))
    text = "İ you IDIOT! She said \"such an idiot, really\" vequx idyot idiom"
    found, n = lexicon.find(text)
    assert [(text[m["start"] : m["end"]], m["how"], m["quoted"]) for m in found] == [
        ("IDIOT", "exact", False), ("idiot", "exact", True), ("vequx", "stem", False), ("idyot", "edit1", False),
    ]
    assert n == 12
    plain, quoted = (lexicon.score(lexicon.features(*lexicon.find(t))) for t in ("an idiot he said", "an \"idiot\" he said"))
    assert plain > quoted


def test_held_out(spark):
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    known = labels.select("doc_id", F.col("toxic").alias("label"))
    lexicon = tx.fit(docs.where(~held), known.where(~held))
    rows = tx.toxicity(docs.join(known, "doc_id").where(held), lexicon, F.col("label")).collect()
    hits = [r for r in rows if r.score >= 0.7]
    assert sum(r.label for r in hits) / len(hits) > 0.95
    assert sum(r.label for r in hits) / sum(r.label for r in rows) > 0.8


@pytest.mark.parametrize("labels", [[], [(1, 1)], [(1, 0), (2, 1), (2, None), (None, 1), (2, 1)]])
def test_odd_rows(spark, labels):
    rows = [(1, "a b c"), (2, None), (2, ""), (None, "idiot"), (3, "x" * 40_000), (3, "x y " * 30_000), (3, "x y " * 30_000)]
    df = spark.createDataFrame([(*r, 1.0, "x") for r in rows], "doc_id long, text string, score double, matches string")
    known = spark.createDataFrame(labels, "doc_id long, label int")
    got = tx.toxicity(df, tx.fit(df, known)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert tx.toxicity(df.limit(0), tx.fit(df.limit(0), known)).count() == 0

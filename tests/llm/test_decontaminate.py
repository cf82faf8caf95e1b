import random
import re

import pytest
from pyspark.sql import functions as F

from joblark.llm.decontaminate import contamination


def norm(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(docs, items, length):
    out = []
    for doc, text in docs:
        words, hit, names = norm(text), set(), set()
        for item, body in items:
            w = norm(body)
            for i in range(max(1, len(w) - length + 1) if w else 0):
                window = w[i : i + length]
                for p in range(len(words) - len(window) + 1):
                    if words[p : p + len(window)] == window:
                        hit.update(range(p, p + len(window)))
                        names.add("" if item is None else str(item))
        out.append((doc, len(words), len(hit), sorted(names)))
    return sorted(out, key=str)


@pytest.mark.parametrize("block_words", [200_000, 25])
def test_against_brute_force(spark, block_words):
    rng = random.Random(4)
    words = ["a", "É", "b2", "Haus", "the", "日本", "x"]

    def text(n):
        return "".join(rng.choice(words) + rng.choice([" ", ", ", "\n", "--", "_"]) for _ in range(n))

    items = [(i, text(rng.randint(1, 12))) for i in range(12)] + [(50, None), (51, "?!"), (None, text(6)), (3, text(7))]
    docs = [(i, text(rng.randint(0, 60)) + (rng.choice(items)[1] or "").upper() + text(5)) for i in range(60)]
    docs += [(90, None), (91, ""), (None, items[2][1]), (4, docs[4][1])]
    df = spark.createDataFrame([(*d, 0, "x", "y") for d in docs], "doc_id long, text string, n_words int, item_id string, tag string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = contamination(df, bench, length=4, block_words=block_words).collect()
    got = sorted(((r.doc_id, r.n_words, sum(s.end - s.start for s in r.runs), r.items) for r in rows), key=str)
    assert got == brute(docs, items, 4)
    of = {}
    for doc, body in docs:
        of.setdefault(doc, body)
    for r in rows:
        words = norm(of[r.doc_id])
        for run, span in zip(r.runs, r.spans, strict=True):
            assert norm(of[r.doc_id][span.start : span.end]) == words[run.start : run.end]
    assert contamination(df.limit(0), bench).count() == 0
    assert {len(r.items) for r in contamination(df, bench.limit(0)).collect()} == {0}


def test_blocks_keep_the_columns_of_rows_with_one_text(spark):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(60)]
    items = [(str(i), "-".join(rng.choice(words) for _ in range(rng.randint(1, 14)))) for i in range(25)]
    rows = []
    for i in range(60):
        text = " ".join([*(rng.choice(words) for _ in range(rng.randint(0, 30))), *rng.choice(items)[1].split("-"), "end"])
        rows += [(i, text, "en", i), (i, text, "de", i), (i, text.upper(), "fr", i), (None, text, None, i)]
    rows += [(7, None, "en", 1), (None, "", "de", 2), rows[0]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, tag int").repartition(3)
    tests = spark.createDataFrame(items, "item_id string, text string")
    one, many = ([tuple(map(str, r)) for r in contamination(docs, tests, F.col("lang"), F.col("tag").alias("_tag"), block_words=n).collect()] for n in (10**6, 20))
    assert sorted(one) == sorted(many) and len(one) == len(rows)
    assert sum("start" in r[2] for r in one) > 100

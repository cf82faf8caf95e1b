"""The pipeline against its stages by brute force on a small fixture."""

import random
import re

import corpus_pipeline
from joblark.llm import bpe
from tests.llm.test_decontaminate import brute as brute_decontaminate
from tests.llm.test_repeats import brute_words
from tests.llm.test_simhash import brute_components, brute_print


def fixture(path, spark):
    rng = random.Random(1)
    words = [a + b + c for a in "bdfgk" for b in ("a", "o", "ei", "u") for c in ("l", "n", "rt", "s", "", "m")]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage, item = text(60), text(14)
    rows, labels = [], []
    for i in range(160):
        kind = i % 8
        body = text(rng.randint(30, 90))
        if kind == 1:
            body = " ".join(w + rng.choice(["###", "%%%", "$$$"]) for w in body.split())
        elif kind == 2 and i > 8:
            body = rows[i - 8][1] if rng.random() < 0.5 else rows[i - 8][1] + " " + rng.choice(words)
        elif kind == 3:
            body = body + "\n" + passage + "\n" + text(20)
        elif kind == 4 and i % 3 == 0:
            body = text(15) + ", " + item.upper() + ". " + text(15)
        elif kind == 5 and i % 5 == 0:
            body = passage
        rows.append((i, body, "en", "s", len(body)))
        labels.append((i, 0 if kind == 1 else 1, 0))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item), (2, text(5) + " zzz")], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return rows, [(1, item)]


def test_pipeline(spark, tmp_path):
    rows, items = fixture(tmp_path, spark)
    got = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}

    kept = [(d, t) for d, t, *_ in rows if "###" not in t and "%%%" not in t and "$$$" not in t]
    root = brute_components([brute_print(t) for _, t in kept])
    kept = [r for i, r in enumerate(kept) if root[i] == i]
    left = {d: w.decode() for (d, _), w in brute_words(kept, 35).items()}
    kept = [(d, t) for d, t in kept if left[d]]
    clean = {d for d, _, hit, _ in brute_decontaminate([(d, left[d]) for d, _ in kept], items, 10) if not hit}
    assert set(got) == clean and 60 < len(clean) < 140
    code = bpe.codec(bpe.VOCABULARY)
    for doc in clean:
        assert re.findall(r"[^\x20\x09-\x0D]+", code.decode(got[doc])) == left[doc].split()


def test_stages_keep_the_columns(spark, tmp_path):
    rows, _ = fixture(tmp_path, spark)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet").withColumnsRenamed({"source": "score"})
    odd = spark.createDataFrame([(None, "a b", "en", "s", 3), (500, None, "en", "s", 0), (501, "", None, None, None), (3, rows[3][1], "en", "s", 1)], docs.schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs.unionByName(odd), str(tmp_path))
        assert out.schema.names == docs.schema.names, name
        assert out.count() > 0
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0


def test_near_dedup_keeps_other_texts_under_the_id_of_a_copy(spark):
    one, other = "the first text of this test", "quite another text that has no copy"
    rows = [(1, one), (5, one), (5, other), (None, other.upper()), (None, one + " and more words than before")]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.near_dedup(spark, docs, "")
    assert {(r.doc_id, r.text) for r in got.collect()} == {(1, one), (None, rows[3][1]), (None, rows[4][1])}

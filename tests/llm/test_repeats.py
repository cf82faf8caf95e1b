"""Both repeat removers against brute force over every window."""

import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from joblark.llm import repeats, substring_dedup, suffix_dedup


def brute_bytes(rows, length):
    docs = sorted({(d if d is not None else -(2**63), (t or "").encode()) for d, t in rows})
    seen, out = set(), {}
    for doc, body in docs:
        cut = set()
        for i in range(len(body) - length + 1):
            window = body[i : i + length]
            if window in seen:
                cut.update(range(i, i + length))
            seen.add(window)
        out[doc, body] = bytes(b for i, b in enumerate(body) if i not in cut)
    return out


def brute_words(rows, length):
    docs = sorted({(d if d is not None else -(2**63), (t or "").encode()) for d, t in rows})
    count = {}
    for _, body in docs:
        words = body.split()
        for i in range(len(words) - length + 1):
            w = tuple(words[i : i + length])
            count[w] = count.get(w, 0) + 1
    out = {}
    for doc, body in docs:
        words = body.split()
        cut = set()
        for i in range(len(words) - length + 1):
            if count[tuple(words[i : i + length])] > 1:
                cut.update(range(i, i + length))
        out[doc, body] = b" ".join(w for i, w in enumerate(words) if i not in cut)
    return out


def corpus(seed, letters="ab é", docs=40, size=200):
    rng = random.Random(seed)
    blocks = ["".join(rng.choice(letters) for _ in range(rng.randint(5, 60))) for _ in range(12)]
    rows = []
    for i in range(docs):
        text = "".join(rng.choice(blocks) if rng.random() < 0.5 else "".join(rng.choice("abcdefg hij\n\t") for _ in range(rng.randint(1, size // 4))) for _ in range(rng.randint(0, 8)))
        rows.append((i * 3, text))
    rows += [(1000 + i, rows[5][1]) for i in range(20)]
    rows += [(2000, None), (2001, ""), (2002, "ab " * 200), (2003, "x" * 500), (None, rows[6][1]), (2002, "ab " * 200), (2002, "ab " * 150)]
    rng.shuffle(rows)
    return rows


def expected_order(rows):
    ids = [d for d, _ in rows]
    return len(set(ids)) == len(ids)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("partitions", [1, 5])
def test_bytes(spark, seed, partitions):
    rows = [r for r in corpus(seed) if r[0] != 2002] + [(2002, "ab " * 200)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(partitions)
    got = suffix_dedup.suffix_dedup(df, length=20, gram=8).collect()
    want = brute_bytes(rows, 20)
    assert len(got) == len(rows)
    texts = {}
    for d, t in rows:
        texts.setdefault(d, (t or "").encode())
    for r in got:
        doc = r.doc_id if r.doc_id is not None else -(2**63)
        body = texts[r.doc_id]
        assert bytes(r.kept) == want[doc, body], (r.doc_id, body)
        assert r.n_bytes == len(body)
        assert sum(s.end - s.start for s in r.spans) == len(body) - len(r.kept)


@pytest.mark.parametrize("seed", [3, 4])
@pytest.mark.parametrize("partitions", [1, 5])
def test_words(spark, seed, partitions):
    rows = corpus(seed, letters="a b é ", size=300)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(partitions)
    got = substring_dedup.substring_dedup(df, length=7, gram=3).collect()
    want = brute_words(rows, 7)
    assert len(got) == len(rows)
    by = {}
    for (doc, body), kept in want.items():
        by.setdefault(doc, set()).add(kept)
    for r in got:
        doc = r.doc_id if r.doc_id is not None else -(2**63)
        assert r.kept_words.encode() in by[doc]
        assert " ".join(r.kept.encode().decode().split()) or not r.kept_words


def test_long_texts_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(repeats, "PIECE", 64)
    rng = random.Random(5)
    rows = [(i, "".join(rng.choice("ab ") for _ in range(500))) for i in range(4)]
    rows += [(9, rows[1][1][100:400]), (10, rows[1][1])]
    runs = repeats._anchored(20, 8, False, False)
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([7] * 6), pa.array([r[1].encode() for r in rows])], ["doc", "tag", "text"])
    out = [x for b in runs(iter([batch])) for x in b.to_pylist()]
    windows = {}
    for x in out:
        start = x["pos"] & ((1 << repeats.POS_BITS) - 1)
        for w in range(start, start + x["n"]):
            windows[x["doc"], w] = windows.get((x["doc"], w), 0) + 1
    assert windows == {(d, w): 1 for d, t in rows for w in range(len(t) - 19)}


def test_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([], "doc_id long, text string, doc string, tag int, ranges int, kept int")
    assert suffix_dedup.suffix_dedup(df).count() == 0
    assert substring_dedup.substring_dedup(df).count() == 0
    one = spark.createDataFrame([(1, "a b", "x", 1, 2, 3)], df.schema)
    row = suffix_dedup.suffix_dedup(one).first()
    assert hashlib.sha256(row.kept).hexdigest() == hashlib.sha256(b"a b").hexdigest()


def test_texts_of_one_id_whose_hashes_share_bits(spark):
    rng = random.Random(8)
    tags, rows = {}, []
    while len(rows) < 20:
        text = " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(25))
        other = tags.setdefault(xxhash.xxh64_intdigest(text, 42) & ((1 << 23) - 1), text)
        if other != text:
            # the first one's words stand in another document, the second one's nowhere else
            rows += [(None, other), (None, text), (len(rows), other)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute_words(rows, 7)
    for r in substring_dedup.substring_dedup(df, F.col("text").alias("body"), length=7, gram=3).collect():
        assert r.kept_words.encode() == want[-(2**63) if r.doc_id is None else r.doc_id, r.body.encode()]
    want = sorted(brute_bytes(rows, 20).values())
    assert sorted(bytes(r.kept) for r in suffix_dedup.suffix_dedup(df, length=20, gram=8).collect()) == want


@pytest.mark.parametrize("every", [True, False])
def test_entries_of_one_hash_are_told_apart(every):
    """Classes of few values: entries are alike only if both hashes are."""
    rng = np.random.default_rng(7)
    levels, first, members, marked = repeats.Levels(every), {}, {}, set()
    for _ in range(40):
        batch = np.zeros(rng.integers(1, 30), repeats.ENTRY)
        batch["cls"], batch["key"] = rng.integers(0, 4, len(batch)), rng.integers(0, 12, len(batch))
        batch["doc"], batch["pos"], batch["n"] = rng.integers(0, 50, len(batch)), rng.integers(0, 5, len(batch)), 1
        for e in batch:
            members.setdefault((e["cls"], e["key"]), set()).add((e["doc"], e["pos"]))
        marked |= {(e["cls"], e["key"], e["doc"], e["pos"]) for e in levels.insert(batch)}
    want = {(*c, *p) for c, places in members.items() if len(places) > 1 for p in places if every or p != min(places)}
    assert marked == want
    assert len(levels.entries()) == len(members)

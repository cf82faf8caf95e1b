import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from joblark.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, term string, n int"


def brute(rows, min_docs, top):
    docs = [(lang or "", source or "", [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]) for text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        seen = Counter(t for d in own for t in set(d[2]))
        kept = sorted(t for t, n in seen.items() if n >= min_docs)
        counts = defaultdict(Counter)
        for _, source, terms in own:
            counts[source].update(t for t in terms if seen[t] >= min_docs)
        whole = sum(counts.values(), Counter())
        share = lambda c: {t: 1 + 1_000_000_000 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept)) for t in kept}
        p, q = {s: share(c) for s, c in counts.items()}, share(whole)
        far = lambda a, b: (a - b) ** 2 // (a + b)
        for s in counts:
            pairs = [(sum(far(p[s][t], p[o][t]) for t in kept), o) for o in counts if o != s]
            terms = [(far(p[s][t], q[t]), t) for t in kept if counts[s][t] > 0 and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                ranked = sorted(found, key=lambda f: (-f[0], f[1].encode()))
                out += [(lang, s, part, item, v, r) for r, (v, item) in enumerate(ranked, 1) if part == "pair" or r <= top]
    return sorted(out)


def made(n, seed=0):
    rng = random.Random(seed)
    words = ["Alpha", "alpha", "ÉTÉ", "été", "x", "日本", "beta", "gamma's", "rare", "e1f", "\x7f", "_", "\U0001f600", "￮"]
    rows = []
    for _ in range(n):
        source = rng.choice(["s0", "s0", "s0", "s1", "S2", "é", "", None])
        usual = rng.sample(words, 4) if source == "s1" else words
        rows.append((" ".join(rng.choice(usual) for _ in range(rng.randint(0, 30))), rng.choice(["en", "en", "de", None]), source))
    return rows + [(None, "en", "silent"), ("", "en", "s0"), ("only once", "lone", "a"), ("only once", "lone", "b"), (None, "mute", "a"), ("word " * 3000, "en", "s0")]


def frame(spark, rows):
    return spark.createDataFrame([(i, *r, "t", 1) for i, r in enumerate(rows)], SCHEMA).repartition(4)


@pytest.mark.parametrize("cells, tile, terms", [(1 << 20, 256, 512), (7, 256, 2), (40, 2, 3), (1, 1, 1)])
def test_divergence(spark, cells, tile, terms):
    rows = made(120)
    got = divergence.source_divergence(frame(spark, rows), min_docs=5, top=3, stripe_cells=cells, tile=tile, terms_a_bucket=terms)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 5, 3)


def test_stripes(spark):
    rows = made(80, 1) * 2
    docs = frame(spark, rows).na.fill("").select("lang", "source", "text")
    got = {(r.lang, r.term): (r.df, dict(zip(r.sources, r.counts))) for r in divergence.stripes(docs, 10).collect()}
    df, counts = Counter(), defaultdict(Counter)
    for text, lang, source in rows:
        terms = Counter(t.decode() for t in divergence.terms_of((text or "").encode()))
        for t, n in terms.items():
            df[lang or "", t] += 1
            counts[lang or "", t][source or ""] += n
    assert got == {k: (df[k], dict(counts[k])) for k in df}


def test_ties_rank_by_bytes(spark):
    rows = [(w, "en", s) for s in ("a", "b") for w in ("\U0001f600", "￮", "z", "é") for _ in range(6)] + [("z " * 9, "en", "c")]
    got = divergence.source_divergence(frame(spark, rows), min_docs=2).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, 2, 10)


def test_scaled_is_exact():
    rng = random.Random(5)
    counts = [rng.randrange(1 << rng.randint(1, 52)) for _ in range(2000)]
    whole = [max(1, c + rng.randrange(1 << rng.randint(1, 52))) for c in counts]
    got = divergence.scaled(np.array(counts), np.array(whole))
    assert got.tolist() == [1 + 1_000_000_000 * (c + 2) // w for c, w in zip(counts, whole)]


def test_empty_table(spark):
    assert divergence.source_divergence(frame(spark, made(1)).limit(0)).count() == 0

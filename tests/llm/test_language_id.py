import numpy as np
import pytest
from pyspark.sql import functions as F

from joblark.llm import language_id as li

DATA = "/root/testdata/sf0.01"


def brute_trigrams(text):
    folded = bytearray(b" " + bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in text) + b" ")
    for i in range(1, len(folded)):
        if folded[i - 1] == 0xC3 and 0x80 <= folded[i] <= 0x9E and folded[i] != 0x97:
            folded[i] += 32
    grams = [folded[i] << 16 | folded[i + 1] << 8 | folded[i + 2] for i in range(len(folded) - 2)]
    return [((g * 2654435761) & 0xFFFFFFFF) >> 16 for g in grams if g != 0x202020]


def test_trigrams():
    texts = [t.encode() for t in ["", "a", "Ab c", "ÉÉé ×", "1 2  #", "日本", "x" * 30]]
    code, first, last = li.trigrams(texts)
    assert [code[a:b].tolist() for a, b in zip(first, last)] == [brute_trigrams(t) for t in texts]


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 6, 20, 200])
def test_codewords(n):
    words = li.codewords(n)
    assert words.shape[0] == n
    if n > 1:
        assert (np.abs(words.sum(axis=0)) < n).all()
        assert min((a != b).sum() for i, a in enumerate(words) for b in words[:i]) >= 1


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = li.fit(docs.where(~held))
    rows = li.languages(docs.where(held), model, F.col("lang")).collect()
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97


def test_odd_rows(spark):
    train = [(1, "the cat and the dog", "en"), (2, "der Hund und die Katze", "de"), (3, None, "en"), (4, "le chat et le chien", None), (5, "el perro y el gato ñ", "es")]
    df = spark.createDataFrame(train, "doc_id long, text string, lang string")
    model = li.fit(df)
    assert model.languages == ["de", "en", "es"]
    rows = [(1, None), (2, ""), (3, "12 #!"), (4, "THE DOG AND THE CAT"), (None, "und die"), (4, "und die"), (6, "日"), (7, "the cat " * 20_000)]
    probe = spark.createDataFrame([(*r, "?") for r in rows], "doc_id long, text string, score string")
    got = sorted(((r.doc_id, r.lang_pred, r.score) for r in li.languages(probe, model).collect()), key=str)
    assert [g[:2] for g in got if g[0] in (1, 2, 3)] == [(1, "und"), (2, "und"), (3, "und")]
    assert {g[1] for g in got if g[0] in (4, 7)} == {"en", "de"}
    assert all(0 <= g[2] <= 1 for g in got) and len(got) == len(rows)
    nothing = li.fit(df.limit(0))
    assert {r.lang_pred for r in li.languages(probe, nothing).collect()} == {"und"}
    one = li.fit(df.where("lang = 'en'"))
    assert {r.lang_pred for r in li.languages(probe, one).collect()} == {"und", "en"}
    assert li.languages(probe.limit(0), model).count() == 0


def brute_decode(model, margins):
    """Loss of every language, bit by bit."""
    out = []
    for row in margins:
        losses = []
        for word, trust in zip(model.words, model.trust):
            losses.append(sum(t * np.exp(-w * min(4, max(-4, x / s))) for w, t, x, s in zip(word, trust, row, model.scale)))
        shares = np.exp(-li.SHARPNESS * (np.array(losses) - min(losses)))
        out.append((int(np.argmin(losses)), float(max(shares) / sum(shares))))
    return out


def brute_model(rows):
    """Weights and trust from dense tables of frequencies."""
    names = sorted({k for k, _ in rows})
    share = np.full((len(names), li.BUCKETS), li.SMOOTHING)
    for k, text in rows:
        for b in brute_trigrams(text.encode()):
            share[names.index(k), b] += 1
    share /= share.sum(axis=1, keepdims=True)
    words = li.codewords(len(names))
    weights = np.array([np.log(share[w > 0].mean(axis=0)) - np.log(share[w < 0].mean(axis=0)) for w in words.T]).T
    margins = words * (share @ weights)
    trust = np.clip(margins / np.abs(margins).mean(axis=0), 0.05, None)
    return names, weights, trust / trust.sum(axis=1, keepdims=True)


def made_up(languages, seed=5, lines=4):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(languages):
        words = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(3, 8))) for _ in range(25)]
        out += [(f"l{i:04d}", " ".join(rng.choice(words, 60))) for _ in range(lines)]
    return out


@pytest.mark.parametrize("languages", [2, 3, 7])
def test_fit_and_decoding_against_dense_tables(spark, languages):
    rows = made_up(languages)
    df = spark.createDataFrame([*rows, ("l0000", "")], "lang string, text string").repartition(5)
    model = li.fit(df)
    names, weights, trust = brute_model(rows)
    assert model.languages == names
    assert model.weights == pytest.approx(weights, abs=1e-5) and model.trust == pytest.approx(trust, abs=1e-5)
    margins = np.random.default_rng(1).normal(size=(40, model.words.shape[1])) * model.scale * 3
    got = list(zip(*model.decode(margins)))
    want = brute_decode(model, margins)
    assert [g[0] for g in got] == [w[0] for w in want] and [g[1] for g in got] == pytest.approx([w[1] for w in want])


def test_any_number_of_languages(spark, monkeypatch):
    monkeypatch.setattr(li, "PAIRS", 1000)
    rows = made_up(300)
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, lang string, text string")
    model = li.fit(df.where("doc_id % 4 > 0").repartition(3))
    assert len(model.languages) == 300 > li.HELD_LANGUAGES
    got = li.languages(df.where("doc_id % 4 = 0"), model, F.col("lang")).collect()
    assert len(got) == 300 and sum(r.lang == r.lang_pred for r in got) >= 295


def test_a_text_of_a_language_without_trigrams(spark):
    model = li.fit(spark.createDataFrame([("a", ""), ("b", "hello hello"), ("c", "1 2")], "lang string, text string"))
    assert set(model.languages) <= {"a", "b", "c"} and np.isfinite(model.weights).all() and np.isfinite(model.trust).all()

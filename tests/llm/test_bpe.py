import random

import pytest
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from joblark.llm import bpe

LIBRARY = tokenizers.Tokenizer.from_file(bpe.VOCABULARY)
CODE = bpe.Codec(bpe.VOCABULARY)


def library(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


PIECES = st.sampled_from(
    ["'", "'s", "ll", "'ll", " ", "  ", "\n", "\n\n ", "\t", "a", "the", " and", "ing", "é", "ß", "日本", "👩‍👩‍👧", "　", " ", "1", "23", "!!", "...", "<|endoftext|>", "<|end", "oftext|>", "aaaa", "=====", "́", "\x00"]
)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(PIECES, st.text(max_size=4)), max_size=60), st.integers(1, 40))
def test_tree_equals_the_library(parts, leaf):
    text = "".join(parts)
    want = library(text)
    assert CODE.encode(text) == want
    assert CODE.concatenate([CODE.encode(t) for t in bpe.leaves(text, leaf)]) == want
    assert CODE.decode(want) == LIBRARY.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize("unit", ["a", "ab", "é", " ", "\n ", "!", "'", "'s", "9", "日", "thethe", "=-", "👩‍"])
def test_long_text_without_splits(unit):
    rng = random.Random(len(unit))
    text = unit * (3000 // len(unit)) + "".join(rng.choice("abcdefgh" + unit) for _ in range(3000))
    want = library(text)
    for leaf in (7, 64, 1000):
        assert CODE.concatenate([CODE.encode(t) for t in bpe.leaves(text, leaf)]) == want


def test_documents(spark):
    rng = random.Random(1)
    words = "the of a Haus élan d'eau 12 \n <|endoftext|> aaaaaaaa".split(" ")
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 80))) for _ in range(50)]
    rows = list(enumerate(texts)) + [(100, None), (101, ""), (None, "x" * 300), (102, "y " * 200), (102, "y " * 200), (102, "z " * 200), (None, "x" * 300)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, ids int, part int").repartition(3)
    got = sorted(((r.doc_id, r.ids, r.decoded) for r in bpe.encode_documents(df, leaf=100).collect()), key=str)
    assert got == sorted(((d, library(t or ""), t or "") for d, t in rows), key=str)
    assert bpe.encode_documents(df.limit(0)).count() == 0

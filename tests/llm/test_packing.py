import random
from collections import defaultdict

import pytest
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from joblark.llm import packing

LIBRARY = tokenizers.Tokenizer.from_file(packing.VOCABULARY)
CODE = packing.Encoder(packing.VOCABULARY)


def library(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


def numbers(ids):
    return [int.from_bytes(ids[i : i + 4], "little") for i in range(0, len(ids), 4)]


PIECES = st.sampled_from(
    ["'", "'s", "'S", "ll", "'ll", "don't", " ", "  ", "\n", "\t", "\x0b", "\x1c", "\x85", "\xa0", "The", "É", "ß", "ÿ", "×", "÷", "ª", "²", "½", "日本", "́", "é", "İ",
     "1", "23", "_", "!!", "…", "“x”", "’s", "<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|end", "aaaa", "\x00", "\x7f"]
)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(PIECES, st.text(max_size=4), st.text(alphabet=[chr(c) for c in range(256)], max_size=6)), max_size=40))
def test_ids_equal_the_library(parts):
    text = "".join(parts)
    assert numbers(CODE.encode(text)) == library(text)


def test_every_character_a_text_may_hold():
    """Each alone, and between letters: the words are cut alike."""
    for c in map(chr, [*range(0x20, 0x100), *range(9, 14), *map(ord, "–—‘’“”…")]):
        for text in (c, f"a{c}b", f"1{c}'s{c}{c}"):
            assert numbers(CODE.encode(text)) == library(text), hex(ord(c))


def test_a_word_table_that_is_full_begins_anew(monkeypatch):
    monkeypatch.setattr(packing, "_KNOWN_WORDS", 3)
    code = packing.Encoder(packing.VOCABULARY)
    text = "one two three four five one two"
    assert numbers(code.encode(text)) == library(text) and len(code.words) <= 3


def packed(lengths, capacity):
    made = []
    packer = packing.Packer(capacity, lambda *piece: made.append(piece))
    for doc, n in enumerate(lengths):
        packer.add(doc, b"".join((doc * 1000 + i).to_bytes(4, "little") for i in range(n)))
    packer.close()
    return made


def check(made, documents, capacity):
    """Pieces ``(doc, start, ids, total, sequence, offset)`` of ``documents`` ``{doc: ids}``."""
    cut, sequences = defaultdict(list), defaultdict(list)
    for doc, start, ids, total, sequence, offset in made:
        assert ids and total == len(documents[doc])
        cut[doc].append((start, ids))
        sequences[sequence].append((offset, len(ids)))
    for doc, ids in documents.items():
        whole = []
        for start, part in sorted(cut[doc]):
            assert start == len(whole)
            whole += part
        assert whole == ids
    for pieces in sequences.values():
        end = 0
        for offset, n in sorted(pieces):
            assert offset == end
            end += n
        assert end == capacity or (end < capacity and end & (end - 1) == 0), end
    return sequences


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 300), max_size=80), st.sampled_from([1, 2, 7, 64, 100]))
def test_every_id_lies_in_one_piece_and_nothing_is_padded(lengths, capacity):
    made = [(d, s, numbers(i), t, q, o) for d, s, i, t, q, o in packed(lengths, capacity)]
    sequences = check(made, {d: [d * 1000 + i for i in range(n)] for d, n in enumerate(lengths)}, capacity)
    short = [q for q in sequences.values() if sum(n for _, n in q) < capacity]
    assert len(short) <= max(1, capacity.bit_length())
    assert len(sequences) == len({q for *_, q, _ in made})


def test_a_class_holds_a_fixed_number_of_documents():
    """Lengths from a third to below a half of the capacity: three in a sequence, each cut once."""
    rng = random.Random(3)
    lengths = [rng.randint(34, 49) for _ in range(300)]
    made = packed(lengths, 100)
    first = [p for p in made if p[1] == 0]
    by_sequence = defaultdict(list)
    for p in first:
        by_sequence[p[4]].append((p[5], len(p[2]) // 4))
    assert sum(sorted(v) == [(0, 33), (33, 33), (66, 34)] for v in by_sequence.values()) == 100
    assert len(made) < 5 * len(lengths)


def test_documents(spark):
    rng = random.Random(1)
    words = "the of a Haus élan d'eau 12 \n <|endoftext|> aaaaaaaa".split(" ")
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 80))) for _ in range(60)]
    rows = list(enumerate(texts)) + [(100, None), (101, ""), (102, "word " * 5000), (103, "x" * 20000), (None, "no id")]
    df = spark.createDataFrame([(*r, 1, "s") for r in rows], "doc_id long, text string, start int, ids string").repartition(3)
    found = packing.pack_documents(df, capacity=256).collect()
    made = [(r.doc_id, r.start, numbers(r.ids), r.doc_tokens, r.sequence_id, r.offset) for r in found]
    assert all(r.length == len(r.ids) // 4 for r in found)
    check(made, {d: library(t or "") + [2] for d, t in rows}, 256)


def test_repeated_rows_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a b c")] * 5, "doc_id long, text string")
    found = packing.pack_documents(df.coalesce(1), capacity=8).collect()
    assert sum(r.length for r in found) == 5 * 4
    assert packing.pack_documents(df.limit(0)).count() == 0


@pytest.mark.parametrize("capacity", [16, 4096])
def test_tasks_make_sequences_of_their_own(spark, capacity):
    df = spark.range(200).selectExpr("id AS doc_id", "repeat('word ', cast(id as int)) AS text").repartition(4)
    found = packing.pack_documents(df, capacity=capacity).collect()
    sizes = defaultdict(int)
    for r in found:
        sizes[r.sequence_id] += r.length
    assert sum(sizes.values()) == sum(range(200)) + 200
    assert len({s // packing.SEQUENCES_A_TASK for s in sizes}) == 4

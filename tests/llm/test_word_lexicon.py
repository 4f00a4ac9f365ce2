import hashlib
import os
import random

import numpy as np
import public_tokenizers
import pytest

from tidemark.llm.word_lexicon import Lexicon, WordBpe, build_lexicon, compile_lexicon, decode, encode, minimal_automaton, token_digests

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def bpe():
    return WordBpe(PATH)


def ids_of(bpe, text):
    out = []
    for chunk in bpe.chunks(text):
        out += [bpe.special[chunk[1:]]] if chunk[:1] == " " else [i for w in bpe.words(chunk) for i in bpe.merge(w)]
    return out


def test_random_texts(bpe, library):
    rng = random.Random(5)
    some = [" ", "  ", "\n", "\x1c", "\x85", " ", "a", "b", "É", "ß", "Σ", "σ", "İ", "1", "٣", "½", "!", "'s", "'T", "it's", "漢", "🙂"]
    some += ["<|endoftext|>", "<|startoftext|>", "<|", "|>", "the", "ing", "\x00", "̈", "﻿", "Ᲊ", "\U000323b5", "각", "ᄀ"]
    for _ in range(5_000):
        text = "".join(rng.choice(some) for _ in range(rng.randint(0, 14)))
        expected = library.encode(text, add_special_tokens=False).ids
        assert ids_of(bpe, text) == expected, text
        assert bpe.decode(expected) == library.decode(expected, skip_special_tokens=False)


def test_code_points(bpe, library):
    for k in [*range(0x3000), *range(0x3000, 0x110000, 97)]:
        if not 0xD800 <= k < 0xE000:
            text = f"a{chr(k)}b {chr(k)}1"
            assert ids_of(bpe, text) == library.encode(text, add_special_tokens=False).ids, hex(k)


def test_long_words(bpe, library):
    rng = random.Random(2)
    for n in (63, 64, 65, 66, 200, 5_000):
        for letters in ("a", "ab", "abcdefghinorst", "漢字"):
            word = "".join(rng.choice(letters) for _ in range(n))
            assert ids_of(bpe, word) == library.encode(word, add_special_tokens=False).ids


def test_automaton_shares_suffixes():
    edges, final, start = minimal_automaton([b"tap", b"taps", b"top", b"tops"])
    assert len(final) == 5 and len(edges) == 5 and sum(final) == 2
    assert minimal_automaton([])[1] == [False]


def test_lexicon_finds_its_words_alone(tmp_path):
    rng = random.Random(4)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(1, 8))).encode() for _ in range(800)}
    entries = {w: [rng.randrange(1 << 20) for _ in range(rng.randint(1, 4))] for w in words}
    (tmp_path / "block").write_bytes(compile_lexicon(entries))
    lexicon = Lexicon(str(tmp_path / "block"))
    asked = [*sorted(words), *[w + b"a" for w in words], *[w[:-1] for w in words], b""]
    for word, number in zip(asked, lexicon.find(asked).tolist(), strict=True):
        if word in entries:
            assert lexicon.ids[lexicon.offsets[number] : lexicon.offsets[number + 1]].tolist() == entries[word]
        else:
            assert number == -1
    (tmp_path / "none").write_bytes(compile_lexicon({}))
    assert Lexicon(str(tmp_path / "none")).find([b"a", b""]).tolist() == [-1, -1]


@pytest.mark.parametrize("most", [1, 40, 100_000])
def test_documents_against_the_library(spark, docs, rows, library, most):
    got = token_digests(docs, PATH, build_lexicon(docs, PATH, most)).collect()
    expected = []
    for doc_id, text, _ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        expected.append((doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expected))


def test_columns_and_back(spark, docs, rows, library):
    got = decode(encode(docs, PATH), PATH).select("text", "ids", "decoded").collect()
    assert len(got) == len(rows)
    for text, ids, decoded in got:
        expected = library.encode(text or "", add_special_tokens=False).ids
        assert ids == expected and decoded == library.decode(expected, skip_special_tokens=False)
    odd = spark.createDataFrame([([1, 60_000, None, 2],), (None,), ([],)], "ids array<int>")
    assert [r.decoded for r in decode(odd, PATH).collect()] == [library.decode([1, 60_000, 2], skip_special_tokens=False), None, ""]


def test_empty(spark, no_docs):
    assert token_digests(no_docs, PATH).count() == 0

"""Encoders: the ways that spare memory or time give the library's ids."""

import random

import public_tokenizers
import pytest

from tidewatch.llm import tokens


def test_plain_texts_are_encoded_whole_and_nothing_is_remembered():
    encoder = tokens.PieceEncoder(public_tokenizers.path("byte_bpe_50k.json"), True, "H")
    if encoder.ranked is None:
        pytest.skip("no tiktoken")
    rng = random.Random(2)
    signs = ["word", " ", "  ", "\n", "\t", "\x1c", "\x85", " ", "　", "'ll", "é", "漢", "١", "_", "--", "🙂", "\x00", "7"]
    texts = ["", *("".join(rng.choices(signs, k=60)) for _ in range(300))]
    assert list(encoder(texts)) == encoder._whole(texts) and not encoder.new and not encoder.old
    odd = ["a <|endoftext|> b", "x" * 3_000 + " y", "a" + " " * 3_000 + "b", "漢" * 2_000]
    assert not any(map(encoder._plain, odd)) and list(encoder([*odd, "plain"])) == encoder._whole([*odd, "plain"])


def test_words_of_letters_do_not_go_to_the_library(monkeypatch):
    encoder = tokens.PieceEncoder(public_tokenizers.path("word_bpe_49k.json"), False, "H")
    if encoder.worded is None:
        pytest.skip("no tiktoken")
    rng, asked = random.Random(3), []
    words = ["".join(rng.choices("etaoinshrdlucmwypqx", k=rng.randint(1, 30))) for _ in range(3_000)]
    texts = [" ".join(rng.choices([*words, "Don't", "x1", "é", "a\x00b", "<|", "TEN", "--"], k=50)) for _ in range(200)]
    right = encoder._whole(texts)
    by_library = encoder._by_library
    monkeypatch.setattr(encoder, "_by_library", lambda pieces, lead: asked.extend(pieces) or by_library(pieces, lead))
    assert list(encoder(texts)) == right
    assert asked and not [p for p in asked if p.isascii() and p.isalpha()]


def test_signs_of_ascii_texts_are_found_as_the_pattern_finds_them():
    signs = [chr(c) for c in range(128)]
    assert all(tokens.two_signs(a + b) == bool(tokens.SIGNS.search(a + b)) for a in signs for b in signs)

"""How op2 cuts texts: as the tokenizer's own pre-tokeniser does, and each piece is encoded once."""
import random

import numpy as np
import pytest

from assurspark.llm import token_files

COMMON = [*"abcés  ''.,\n\t09", "'s", "'re", "'LL", "<|endoftext|>", "\x1c", "\x0b"]
PLAIN = [chr(c) for c in [*range(0x80), *range(0xc0, 0x100)]]
OTHER = [*map(chr, range(0x80, 0xc0)), *"漢字かなабв‘’“”—…　 ​﻿٣Ⅷ²½😀"]


@pytest.fixture(scope="module")
def encoder():
    return token_files.Encoder(token_files.tokenizer_path())


def library(encoder, text):
    return np.array(encoder.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@pytest.mark.parametrize("pool", [PLAIN, COMMON, PLAIN + 8 * COMMON, 8 * COMMON + OTHER, PLAIN + OTHER + 3 * COMMON])
def test_ids_are_those_of_the_library(encoder, pool):
    rng = random.Random(5)
    for _ in range(3000):
        text = "".join(rng.choice(pool) for _ in range(rng.randrange(40)))
        assert encoder.ids(text) == library(encoder, text), repr(text)


def test_every_character_next_to_a_blank_and_to_itself(encoder):
    for c in map(chr, range(0x250)):
        for text in (c, f"a {c} b{c}{c}", f"{c}  {c}a1{c}", f"{c}'s{c} '{c}"):
            assert encoder.ids(text) == library(encoder, text), repr(text)


def test_a_word_is_encoded_once_whatever_stands_after_it():
    encoder = token_files.Encoder(token_files.tokenizer_path())
    words, ends, seen = [f"{a}{b}ución" for a in "abcdefghij" for b in "klmnopqrst"], ["", "***", "!", ".\nThe", ",&&&"], []
    real = encoder.tokenize
    encoder.tokenize = lambda piece: seen.append(piece) or real(piece)
    text = " ".join(w + end for end in ends for w in words)
    assert encoder.ids(text) == library(encoder, text)
    assert len(seen) == len(set(seen)) <= 2 * len(words) + 10


def test_another_pre_tokeniser_is_left_to_the_library(tmp_path):
    from tokenizers import Tokenizer, pre_tokenizers

    changed = Tokenizer.from_file(token_files.tokenizer_path())
    changed.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=True, use_regex=True)
    changed.save(str(tmp_path / "prefix.json"))
    encoder = token_files.Encoder(str(tmp_path / "prefix.json"))
    for text in ("one two", " one", "été, 12  it's"):
        assert encoder.ids(text) == library(encoder, text)

"""Chunks that differ in capitals or a last sign are encoded once, with the tokenizer's own ids."""

from __future__ import annotations

import random

import public_tokenizers
from tokenizers import Tokenizer

from waitspark.llm.token_files import ChunkEncoder

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_like_chunks_are_encoded_once():
    encoder = ChunkEncoder(PATH)
    encoded = []
    ids = encoder._ids
    encoder._ids = lambda chunks: encoded.extend(c for c in chunks if c != b"|") or ids(chunks)
    encoder.model = None
    found = encoder("harbour Harbour, harbour. HARBOUR! été, été".encode())
    assert sorted(encoded) == sorted([b"harbour", "été".encode()])
    assert found.tolist() == Tokenizer.from_file(PATH).encode("harbour Harbour, harbour. HARBOUR! été, été", add_special_tokens=False).ids


def test_ids_are_the_tokenizers():
    encoder, tokenizer = ChunkEncoder(PATH), Tokenizer.from_file(PATH)
    pieces = ["a", "B", "it", "'s", "'S", "'", ".", ",", "..", "!", "?", ";", ":", "|", "7", "é", "É", "×", "÷", "ÿ", "H̱",
              "ẖ", "é", "́", "ß", "ẞ", "İ", "漢", "ª", "²", "$", "-", "Ω", " ", "ñ", "Å", "Å"]
    draw = random.Random(7)
    for _ in range(4000):
        text = " ".join("".join(draw.choices(pieces, k=draw.randint(1, 5))) for _ in range(5))
        assert encoder(text.encode()).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_words_of_small_letters_go_to_the_model():
    encoder, tokenizer = ChunkEncoder(PATH), Tokenizer.from_file(PATH)
    assert encoder.model is not None
    encoder._ids = None
    letters = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xDF, 0x100))).replace("÷", "")
    draw = random.Random(8)
    words = [*letters, *("".join(draw.choices(letters, k=draw.randint(1, 12))) for _ in range(20_000))]
    for i in range(0, len(words), 100):
        text = " ".join(words[i : i + 100])
        assert encoder(text.encode()).tolist() == tokenizer.encode(text, add_special_tokens=False).ids

"""Ids by parts of whole texts against the tokenizer library."""

from __future__ import annotations

import random

import numpy as np
from tokenizers import Tokenizer

from corpuswright.llm import packing


def by_library(texts):
    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    return [np.array(x.ids, dtype="<u4").tobytes() for x in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_ids_are_those_of_the_library():
    r = random.Random(5)
    chars = [chr(c) for c in range(0x20, 0x260)] + list("\n\t\x00́中я\U0001f600İ'''  ")
    texts = ["", " ", "\n", "it's 'south'll!'s don't'VE", "<|endoftext|>a <| |>", "Ⱥ Ⱦ Ɔ ɔ ȺȾ1²½", "a\tb", *chars, *("a" + c + "b" for c in chars)]
    texts += ["".join(r.choice(chars) for _ in range(60)) for _ in range(400)]
    plain = [c for c in chars if packing._PLAIN(c)]
    texts += [t for t in ("".join(r.choice([*plain, *"'stm \nreald"]) for _ in range(200)) for _ in range(400)) if "<|" not in t]
    encode = packing.WordEncoder(packing.default_tokenizer()).encode
    wanted = by_library(texts)
    assert encode(texts) == wanted and encode(texts[::-1]) == wanted[::-1] and encode([]) == []


def test_letters_are_encoded_once_whatever_stands_beside_them():
    """Words that differ in case and signs share their parts; nothing is kept or joined for each form."""
    encoder = packing.WordEncoder(packing.default_tokenizer())
    asked = []
    encoder.parts.compute = lambda parts, inner=encoder.parts.compute: asked.extend(parts) or inner(parts)
    texts = ["Storm, storm. STORM!", "storm; (storm)\nStorm%%% écran. ÉCRAN", "storm"]
    assert encoder.encode(texts) == by_library(texts)
    assert sorted(asked) == sorted([*"!;(),.", "%%%", "storm", "écran"]) and not encoder.cache.of
    assert encoder.encode(["storm, ́storm"]) == by_library(["storm, ́storm"]) and len(encoder.cache.of) == 2

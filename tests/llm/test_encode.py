from __future__ import annotations

import random

import pytest
from bindscope.llm.encode import Encoder
from bindscope.llm.queries import tokenizer_path

ODD = [
    None, "", " ", "\n", "a <|endoftext|> b<|endoftext|>", "<|startoftext|>x  y", "<|endoftext|>", "İstanbul İ' foo", "it's they'll don''t we've 'S", "a b c　d",
    "  lead", "trail  ", "\n\n x \n", "x\ty z", "é́ áb c", "~ ~a a~ ~~ b", "foo,. ''s 'd", "１２ ③ x²", "ǅ Ⱥ ß ŉ ẞ", "a\x00 b", "\x00a b", "\x00", "中文 字 a中 中a", "😀 a😀 😀b",
    "Ġ aĠ Ġa", "x</w> </w>", "a-b c_d e", "# * $ %%% a$$$ &&&b",
]


@pytest.mark.parametrize("name,end", [("byte_bpe_50k.json", 0), ("word_bpe_49k.json", 2)])
def test_ids_are_those_of_the_library(prose, name, end):
    """With the library's defaults, special tokens in texts included; pieces learned in any company."""
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path(name))
    rng = random.Random(2)
    signs = ["a", "B", "é", "ɏ", "9", ",", "'", "s", "~", " ", " ", " ", "\n", "\t", " ", "İ", "中", "́", "\x7f"]
    texts = ODD + [t for _, t in prose] + ["".join(rng.choices(signs, k=rng.randint(1, 40))) for _ in range(3000)]
    encoder = Encoder(tokenizer_path(name))
    for part in (texts[:40], texts[40:], texts[::-1]):
        for text, ids in zip(part, encoder.encode(part, end)):
            assert ids.tolist() == library.encode(text or "", add_special_tokens=False).ids + [end], text


def test_letters_are_parted_from_signs_and_case():
    """A word is learned once, whatever its case and the signs and breaks beside it; contractions stay whole."""
    from tokenizers import Tokenizer

    path = tokenizer_path("word_bpe_49k.json")
    library, encoder = Tokenizer.from_file(path), Encoder(path)
    encoder.encode(["Sunflower sunflower. SUNFLOWER,\nsunflower!", "(sunflower) sunflower's"], 2)
    assert {k for k in encoder.young if "sunflower" in k} == {"sunflower", "sunflower's"}
    rng = random.Random(3)
    signs = ["a", "B", "É", "ɏ", "Ⱥ", "ƻ", "ǅ", "×", "÷", "9", ",", "'", "s", "Ll", "~", "$", " ", " ", "\n"]
    texts = ["".join(rng.choices(signs, k=rng.randint(1, 40))) for _ in range(2000)]
    for text, ids in zip(texts, encoder.encode(texts, 2)):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids + [2], text


def test_the_cache_stays_small():
    """Idle workers of the pipeline keep it: two generations of at most 250,000 pieces and one batch."""
    encoder = Encoder(tokenizer_path("word_bpe_49k.json"))
    letters = str.maketrans("0123456789", "abcdefghij")
    for start in range(0, 700_000, 20_000):
        encoder.encode([" ".join(map(str, range(start, start + 20_000))).translate(letters)], 2)
        assert len(encoder.young) + len(encoder.old) < 600_000

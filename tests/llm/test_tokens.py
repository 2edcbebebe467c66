import random

import pytest

from fellwalk.llm.tokens import WordEncoder, pieces_of

tokenizers = pytest.importorskip("public_tokenizers")

ODD = ["", "a", "  A  b\n\n", "it's John's we'll", "İstanbul ÀÉ é é ́x", "don't!!! ... a.b.c, (x) <|endoftext|> foo<|startoftext|>bar", "１２３ ²x ªº",
       "日本語テキスト。", "x" * 500 + " y", "a b c\x1cd\x85e\tf", "ﬁne ǅ", "a,b. c.. d.,; e.5 .f", "a\x01b \x01 c", "\x01", "\U0001F600 ΣΑΣ"]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_are_those_of_the_library(name):
    encoder = WordEncoder(tokenizers.path(name))
    assert encoder.by_word == name.startswith("word")
    rng = random.Random(1)
    texts = ODD + ["".join(rng.choice("aB'sıİé́ \n\t.,!<|>05中\x01\U0001F600ßΣς") for _ in range(60)) for _ in range(1500)]
    for _ in range(2):
        for text, ids in zip(texts, encoder.encode(texts)):
            assert ids.tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_runs_hold_every_text_once():
    texts = ["a" * n for n in (5, 0, 30, 1, 1, 9)]
    runs = pieces_of(texts, 10)
    assert [i for run in runs for i in run] == list(range(6)) and all(sum(len(texts[i]) for i in r) <= 10 or len(r) == 1 for r in runs)

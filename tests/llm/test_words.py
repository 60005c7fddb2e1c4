from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest

from geoledger.llm.chunks import Chunks, byte_pieces
from geoledger.llm.words import byte_level, word_level

PARTS = ["a", "Bx", "s", "'s", " ", " ", "\n", "\t", "  ", " ", "é", "é", "1", "23", "!", ".", ",", "<|endoftext|>", "<|startoftext|>", "\x1c", "　", "\r\n", "'", "ll", "ß", "İ", "🙂", "​", "Σ", "\x85", " the"]


def texts(n: int, size: int) -> list[str]:
    rng = random.Random(n)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, size))) for _ in range(n)]


@pytest.mark.parametrize("make, file", [(byte_level, "byte_bpe_50k.json"), (word_level, "word_bpe_49k.json")])
def test_units_give_the_ids_of_the_whole_text(make, file):
    made = make(public_tokenizers.path(file))
    for text in texts(6000, 14):
        whole = made.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(made.ids(text), "<u4").tolist() == whole, text


def test_chunks_give_the_ids_of_the_whole_text(monkeypatch):
    from geoledger.llm import chunks

    monkeypatch.setattr(chunks, "CHUNK_BYTES", 16)
    path = public_tokenizers.path("byte_bpe_50k.json")
    made, (pieces, _) = Chunks(byte_level(path)), byte_pieces(path)
    for text in texts(1500, 120):
        ids = np.frombuffer(made.encode(text), "<u4").tolist()
        whole = byte_level(path).tokenizer.encode(text, add_special_tokens=False).ids
        assert ids == whole, text
        decoded = b"".join(pieces[k] for k in ids).decode("utf-8", "replace")
        assert decoded == byte_level(path).tokenizer.decode(whole, skip_special_tokens=False)


def test_a_shared_passage_gives_the_same_chunks():
    from geoledger.llm.chunks import cuts

    rng = random.Random(3)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(40_000))
    one, other = ("zz " * 7 + passage).encode(), ("other start " * 50 + passage).encode()

    def chunks_of(data):
        ends = cuts(data)
        return {data[a:b] for a, b in zip([0, *ends], ends)}

    assert len(chunks_of(one) & chunks_of(other)) > 0.8 * len(chunks_of(one))

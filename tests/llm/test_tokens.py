"""Ids of many texts at once: equal to the tokenizer's, whatever stands beside them, with one look-up per distinct word."""

import random

import numpy as np
import pyarrow as pa
import pytest

from feedlake.llm import tokens
from feedlake.llm.packing import Packer, packed_batches
from feedlake.llm.tokens import Encoder, byte_encoder, vocabulary_path, word_encoder

PLAIN = [" ", " ", "\n", "a", "Z", "é", "ſ", "Ÿ", "0", "7", ".", "<"]
ODD = [*PLAIN, "<|", "'s", "×", "÷", "İ", "\t", "\r", "\0", " ", "日", "<|endoftext|>"]


class Counting(tokens.Remembered):
    looked_up = 0

    def __getitem__(self, key):
        self.looked_up += 1
        return super().__getitem__(key)


@pytest.mark.parametrize("group_chars", [1, 50, 1 << 20])
@pytest.mark.parametrize("make", [byte_encoder, word_encoder])
def test_ids_of_many_texts_equal_the_tokenizer(make, group_chars, monkeypatch):
    monkeypatch.setattr(tokens, "GROUP_CHARS", group_chars)
    rng, encoder = random.Random(group_chars), make()
    texts = [None, "", " ", "  ", "\n", "\n\n", " \n ", " a", "a ", "a  ", "\na", "a\n", "\0", "a\0", "word " * 5000, None]
    texts += ["".join(rng.choices(rng.choice([PLAIN, ODD]), k=rng.randrange(14))) for _ in range(4000)]
    want = [encoder.tokenizer.encode(text or "", add_special_tokens=False).ids for text in texts]
    assert [np.frombuffer(own, "<u4").tolist() for own in encoder.ids_of_each(texts)] == want
    assert list(encoder.ids_of_each([])) == [] and list(encoder.ids_of_each([None, ""])) == [b"", b""]


def test_plain_texts_are_those_without_other_characters():
    for c in [*map(chr, range(0xD800)), "😀", "<|", "|<", "< |"]:
        assert tokens._is_plain(f"a{c}a") == (not tokens._NOT_PLAIN.search(f"a{c}a")), c


def test_packing_looks_up_a_word_once_for_many_documents():
    encoder = Encoder(vocabulary_path("byte_bpe_50k.json"), spaces_belong=True)
    encoder.words = Counting(encoder._word)
    texts = [f"the same {k % 7} words again and again\n" * 20 for k in range(500)]
    rows = pa.RecordBatch.from_arrays([pa.array(range(500), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    pieces = [p for b in packed_batches([rows], Packer(0), encoder, True) for p in b.to_pylist()]
    assert encoder.words.looked_up < 50  # 70,000 when every place is looked up
    got = {k: b"" for k in range(500)}
    for p in sorted(pieces, key=lambda p: p["start"]):
        got[p["doc_id"]] += p["ids"]
    for k, text in enumerate(texts):
        assert np.frombuffer(got[k], "<u4").tolist() == [*encoder.tokenizer.encode(text, add_special_tokens=False).ids, 0]


@pytest.mark.parametrize("make", [byte_encoder, word_encoder])
def test_long_plain_runs_before_another_character(make):
    """Each letter before the dash doubled the time once."""
    encoder, text = make(), f"see {'x' * 5000}— {'ab1.' * 300}’s and more"
    assert np.frombuffer(encoder.ids(text), "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids

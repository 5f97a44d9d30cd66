"""Chunk joins are encoded by the library as one text, so tokens over spaces do not go unnoticed."""

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from daystrata.llm import bpe
from daystrata.llm.words import WordCoder


def coder_of(tmp_path, merges, words_apart):
    """A vocabulary written out by hand."""
    letters = ["a", "b", "c", " ", "\n"]
    vocabulary = {token: i for i, token in enumerate([*letters, *["".join(pair) for pair in merges]])}
    library = Tokenizer(models.BPE(vocab=vocabulary, merges=merges))
    if words_apart:
        library.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    library.save(str(tmp_path / "t.json"))
    return WordCoder(str(tmp_path / "t.json"), False)


def joined(code, chunks):
    joiner = bpe.Joiner(code)
    for chunk in chunks:
        joiner.add(*bpe.encode_chunk(code, chunk))
    return np.frombuffer(joiner.close(), code.dtype).tolist()


CHUNKS = ["ab ca b", "c ba c", "a"]


def test_words_apart_join_to_the_librarys_ids(tmp_path):
    code = coder_of(tmp_path, [("a", "b"), ("c", "a")], True)
    assert joined(code, CHUNKS) == code.library.encode("".join(CHUNKS)).ids


def test_tokens_over_spaces_are_an_error(tmp_path):
    code = coder_of(tmp_path, [("b", " "), ("b ", "c"), ("a", " ")], False)
    with pytest.raises(ValueError, match="looks across words"):
        joined(code, CHUNKS)


def test_windows_grow_until_both_sides_agree(monkeypatch):
    code = WordCoder(public_tokenizers.path("word_bpe_49k.json"), False)
    asked, whole = [], code.whole

    def disturbed(text):
        # A library that at first sees a word beside the torn one otherwise.
        asked.append(text)
        return whole("x" + text if len(asked) == 2 else text)

    monkeypatch.setattr(code, "whole", disturbed)
    chunks = ["one two six thr", "ee four ten five"]
    found = joined(code, chunks)
    assert found == code.library.encode("".join(chunks), add_special_tokens=False).ids
    assert asked == ["one two", "six three four", "two six three four ten", "ten five"]

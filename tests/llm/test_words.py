"""New words of many chunks reach the library together, and get the ids that it gives for whole texts."""

import random

import public_tokenizers
import pytest

from daystrata.llm import bpe
from daystrata.llm.words import WordCoder

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
#: What words are made of that take a rule apart: marks, contractions, digits, letters that compose or
#: whose lower case is another's or longer, white space of other kinds, added tokens in any case.
PIECES = [
    "ab", "Zu", "É", "ß", "µ", "ª", "²", "¼", "÷", "7", "'s", "'LL", "'", ",", ".", "!?", "_", "\t", "\r",
    "\x85", "\xa0", "\x1c", "\0", "\u0301", "\u212a", "\u0130", "\u03a3", "\u0436", "\u65e5", "\u2019",
    "<|startoftext|>", "<|STARTOFTEXT|>", "<|EndOfText|>", "</w>", "startoftext", " ", " ", " ", "\n", "  ",
]


class Counted:
    """A tokenizer that notes how often it is asked, and for how many words."""

    def __init__(self, library):
        self.library, self.asked, self.words = library, 0, []

    def __getattr__(self, name):
        return getattr(self.library, name)

    def encode_batch_fast(self, texts, **how):
        self.asked += 1
        self.words += [word for text in texts for word in text.split()]
        return self.library.encode_batch_fast(texts, **how)


def test_new_words_of_many_chunks_are_encoded_together():
    code = WordCoder(WORD_BPE, False)
    code.library = every = Counted(code.library)
    code._lower = lower = Counted(code._lower)
    chunks = [f"x word{chr(97 + i)} Other{chr(97 + i)}, other{chr(97 + i)}. same y" for i in range(26)]
    coded = bpe.encode_chunks(code, chunks)
    for chunk, (ids, ends) in zip(chunks, coded, strict=True):
        body = chunk[2:-2]
        assert ids == code.whole(body)
        assert ends == ["x", "y", body.split(), body.split()]
    assert every.asked - len(chunks) + lower.asked <= 3
    # Neither case nor what follows makes a word new.
    assert len(lower.words) == len(set(lower.words)) == 26 + 26 + 1


@pytest.mark.parametrize("apart", [True, False])
def test_words_put_together_have_the_librarys_ids(apart):
    code, rng = WordCoder(WORD_BPE, False), random.Random(8)
    assert code._lower is not None
    if not apart:
        code._lower = None
    texts = ["".join(rng.choices(PIECES, k=rng.randrange(30))) for _ in range(3000)]
    texts += ["".join(rng.choices(PIECES[:17], k=rng.randrange(30))) for _ in range(1000)]
    code.limit = 40_000
    for at in range(0, len(texts), 100):
        some = texts[at : at + 100]
        assert code.packed_all(some) == [code.whole(text) for text in some]
    for word in ("Zu,", "zu", "<|STARTOFTEXT|>", "ab<|startoftext|>"):
        assert code.counts([word]) == [len(code.whole(word)) // code.size]


def test_edges_are_the_words_nearest_the_cuts():
    words = [f"w{i}" for i in range(20)]
    for body in (" ".join(words), "   ".join(words), "  " + " ".join(words) + "  "):
        assert bpe.edges(body) == (words[: bpe.EDGE_WORDS], words[-bpe.EDGE_WORDS :])
    assert bpe.edges("a  b") == (["a", "b"], ["a", "b"]) and bpe.edges("") == ([], [])

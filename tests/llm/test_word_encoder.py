"""Ids by words against the library's whole-text ids."""

import numpy as np
import pyarrow as pa
import pytest

from tripwise.llm.queries import vocabulary
from tripwise.llm.tokens import WordEncoder


@pytest.fixture(scope="module")
def encoder():
    return WordEncoder(vocabulary("word_bpe_49k.json"))


class Counted:
    """An object whose calls are counted."""

    def __init__(self, held):
        self.held, self.calls = held, 0

    def __getattr__(self, name):
        def call(*args, **named):
            self.calls += 1
            return getattr(self.held, name)(*args, **named)
        return call


def whole(encoder, texts):
    return [encoder.library.encode(t or "", add_special_tokens=False).ids for t in texts]


def split(ids, offsets):
    return [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])]


def test_new_words_take_few_calls():
    letters = np.array(list("abcdefghijklmnopqrstuvwxyzéß"))
    words = ["".join(w) + "." for w in letters[np.random.default_rng(4).integers(0, len(letters), (3000, 8))]]
    own = WordEncoder(vocabulary("word_bpe_49k.json"))
    own.model, own.joined = Counted(own.model), Counted(getattr(own, "joined", None))
    assert split(*own.encode(pa.array([" ".join(words)]))) == whole(own, [" ".join(words)])
    assert own.model.calls + own.joined.calls <= 3  # one by one: 3001


LATIN = [chr(c) for c in range(0x21, 0x180) if not chr(c).isspace()]


def test_every_letter_and_mark(encoder):
    texts = [f"{c} a{c} {c}a {c}{c}. Ab{c}!? x{c}é" for c in LATIN]
    assert split(*encoder.encode(pa.array(texts))) == whole(encoder, texts)


@pytest.mark.parametrize("text", [
    None, "", " ", "  a", "a ", "\n\t\r\x0b\x0c", "a\x1cb a\x85b a　b", "'s it's 'LL ''re", "</w> a</w> <w/ Ġ aĠ",
    "<|endoftext|> <|startoftext|>,", "ÀÉÎÕÜß ÿŸ × ÷", "a1 2b 33", "日本 é ﬁ İ ǅ", "a\x00b \x00"])
def test_odd_texts(encoder, text):
    for texts in ([text], [text, "and", None, text]):
        assert split(*encoder.encode(pa.array(texts, pa.string()))) == whole(encoder, texts)


def test_no_texts_and_known_words(encoder):
    for texts in ([], ["one two"], ["one two", "two one"], []):
        assert split(*encoder.encode(pa.array(texts, pa.string()))) == whole(encoder, texts)

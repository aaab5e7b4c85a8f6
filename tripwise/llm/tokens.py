"""Exact BPE ids of whole texts with the ``tokenizers`` library, by words.

The word-end vocabulary drops white space and never builds a token across it,
so the ids of a text are the ids of its blank-separated chunks in order.
Chunks repeat, so each distinct one is encoded once per worker.  A chunk of
plain letters and ASCII punctuation needs no Unicode normalisation: its
pieces go straight to the library's BPE model, all new ones of a batch
together.  Every other chunk goes through the library's full ``encode``.
Tests hold both against whole-text ``encode``.
"""

from __future__ import annotations

import os
import string
from array import array
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import worker_cache

#: Letters that lower-case and compose (NFC) one by one, then punctuation.
PLAIN = r"^[A-Za-zÀ-ÖØ-öø-ÿ]*[!-/:-@\[-`{-~]*$"
MARKS = string.punctuation
LETTERS = string.ascii_letters + "".join(chr(c) for c in range(0xC0, 0x100) if c not in (0xD7, 0xF7))

#: How the byte-level alphabet writes a blank, and pieces that are spelt in one call.
BLANK, JOINED = "Ġ", 4096

#: Chunks that an encoder remembers, and pieces of chunks.
CACHE_WORDS = 400_000


class Runs:
    """Number runs by text, for texts that occur again and again.

    Beyond ``limit`` texts, those that have occurred once are forgotten, then
    the rarest, until half the limit is left: memory stays bounded, and
    frequent texts stay known.
    """

    def __init__(self, kind: str, limit: int):
        self.kind, self.limit = kind, limit
        self.index: dict[str, int] = {}
        self.starts, self.ends, self.pool = array("q"), array("q"), array(kind)
        self.uses = np.zeros(0, np.int64)

    def add(self, text: str, values) -> int:
        """Values are numbers, or their bytes."""
        self.starts.append(len(self.pool))
        if isinstance(values, bytes):
            self.pool.frombytes(values)
        else:
            self.pool.extend(values)
        self.ends.append(len(self.pool))
        at = self.index[text] = len(self.starts) - 1
        return at

    def extend(self, texts: list[str], values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Add texts that are new and distinct, with their runs one after the
        other, and return their numbers."""
        first, ends = len(self.starts), len(self.pool) + np.cumsum(lengths)
        self.pool.frombytes(values.astype(self.kind).tobytes())
        self.starts.frombytes((ends - lengths).astype(np.int64).tobytes())
        self.ends.frombytes(ends.astype(np.int64).tobytes())
        self.index.update(zip(texts, range(first, first + len(texts))))
        return np.arange(first, first + len(texts))

    def concatenated(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The runs of these numbers one after the other, and their lengths."""
        if not len(which):
            return np.zeros(0, np.dtype(self.kind)), np.zeros(0, np.int64)
        uses = np.bincount(which, minlength=len(self.starts))
        uses[:len(self.uses)] += self.uses
        self.uses = uses
        starts = np.frombuffer(self.starts, np.int64)[which]
        lengths = np.frombuffer(self.ends, np.int64)[which] - starts
        pool = np.frombuffer(self.pool, np.dtype(self.kind)) if len(self.pool) else np.zeros(0, np.dtype(self.kind))
        return gather(pool, starts, lengths), lengths

    def trim(self) -> None:
        if len(self.index) <= self.limit:
            return
        uses = np.zeros(len(self.starts), np.int64)
        uses[:len(self.uses)] = self.uses
        order = np.argsort(-uses, kind="stable")[:self.limit // 2]
        kept = np.sort(order[uses[order] > 1])
        starts, ends = np.frombuffer(self.starts, np.int64)[kept], np.frombuffer(self.ends, np.int64)[kept]
        lengths = ends - starts
        pool = np.frombuffer(self.pool, np.dtype(self.kind)) if len(self.pool) else np.zeros(0, np.dtype(self.kind))
        number = np.full(len(uses), -1)
        number[kept] = np.arange(len(kept))
        self.index = {t: k for t, i in self.index.items() if (k := int(number[i])) >= 0}
        held = gather(pool, starts, lengths)
        self.starts, self.ends, self.pool = array("q"), array("q"), array(self.kind)
        self.pool.frombytes(held.tobytes())
        self.ends.frombytes(np.cumsum(lengths).astype(np.int64).tobytes())
        self.starts.frombytes((np.cumsum(lengths) - lengths).astype(np.int64).tobytes())
        # Use counts start anew, so what was frequent once does not stay for ever.
        self.uses = np.zeros(len(kept), np.int64)


class WordEncoder:
    """Encoder for a vocabulary whose tokens never span white space.

    ``cache_words`` bounds the distinct chunks that are remembered, and also
    their pieces.  The encoder outlives its task in the worker, and so do they:
    ids are held as bytes, which take a third of what lists of numbers do.
    """

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        # The bare model, for pieces joined by blanks; and which ids end a word.
        self.joined = Tokenizer(self.model)
        self.joined.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocabulary = self.library.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for t, i in vocabulary.items() if t.endswith(self.model.end_of_word_suffix)]] = True
        self.limit = cache_words
        # Beyond half the limit the older pieces go, save those met again.
        self.pieces: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.runs = Runs("I", cache_words)

    def pieces_of(self, texts: list[str]) -> list[bytes]:
        """The ids of each piece (empty: none), which are distinct."""
        found = [self.pieces.get(t) or self.older.get(t) if t else b"" for t in texts]
        new = [k for k, ids in enumerate(found) if ids is None]
        new.sort(key=lambda k: not texts[k].isascii())
        for at in range(0, len(new), JOINED):
            part = new[at:at + JOINED]
            for k, ids in zip(part, self.spelt([texts[k] for k in part])):
                found[k] = ids
        for text, ids in zip(texts, found):
            if text not in self.pieces:
                if len(self.pieces) >= self.limit // 2:
                    self.older, self.pieces = self.pieces, {}
                self.pieces[text] = ids
        return found

    def spelt(self, pieces: list[str]) -> list[bytes]:
        """The model's ids of each piece, from one call for all: just one of
        a piece's tokens ends a word, its last."""
        text = " ".join(pieces)
        if not text.isascii():
            text = self.byte_level.pre_tokenize_str(text)[0][0].replace(BLANK, " ")
        ids = np.array(self.joined.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
        stops = (4 * (np.flatnonzero(self.ends_word[ids]) + 1)).tolist()
        assert len(stops) == len(pieces), "a piece has one token that ends a word"
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip([0, *stops], stops)]

    def learn(self, words: pa.Array) -> np.ndarray:
        """The numbers of the runs of new chunks, which are distinct."""
        plain = pc.match_substring_regex(words, PLAIN)
        simple, others = words.filter(plain), words.filter(pc.invert(plain))
        letters, marks = pc.utf8_lower(pc.utf8_rtrim(simple, MARKS)), pc.utf8_ltrim(simple, LETTERS)
        halves = pa.concat_arrays([letters, marks]).dictionary_encode()
        ids = self.pieces_of(strings(halves.dictionary))
        sizes = np.array([len(x) // 4 for x in ids], np.int64)
        at = halves.indices.to_numpy().reshape(2, -1).T.ravel()  # each chunk's letters, then its marks
        runs = gather(np.frombuffer(b"".join(ids), np.uint32), (np.cumsum(sizes) - sizes)[at], sizes[at])
        numbers, plain = np.empty(len(words), np.int64), plain.to_numpy(zero_copy_only=False)
        numbers[plain] = self.runs.extend(strings(simple), runs, sizes[at].reshape(-1, 2).sum(1))
        numbers[~plain] = [self.runs.add(w, self.library.encode(w, add_special_tokens=False).ids) for w in strings(others)]
        return numbers

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts (null: empty) one after the other, and the
        offsets of each text in them."""
        self.runs.trim()
        words = pc.ascii_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
        coded = words.flatten().dictionary_encode()
        distinct = coded.dictionary
        known = np.fromiter(map(self.runs.index.get, strings(distinct), repeat(-1)), np.int64, len(distinct))
        new = known < 0
        known[new] = self.learn(distinct.filter(pa.array(new)))
        ids, lengths = self.runs.concatenated(known[coded.indices.to_numpy()])
        before = np.concatenate([[0], np.cumsum(lengths)])
        offsets = words.offsets.to_numpy()
        return ids, before[offsets - offsets[0]]


def strings(texts: pa.Array) -> list[str]:
    """As ``to_pylist`` of texts without nulls, which takes nine times as long."""
    return texts.to_numpy(zero_copy_only=False).tolist()


def gather(pool: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs ``pool[start:start + length]``, one after the other."""
    total = int(lengths.sum())
    if not total:
        return pool[:0].copy()
    shift = starts - (np.cumsum(lengths) - lengths)
    return pool[np.repeat(shift, lengths) + np.arange(total)]


def word_encoder(path: str) -> WordEncoder:
    return worker_cache(("words", path), lambda: WordEncoder(path))


def encode_with_end(texts: pa.Array, path: str, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """As ``WordEncoder.encode``, with ``end_id`` after each text."""
    ids, offsets = word_encoder(path).encode(texts)
    n = len(offsets) - 1
    out = np.empty(len(ids) + n, np.uint32)
    ends = offsets[1:] + np.arange(n)
    keep = np.ones(len(out), bool)
    keep[ends] = False
    out[keep] = ids
    out[ends] = end_id
    return out, offsets + np.arange(n + 1)

"""Exact token counts at every prefix of a text, by dynamic programming.

A byte-pair encoding is valid exactly if each token stands for itself and
every two neighbours stay as they are when encoded together.  So the encoding
of a prefix ends in the one vocabulary token that is compatible with the last
token of the shorter prefix before it: scanning a piece once gives the count
at each of its prefixes.  Pieces repeat across texts, so each distinct chunk
(a run of white space and the word after it) is solved once per worker.

The table stores, per document, the change of the count at every character,
compressed.  A running sum answers any truncation or budget question without
encoding again.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .tokens import Runs

#: Unicode White_Space, which the pre-tokeniser's \s stands for (fixed values).
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: A piece always ends where white space begins, and nothing looks back.
CHUNKS = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
LEADING = re.compile(f"[{SPACE}]*")
#: One piece of letters, perhaps after one blank, then one of ASCII marks.
PLAIN = re.compile(r"( ?[A-Za-zÀ-ÖØ-öø-ÿ]+)([!-/:-@\[-`{-~]*)")
#: Contractions whose two-character prefix is a mark and a letter apart.
LONG_CONTRACTIONS = ("'re", "'ve", "'ll")


class PrefixCounter:
    """Prefix counts for a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str, cache_words: int = 500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.vocabulary = self.library.get_vocab(with_added_tokens=False)
        self.spelling = {i: t for t, i in self.vocabulary.items()}
        #: Beginnings of tokens.  A state is one of them (the longest that the
        #: spelling read so far ends in), with its moves by the next character
        #: and the tokens it ends in, longest first.
        self.beginnings = {t[:k] for t in self.vocabulary for k in range(len(t) + 1)}
        self.numbers, self.states = {"": 0}, [""]
        self.moves: list[dict[str, int]] = [{}]
        self.endings: list[list[tuple[int, int]]] = [[]]
        special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.special_marks = {s[0] for s in special}
        self.limit = cache_words
        #: Spelling of the characters that plain words are made of.
        self.letters = {c: self.spell(chr(c)) for c in [32, *range(0xC0, 0x100)]}
        self.previous: tuple[str, list[int], list[int], list[int]] = ("", [0], [-1], [0])
        self.pairs: dict[tuple[int, int], bool] = {}
        self.whole: dict[int, bool] = {}
        self.pieces: dict[str, list[int]] = {}
        self.runs = Runs("h", cache_words)

    def spell(self, text: str) -> str:
        """One character for each byte, as the vocabulary spells them."""
        return self.byte_level.pre_tokenize_str(text)[0][0] if text else ""

    def stands_alone(self, token: int) -> bool:
        ok = self.whole.get(token)
        if ok is None:
            ok = self.whole[token] = [t.id for t in self.model.tokenize(self.spelling[token])] == [token]
        return ok

    def compatible(self, a: int, b: int) -> bool:
        ok = self.pairs.get((a, b))
        if ok is None:
            if len(self.pairs) >= 2 * self.limit:
                self.pairs.clear()
            both = self.model.tokenize(self.spelling[a] + self.spelling[b])
            ok = self.pairs[a, b] = len(both) == 2 and both[0].id == a and both[1].id == b
        return ok

    def move(self, state: int, mark: str) -> int:
        """The state after one more character, remembered."""
        text = self.states[state] + mark
        while text not in self.beginnings:
            text = text[1:]
        to = self.numbers.get(text)
        if to is None:
            to = self.numbers[text] = len(self.states)
            self.states.append(text)
            self.moves.append({})
            found = ((self.vocabulary.get(text[k:]), len(text) - k) for k in range(len(text)))
            self.endings.append([(token, size) for token, size in found if token is not None])
        self.moves[state][mark] = to
        return to

    def piece(self, spelt: str) -> list[int]:
        """Token counts of the byte prefixes 1, 2, ... of one piece."""
        counts = self.pieces.get(spelt)
        if counts is not None:
            return counts
        n = len(spelt)
        # What the piece solved before has in common with this one stands.
        before, counts, last, path = self.previous
        same = 0
        for a, b in zip(before, spelt):
            if a != b:
                break
            same += 1
        counts = counts[:same + 1] + [0] * (n - same)
        last = last[:same + 1] + [-1] * (n - same)
        path = path[:same + 1]
        self.previous = (spelt, counts, last, path)
        state, moves, endings, pairs = path[same], self.moves, self.endings, self.pairs
        for i in range(same + 1, n + 1):
            mark = spelt[i - 1]
            to = moves[state].get(mark)
            state = self.move(state, mark) if to is None else to
            path.append(state)
            for token, size in endings[state]:
                j = i - size
                if j:
                    ok = pairs.get((last[j], token))
                    if ok is None:
                        ok = self.compatible(last[j], token)
                else:
                    ok = self.stands_alone(token)
                if ok:
                    counts[i], last[i] = counts[j] + 1, token
                    break
        if len(self.pieces) >= self.limit:
            self.pieces.clear()
        counts = self.pieces[spelt] = counts[1:]
        return counts

    def plain(self, text: str) -> list[int]:
        """Counts at the byte prefixes of a chunk without special tokens."""
        out, base = [], 0
        for spelt, _ in self.library.pre_tokenizer.pre_tokenize_str(text):
            counts = self.piece(spelt)
            if spelt in LONG_CONTRACTIONS:
                counts = [1, 2, counts[2]]
            out += [base + c for c in counts]
            base = out[-1]
        # A prefix that ends within the white space has it as one piece.
        blanks = LEADING.match(text).group()
        if len(blanks) > 1:
            counts = self.piece(self.spell(blanks))
            out[:len(counts)] = counts
        return out

    def chunk_counts(self, text: str) -> list[int]:
        """Counts at the character prefixes of a chunk."""
        out: list[int] = []
        base, at = 0, 0
        if self.special and not self.special_marks.isdisjoint(text):
            for found in self.special.finditer(text):
                # Up to its end the special token is ordinary text.
                counts = self.plain(text[at:found.end()])
                before = self.plain(text[at:found.start()])[-1] if found.start() > at else 0
                out += [base + c for c in by_character(text[at:found.end()], counts)[:-1]]
                base += before + 1
                out.append(base)
                at = found.end()
        if at < len(text):
            out += [base + c for c in by_character(text[at:], self.plain(text[at:]))]
        return out

    def chunk(self, text: str) -> int:
        found = PLAIN.fullmatch(text)
        if found:
            word, marks = found.groups()
            counts = by_character(word, self.piece(word.translate(self.letters)))
            if marks:
                counts = counts + [counts[-1] + c for c in self.piece(marks)]
        else:
            counts = self.chunk_counts(text)
        return self.runs.add(text, map(int.__sub__, counts, [0, *counts]))

    def changes(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """Change of the count at every character of the texts (null: empty),
        one text after the other, and the offsets of each text."""
        self.runs.trim()
        index, which, sizes = self.runs.index, array("q"), [len(text or "") for text in texts]
        for text in texts:
            chunks = CHUNKS.findall(text or "")
            # In order, so that neighbours share their beginnings.
            for c in sorted({c for c in chunks if c not in index}):
                self.chunk(c)
            which.extend([index[c] for c in chunks])
        changes, _ = self.runs.concatenated(np.frombuffer(which, np.int64) if len(which) else np.zeros(0, np.int64))
        return changes, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def by_character(text: str, counts: list[int]) -> list[int]:
    if text.isascii():
        return counts
    out, at = [], -1
    for c in map(ord, text):
        at += 1 if c < 0x80 else 2 if c < 0x800 else 3 if c < 0x10000 else 4
        out.append(counts[at])
    return out


def counter(path: str) -> PrefixCounter:
    return common.worker_cache(("prefixes", path), lambda: PrefixCounter(path))


def pack_changes(changes: np.ndarray) -> bytes:
    """Width byte, then the changes in so many bytes each, compressed."""
    import zstandard

    narrow = not len(changes) or (changes.min() >= -128 and changes.max() <= 127)
    raw = changes.astype("<i1" if narrow else "<i2").tobytes()
    return bytes([1 if narrow else 2]) + zstandard.ZstdCompressor(level=1).compress(raw)


def unpack_counts(stored: bytes) -> np.ndarray:
    """Exact token counts of the prefixes of 0, 1, 2, ... characters."""
    import zstandard

    changes = np.frombuffer(zstandard.ZstdDecompressor().decompress(stored[1:]), f"<i{stored[0]}")
    return np.concatenate([[0], np.cumsum(changes, dtype=np.int64)])


def longest_within(counts: np.ndarray, budget: int) -> int:
    """Characters of the longest prefix of at most ``budget`` tokens."""
    return int(np.flatnonzero(counts <= budget)[-1])


def prefix_table(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_bytes, prefix_counts of every document (doc_id, text; other
    columns are ignored).  A null text is empty; null ids and repeated rows
    stay as they are."""
    common.bounded_batches(docs.sparkSession)

    def solve(batches):
        schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("prefix_counts", pa.binary())])
        for batch in batches:
            changes, offsets = counter(vocabulary).changes(batch.column("text").to_pylist())
            stored = [pack_changes(changes[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(stored, pa.binary())], schema=schema)

    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), n_bytes, "text")
            .mapInArrow(solve, "doc_id long, n_bytes long, prefix_counts binary"))


def answer(prefixes: DataFrame, limit: int) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit and within_limit_chars (longest
    prefix of at most ``limit`` tokens) from the stored counts."""
    def ask(batches):
        schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()),
                            ("within_limit_chars", pa.int64())])
        for batch in batches:
            counts = map(unpack_counts, batch.column("prefix_counts").to_pylist())
            rows = [(int(c[-1]), longest_within(c, limit)) for c in counts]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"),
                                              pa.array([r[0] for r in rows], pa.int64()),
                                              pa.array([r[1] for r in rows], pa.int64())], schema=schema)

    out = prefixes.mapInArrow(ask, "doc_id long, n_bytes long, n_tokens long, within_limit_chars long")
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "within_limit_chars")


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row, answered from the
    stored prefix counts.  A null text is empty; texts are counted whole; null
    ids stay null; repeated rows are answered each; other columns are not
    looked at; an empty table gives no rows."""
    return answer(common.written(prefix_table(docs, vocabulary), "prefix-counts"), limit)

"""Re-Pair grammar compression of one shard of token ids.

Frequent adjacent pairs are replaced by new symbols (nonterminals), round
after round, until no pair occurs ``min_count`` times.  A round replaces all
pairs within a factor of the most frequent one, left to right without
overlap, so a shard takes tens of vectorised rounds rather than one pass per
rule.  The payload stores the rules, each rule's expansion length and sampled
expansion offsets, so any range of tokens is decoded by expanding only the
symbols that cover it.

Payload (little-endian)::

    magic "RPT1" | u8 symbol bytes (2 or 4) | u32 first nonterminal | u32 rules
    | u64 symbols | u64 tokens | u32 documents
    | rules: u32 left[], u32 right[], u64 expansion length[]
    | symbols | u64 expansion offset of every SAMPLE-th symbol
    | documents: i64 id[], u8 id is null[], u64 tokens[]
"""

from __future__ import annotations

import struct

import numpy as np

from .tokens import gather

HEAD = "<4sBIIQQI"
MAGIC = b"RPT1"
SAMPLE = 256
HASH_BITS = 18
#: A rule takes 16 bytes and a replaced pair saves 2, so eight uses pay for a
#: rule; twice that leaves out rules that gain next to nothing.
MIN_COUNT = 16


def grammar(ids: np.ndarray, min_count: int = MIN_COUNT, spread: int = 8):
    """(symbols, first nonterminal, left[], right[]) of the ids."""
    seq = ids.astype(np.uint32)
    first = int(seq.max()) + 1 if len(seq) else 0
    lefts, rights, rules = [], [], 0
    while len(seq) > 1:
        # Counting by hash bucket is one cheap pass; only pairs in buckets
        # that reach the threshold are counted exactly.
        h = (seq[:-1] * np.uint32(0x9E3779B1) + seq[1:] * np.uint32(0x85EBCA77)) >> np.uint32(32 - HASH_BITS)
        counts = np.bincount(h, minlength=1 << HASH_BITS)
        floor = max(min_count, int(counts.max()) // spread)
        at = np.flatnonzero((counts >= floor)[h])
        if not len(at):
            break
        pairs, which, n = np.unique((seq[at].astype(np.uint64) << np.uint64(32)) | seq[at + 1],
                                    return_inverse=True, return_counts=True)
        chosen = n >= floor
        if not chosen.any():
            # Two rarer pairs shared the fullest bucket.
            chosen = n >= max(min_count, int(n.max()))
            if not chosen.any():
                break
        hit = chosen[which]
        at, which = at[hit], which[hit]
        # In a run of touching matches every second one is taken.
        new_run = np.concatenate([[True], np.diff(at) != 1])
        run_start = np.maximum.accumulate(np.where(new_run, np.arange(len(at)), 0))
        take = (np.arange(len(at)) - run_start) % 2 == 0
        at, which = at[take], which[take]
        used, which = np.unique(which, return_inverse=True)
        lefts.append((pairs[used] >> np.uint64(32)).astype(np.uint32))
        rights.append((pairs[used] & np.uint64(0xFFFFFFFF)).astype(np.uint32))
        seq[at] = (first + rules + which).astype(np.uint32)
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        seq = seq[keep]
        rules += len(used)
    none = np.zeros(0, np.uint32)
    return seq, first, np.concatenate([none, *lefts]), np.concatenate([none, *rights])


def expansions(first: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Tokens that each rule stands for."""
    out = np.zeros(len(left), np.int64)
    for k, (a, b) in enumerate(zip(left.tolist(), right.tolist())):
        out[k] = (1 if a < first else out[a - first]) + (1 if b < first else out[b - first])
    return out


def encode_shard(ids: np.ndarray, doc_ids: np.ndarray, doc_nulls: np.ndarray,
                 doc_tokens: np.ndarray, min_count: int = MIN_COUNT) -> bytes:
    symbols, first, left, right = grammar(ids, min_count)
    lengths = expansions(first, left, right)
    width = 2 if first + len(left) <= 1 << 16 else 4
    covered = symbol_lengths(symbols, first, lengths)
    offsets = np.cumsum(covered) - covered
    return b"".join([
        struct.pack(HEAD, MAGIC, width, first, len(left), len(symbols), len(ids), len(doc_ids)),
        left.astype("<u4").tobytes(), right.astype("<u4").tobytes(), lengths.astype("<u8").tobytes(),
        symbols.astype(f"<u{width}").tobytes(), offsets[::SAMPLE].astype("<u8").tobytes(),
        doc_ids.astype("<i8").tobytes(), doc_nulls.astype("u1").tobytes(), doc_tokens.astype("<u8").tobytes()])


def symbol_lengths(symbols: np.ndarray, first: int, lengths: np.ndarray) -> np.ndarray:
    table = np.concatenate([lengths, [1]])
    s = symbols.astype(np.int64) - first
    return table[np.where(s < 0, len(lengths), s)]


class Shard:
    """Reader of one payload: documents, whole decoding, random access."""

    def __init__(self, payload: bytes):
        magic, width, self.first, rules, symbols, self.tokens, docs = struct.unpack_from(HEAD, payload)
        self.flat = None
        if magic != MAGIC:
            raise ValueError("not a token shard")
        at = struct.calcsize(HEAD)

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(payload, kind, n, at)
            at += out.nbytes
            return out

        self.left, self.right = take("<u4", rules), take("<u4", rules)
        self.lengths = take("<u8", rules).astype(np.int64)
        self.symbols = take(f"<u{width}", symbols)
        self.samples = take("<u8", -(-symbols // SAMPLE)).astype(np.int64)
        self.doc_ids, self.doc_nulls = take("<i8", docs), take("u1", docs).astype(bool)
        self.doc_tokens = take("<u8", docs).astype(np.int64)
        self.doc_starts = np.cumsum(self.doc_tokens) - self.doc_tokens

    def rules_expanded(self) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all symbols one after the other (terminals, then rules), with
        each symbol's start and length.  One nesting level of the rules is
        replaced per pass."""
        if self.flat is None:
            out = np.arange(self.first, self.first + len(self.left), dtype=np.uint32)
            while True:
                rule = out >= self.first
                if not rule.any():
                    break
                size = np.where(rule, 2, 1)
                at = np.cumsum(size) - size
                wide = np.empty(int(size.sum()), np.uint32)
                wide[at[~rule]] = out[~rule]
                k = out[rule] - np.uint32(self.first)
                wide[at[rule]], wide[at[rule] + 1] = self.left[k], self.right[k]
                out = wide
            pool = np.concatenate([np.arange(self.first, dtype=np.uint32), out])
            lengths = np.concatenate([np.ones(self.first, np.int64), self.lengths])
            self.flat = pool, np.cumsum(lengths) - lengths, lengths
        return self.flat

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        pool, starts, lengths = self.rules_expanded()
        return gather(pool, starts[symbols], lengths[symbols])

    def decode(self) -> np.ndarray:
        return self.expand(self.symbols)

    def decode_range(self, start: int, count: int) -> np.ndarray:
        """Ids start .. start + count - 1, expanding only what covers them."""
        count = max(0, min(count, self.tokens - start))
        if not count:
            return np.zeros(0, np.uint32)
        block = int(np.searchsorted(self.samples, start, side="right")) - 1
        last = int(np.searchsorted(self.samples, start + count, side="left"))
        symbols = self.symbols[block * SAMPLE:last * SAMPLE]
        covered = symbol_lengths(symbols, self.first, self.lengths)
        offsets = self.samples[block] + np.cumsum(covered) - covered
        a = int(np.searchsorted(offsets, start, side="right")) - 1
        b = int(np.searchsorted(offsets, start + count, side="left"))
        skip = start - int(offsets[a])
        return self.expand(symbols[a:b])[skip:skip + count]

    def document(self, k: int) -> np.ndarray:
        return self.decode_range(int(self.doc_starts[k]), int(self.doc_tokens[k]))

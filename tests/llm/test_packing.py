"""Packings are complete, gapless and close to the least number of bins."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tripwise.llm import packing

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def pieces_of(rows, capacity):
    tokenizer, out = Tokenizer.from_file(VOCABULARY), []
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for k, a in enumerate(range(0, len(ids), capacity)):
            part = ids[a:a + capacity]
            out.append((doc_id, k, a, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    return sorted(out, key=str)


def check(rows, got, capacity):
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=str) == pieces_of(rows, capacity)
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


EDGE = [(5, None), (3, ""), (9, "The cat sat"), (9, "The cat sat"), (None, "no id"), (7, "long words " * 9000)]


def test_edge_rows(spark):
    docs = spark.createDataFrame([(d, t, 1, 2) for d, t in EDGE], "doc_id long, text string, uid int, block int")
    assert check(EDGE, packing.pack_documents(docs, VOCABULARY).collect(), 4096) <= 6


def test_empty_table(spark):
    assert packing.pack_documents(spark.createDataFrame([], "doc_id long, text string"), VOCABULARY).collect() == []


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = packing.pack_documents(docs, VOCABULARY).collect()
    total = sum(r.length for r in got)
    assert check(rows, got, 4096) <= -(-total // 4096) + 2


def first_fit_decreasing(sizes, capacity):
    room = []
    for s in sorted(sizes, reverse=True):
        k = next((k for k, r in enumerate(room) if r >= s), None)
        if k is None:
            room.append(capacity - s)
        else:
            room[k] -= s
    return len(room)


@pytest.mark.parametrize("low,high", [(200, 700), (20, 500), (334, 500)])
def test_not_worse_than_decreasing(spark, low, high):
    rng = np.random.default_rng(1)
    sizes = rng.integers(low, high + 1, 900).tolist()
    items = spark.createDataFrame(list(enumerate(sizes)), "uid long, length long")
    places = packing.pack(items, 1000, block_items=1024, generations=12).collect()
    assert sorted(r.uid for r in places) == list(range(900))
    assert len({r.sequence_id for r in places}) <= first_fit_decreasing(sizes, 1000)


def test_crossover_keeps_items_and_beats_best_fit():
    # Triplets that fill bins exactly; decreasing best fit misses many.
    rng = np.random.default_rng(3)
    sizes = []
    for _ in range(40):
        a, b = rng.integers(251, 375, 2)
        sizes += [a, b, 1000 - a - b]
    sizes = np.array(sizes)
    start = packing.first_population(sizes, 1000, 8, rng, True)
    best = packing.evolve(start, sizes, 1000, 80, rng)[0]
    fill = np.bincount(best, sizes)
    assert len(best) == 120 and fill.max() <= 1000 and fill.min() > 0
    assert len(fill) <= min(len(np.bincount(a)) for a in start)
    assert len(fill) < len(np.bincount(start[0]))


def test_many_blocks(spark):
    sizes = np.random.default_rng(5).integers(1, 300, 3000).tolist()
    items = spark.createDataFrame(list(enumerate(sizes)), "uid long, length long")
    places = packing.pack(items, 1000, block_items=256).collect()
    assert sorted(r.uid for r in places) == list(range(3000))
    fill = defaultdict(int)
    for r in places:
        fill[r.sequence_id] += sizes[r.uid]
    assert max(fill.values()) <= 1000 and len(fill) <= -(-sum(sizes) // 1000) + 3


def test_sequences(spark):
    docs = spark.createDataFrame([(i, f"text number {i} " * (i + 1)) for i in range(30)], "doc_id long, text string")
    pieces = packing.common.written(packing.token_pieces(docs, VOCABULARY, 64), "pieces")
    places = packing.common.written(packing.pack(pieces, 64), "places")
    held = {r.sequence_id: r.ids for r in packing.sequences(pieces, places).collect()}
    by_uid = {r.uid: r for r in pieces.collect()}
    for r in places.collect():
        p = by_uid[r.uid]
        assert held[r.sequence_id][4 * r.offset:4 * (r.offset + p.length)] == p.ids
    assert max(len(x) for x in held.values()) <= 256

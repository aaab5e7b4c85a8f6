"""Token files against whole-text encoding, and Re-Pair round trips."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tripwise.llm import token_files
from tripwise.llm.repair import Shard, encode_shard

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def expected(rows):
    tokenizer, start, out = Tokenizer.from_file(VOCABULARY), 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1] is not None, r[1] or "")):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


EDGE = [(5, None), (3, ""), (9, "The cat's  <|endoftext|> sat,\x0bon the mat."), (9, "The cat's  <|endoftext|> sat,\x0bon the mat."),
        (None, "no id"), (-2, "é é Ünï ß 日本 n°5 <|STARTOFTEXT|> _x_ don't"), (7, "long word " * 30_000), (8, " \n\t ")]


def test_edge_rows(spark):
    docs = spark.createDataFrame([(t, d, 1) for d, t in EDGE], "text string, doc_id long, n_tokens int")
    assert sorted(map(tuple, token_files.token_files(docs, VOCABULARY).collect()), key=lambda r: r[1]) == expected(EDGE)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert token_files.token_files(docs, VOCABULARY).collect() == []


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = sorted(map(tuple, token_files.token_files(docs, VOCABULARY).collect()), key=lambda r: r[1])
    assert got == expected([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_small_shards(spark, tmp_path):
    rows = [(i, f"some words {i % 7} again " * (i % 11)) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    manifest = token_files.write_token_files(docs, str(tmp_path), VOCABULARY, shard_tokens=500, min_count=4, partitions=3)
    manifest = spark.createDataFrame(manifest.collect(), manifest.schema)
    assert manifest.count() > 3
    got = sorted(map(tuple, token_files.read_token_files(manifest, str(tmp_path)).collect()), key=lambda r: r[1])
    assert got == expected(rows)


@settings(deadline=None, max_examples=60)
@given(st.lists(st.integers(0, 5), max_size=300), st.integers(0, 300), st.integers(0, 300))
def test_random_access(ids, start, count):
    ids = np.array(ids, np.uint32)
    shard = Shard(encode_shard(ids, np.arange(1), np.zeros(1), np.array([len(ids)]), min_count=3))
    assert shard.decode().tolist() == ids.tolist()
    assert shard.decode_range(start, count).tolist() == ids[start:start + count].tolist()


def test_repeats_compress():
    ids = np.tile(np.arange(1000, dtype=np.uint32), 400)
    payload = encode_shard(ids, np.arange(4), np.zeros(4), np.full(4, 100_000))
    assert len(payload) < len(ids) // 8
    assert Shard(payload).document(2).tolist() == ids[200_000:300_000].tolist()


@pytest.mark.parametrize("n", [0, 1, 2])
def test_tiny(n):
    shard = Shard(encode_shard(np.arange(n, dtype=np.uint32), np.arange(1), np.zeros(1), np.array([n])))
    assert shard.decode().tolist() == list(range(n))


def test_production_settings_make_rules(spark, sf_dir):
    """The default threshold must pay on given texts, not only on made-up repeats."""
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").select("text").collect()]
    tokenizer = Tokenizer.from_file(VOCABULARY)
    ids = np.concatenate([tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]).astype(np.uint32)[:60_000]
    shard = Shard(encode_shard(ids, np.arange(1), np.zeros(1), np.array([len(ids)])))
    assert len(shard.left) > 100
    assert 2 * len(shard.symbols) + 16 * len(shard.left) < 2 * len(ids)
    assert shard.decode().tolist() == ids.tolist()

"""Prefix counts against the library's encoding of every prefix."""

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from tripwise.llm import prefix_counts
from tripwise.llm.prefix_counts import PrefixCounter, longest_within, pack_changes, unpack_counts

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
COUNTER = PrefixCounter(VOCABULARY)


def library(text):
    return len(COUNTER.library.encode(text, add_special_tokens=False).ids)


def every_prefix(text):
    changes, offsets = COUNTER.changes([text])
    assert offsets.tolist() == [0, len(text)]
    return unpack_counts(pack_changes(changes)).tolist()


def check(text):
    assert every_prefix(text) == [library(text[:k]) for k in range(len(text) + 1)], repr(text)


def test_texts():
    for text in ["", " ", "a", "The cat's  hat,\n\n we'll they've you're I'd!'re", "x<|endoftext|> y <|endoftext|><|endoft", "  \t \n",
                 "a  b\x0b\x0cc \xa0 d\x85　e\x1c\x1d f", "é́ Ünï ß µ 日本語 n°5 ½x² ñandú 🙂🙂", "a" * 300, "=" * 200 + " " * 150 + "z",
                 "1234567 12,345.67 abc123def", "don't 'tis 'll 'l '' 's's", "HELLO*** ### $$$ <|endoftext|", "foo_bar __init__"]:
        check(text)


@settings(deadline=None, max_examples=150)
@given(st.text(st.sampled_from("aeilrstv'  \n\t.!<|endoftx>éß1\xa0́"), max_size=40))
def test_random_texts(text):
    check(text)


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    got = prefix_counts.token_counts(docs, VOCABULARY).collect()
    assert {r.doc_id: r.n_tokens for r in got} == {k: library(t) for k, t in texts.items()}
    assert all(r.over_limit == (r.n_tokens > 512) and r.n_bytes == len(texts[r.doc_id].encode()) for r in got)
    for r in got[:60]:
        assert library(texts[r.doc_id][:r.within_limit_chars]) <= 512
        assert r.within_limit_chars == len(texts[r.doc_id]) or library(texts[r.doc_id][:r.within_limit_chars + 1]) > 512


def test_edge_rows(spark):
    rows = [(1, None), (None, ""), (2, "word " * 40_000), (2, "word " * 40_000), (3, "z" * 3000)]
    docs = spark.createDataFrame([(d, t, 7) for d, t in rows], "doc_id long, text string, n_tokens int")
    got = [(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in prefix_counts.token_counts(docs, VOCABULARY).collect()]
    want = [(d, len(t or ""), library(t or ""), library(t or "") > 512) for d, t in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert prefix_counts.token_counts(docs.limit(0), VOCABULARY).collect() == []


def test_budget():
    counts = unpack_counts(pack_changes(COUNTER.changes(["one two three four"])[0]))
    assert longest_within(counts, 2) == max(k for k in range(19) if library("one two three four"[:k]) <= 2)
    assert longest_within(counts, 0) == 0


def test_cache_starts_over():
    small = PrefixCounter(VOCABULARY, cache_words=20)
    for k in range(30):
        text = " ".join(f"w{k}x{j}" for j in range(10))
        assert unpack_counts(pack_changes(small.changes([text])[0]))[-1] == library(text)

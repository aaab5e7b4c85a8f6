"""Repeated passages against brute force; the cover; edge rows."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from tripwise.llm import suffix_dedup


def brute_force(rows, width=400):
    """(doc_id, n_bytes, n_removed, n_spans, sha256) with every string looked up."""
    data = [(t or "").encode() for _, t in rows]
    seen = Counter(d[i:i + width] for d in data for i in range(len(d) - width + 1))
    out = []
    for (doc_id, _), d in zip(rows, data):
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - width + 1):
            if seen[d[i:i + width]] > 1:
                gone[i:i + width] = True
        spans = int(np.count_nonzero(np.diff(np.concatenate([[0], gone.astype(int)])) == 1))
        kept = bytes(np.frombuffer(d, np.uint8)[~gone])
        out.append((doc_id, len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def result(df):
    return Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


def texts(seed=5):
    """Shared passages of about the threshold at all alignments."""
    rng = np.random.default_rng(seed)
    fresh = lambda n: "".join(rng.choice(list("abcdefgh é"), n))
    passages = [fresh(n) for n in (300, 392, 397, 399, 400, 401, 450, 900, 2000)]
    rows = []
    for k in range(90):
        cut = passages[k % 9]
        rows.append((k, fresh(int(rng.integers(0, 700))) + cut + fresh(int(rng.integers(0, 700)))))
    rows += [(200, "ab" * 700), (201, "x" * 400), (202, "y" * 399), (203, "z" * 401), (204, passages[7] + "-" + passages[7]),
             (205, rows[3][1]), (206, rows[3][1][:-1]), (207, passages[8][5:]), (208, "")]
    return rows


def test_cover():
    cover = suffix_dedup.difference_cover()
    assert len(cover) == suffix_dedup.FIELD + 1
    assert {(int(a) - int(b)) % suffix_dedup.PERIOD for a in cover for b in cover} == set(range(suffix_dedup.PERIOD))


def test_window_hashes(monkeypatch):
    data = np.frombuffer(("abcab" * 3000).encode(), np.uint8)
    whole = suffix_dedup.window_hashes(data, 300, 1)
    assert len(set(whole.tolist())) == 5 and len(whole) == 15000 - 299
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 1000)
    assert (suffix_dedup.window_hashes(data, 300, 1) == whole).all()


@pytest.mark.parametrize("chunk_bytes, bucket_names, blocks", [(1 << 21, 1 << 20, 4), (9000, 500, 3), (1000, 1 << 20, 1)])
def test_brute_force(spark, chunk_bytes, bucket_names, blocks):
    rows = texts()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = suffix_dedup.repeats(docs, chunk_bytes=chunk_bytes, bucket_names=bucket_names, blocks=blocks)
    want = brute_force(rows)
    assert Counter((r.doc_id, r.n_bytes, sum(s.length for s in r.spans), len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in got.collect()) == want
    by_id = dict(rows)
    for r in got.collect():
        data = by_id[r.doc_id].encode()
        kept, at = b"", 0
        for s in r.spans:
            kept, at = kept + data[at:s.start], s.start + s.length
        assert kept + data[at:] == r.kept


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert result(suffix_dedup.digest(docs)) == brute_force([(r.doc_id, r.text) for r in docs.collect()])


def test_edge_rows(spark):
    long = "word and number 7, " * 20_000
    rows = [(None, None), (None, "a b c"), (1, None), (2, ""), (2, ""), (None, "k" * 500), (3, long), (3, long), (4, "é" * 200), (5, "é" * 199 + "x")]
    docs = spark.createDataFrame([(*r, 7, "c") for r in rows], "doc_id long, text string, chunk int, names string")
    assert result(suffix_dedup.digest(docs)) == brute_force(rows)
    assert suffix_dedup.digest(docs.limit(0)).collect() == []


def test_session_keeps_its_batches(spark, sf_dir):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    suffix_dedup.repeats(spark.createDataFrame([(1, "a")], "doc_id long, text string"))
    assert spark.conf.get(name) == before

"""Phrases against SQL and brute force; flows; paths; edge rows."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from compare import duck_connect
from tripwise.llm import collocations


def pieces(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", lower)]


def counts(rows):
    out = Counter()
    for lang, text in rows:
        for p in pieces(text):
            out.update((lang or "und", *p[i:i + k]) for k in (1, 2, 3) for i in range(len(p) - k + 1))
    return out


def brute_force(rows, min_count=10, percent=50):
    f = counts(rows)
    n = Counter()
    for g, c in f.items():
        if len(g) == 2:
            n[g[0]] += c
    out = set()
    for g, a in f.items():
        lang, *w = g
        if len(w) < 2 or a < min_count:
            continue
        longer = [c for h, c in f.items() if len(h) == 4 > len(g) and h[0] == lang and tuple(w) in (h[1:3], h[2:4]) and c >= min_count]
        if any(100 * c >= percent * a for c in longer):
            continue
        score, k, left, right = min((1_000_000 * a * a // (f[(lang, *w[:k])] * f[(lang, *w[k:])]), k, f[(lang, *w[:k])], f[(lang, *w[k:])]) for k in range(1, len(w)))
        out.add((lang, " ".join(w), a, left, right, n[lang], score))
    return out


def result(rows, spark, schema="lang string, text string", **sizes):
    found = collocations.phrases(spark.createDataFrame(rows, schema).repartition(2), **sizes).collect()
    got = [(r.lang, r.phrase, r.a, r.l, r.r, r.n, r.score) for r in found]
    assert len(got) == len(set(got))
    return set(got)


def made(seed):
    rng = np.random.default_rng(seed)
    words = [f"w{k}" for k in range(14)]
    rows = []
    for _ in range(200):
        text = " ".join(rng.choice(words, int(rng.integers(0, 40))))
        if rng.random() < 0.5:
            text += " the long fixed passage stands here as one whole" + (". End" if rng.random() < 0.3 else " and on")
        rows.append((["en", "fr", None][rng.integers(3)], text))
    return rows


@pytest.mark.parametrize("sizes", [{}, {"chunk_bytes": 300, "bucket_grams": 5}])
def test_brute_force(spark, sizes):
    rows = made(1)
    want = brute_force(rows)
    assert len(want) > 30 and result(rows, spark, **sizes) == want


def test_flows_and_paths(spark):
    rows = made(2)
    f = counts(rows)
    edges, pairs, words = collocations.graph(spark.createDataFrame(rows, "lang string, text string"), 1)
    got = {(r.lang, r.x, r.y, r.z): r.n for r in edges.collect()} | {(r.lang, r.x, r.y): r.n for r in pairs.collect()} | {(r.lang, r.x): r.n for r in words.collect()}
    assert got == dict(f)
    paths = {(r.lang, " ".join(r.words)): r.n for r in collocations.unary_paths(edges, pairs).collect()}
    whole = [(lang, p) for lang, p in paths if "long fixed passage stands here as one" in p]
    assert whole and all(paths[p] == f[(p[0], "long", "fixed", "passage")] for p in whole)
    for (lang, p), n in paths.items():
        w = p.split(" ")
        assert {f[(lang, *w[i:i + 3])] for i in range(len(w) - 2)} == {n}


def test_edge_rows(spark):
    long = "again and over " * 30_000
    rows = [(None, None), (None, ""), ("en", " \t.\n"), ("en", "A b, a B; a b: A\tb! a b? a b\x0ba b\x0ca b\ra b.a b"), ("en", "É é É é"), ("xx", long), ("xx", long), ("y", "one")]
    wide = [(*r, 5, "k", "w") for r in rows]
    assert result(wide, spark, "lang string, text string, n int, kind string, words string") == brute_force(rows)
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert collocations.best(docs.limit(0)).collect() == []
    ranks = collocations.best(docs, top=2).collect()
    assert sorted((r.lang, r["rank"]) for r in ranks) == [("en", 1), ("xx", 1), ("xx", 2)]


def test_top(spark, sf_dir):
    """Order and cut of the report on a table with more phrases than it takes."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = duck_connect(sf_dir).sql(collocations.ORACLE.replace("rank <= 2000", "rank <= 40")).fetchall()
    got = collocations.best(docs, top=40).collect()
    assert sorted(map(tuple, got)) == sorted(want) and len(want) > 40


def test_many_buckets_cost_no_more():
    """A chunk asks with as many bytes however many buckets there are, and its
    words are not sent along."""
    rng = np.random.default_rng(4)
    texts = [" ".join(f"word{k}" for k in rng.zipf(1.3, 3000)).encode() for _ in range(20)]
    codes, vocabulary, pieces = collocations.words_of(texts)
    row = collocations.packed(7, "en", codes, vocabulary, pieces).to_pylist()[0]
    sent = []
    for buckets in (1, 10, 5000):
        names, n = collocations.Chunk(row, buckets).distinct()
        asks = list(collocations.asks_of(7, names, n, "<u1", 255))
        held = [b for b, *_ in asks]
        assert held == sorted(set(held)) and held[-1] < buckets <= 5 * len(held)
        sent.append(sum(len(x) + len(y) for _, _, x, y in asks))
        assert sent[-1] == 5 * len(names)
        assert n.sum() == sum(max(0, len(p) - k) for t in texts for p in pieces_of(t) for k in range(3))
    assert max(sent) <= 1.001 * min(sent)


def pieces_of(data):
    return pieces(data.decode())


def test_shared_names_add_up():
    """Names of two chunks, and of two grams that fall together, are summed."""
    def ask(chunk, names, counts):
        return {"bucket": 3, "chunk": chunk, "names": np.array(names, "<u4").tobytes(), "counts": np.array(counts, "<u1").tobytes()}

    found = collocations.answered(pa.Table.from_pylist([ask(1, [4, 5, 9], [9, 9, 255]), ask(2, [5, 8], [1, 10])]), 10, "<u1").to_pylist()
    bits = {r["chunk"]: np.unpackbits(np.frombuffer(r["bits"], np.uint8)).tolist() for r in found}
    assert bits == {1: [0, 1, 1, 0, 0, 0, 0, 0], 2: [1, 1, 0, 0, 0, 0, 0, 0]}


def test_high_bound(spark):
    """A bound above what a byte holds, and texts without words."""
    rows = [("en", "one two three four. " * 130)] * 3 + [("en", "one two " * 200), ("fr", " . "), (None, "one two " * 299)]
    want = brute_force(rows, min_count=300)
    assert want and result(rows, spark, min_count=300, chunk_bytes=1000) == want

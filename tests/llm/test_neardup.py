"""Components against brute force; sketches; edge rows."""

import re
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from tripwise.llm import neardup
from tripwise.llm.shingles import shingle_hashes, word_hashes


def shingles(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_force(rows):
    """(doc_id, n_shingles, component_id) by comparing all pairs that share a shingle."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    shared, holders = Counter(), defaultdict(list)
    for k, s in enumerate(sets):
        for x in s:
            holders[x].append(k)
    for held in holders.values():
        shared.update(combinations(held, 2))
    for (a, b), n in shared.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            parent[max(root(a), root(b))] = min(root(a), root(b))
    groups = defaultdict(list)
    for k in range(len(rows)):
        groups[root(k)].append(k)
    name = {r: min((rows[k][0] for k in ks if rows[k][0] is not None), default=None) for r, ks in groups.items()}
    return Counter((rows[k][0], len(sets[k]), name[root(k)]) for k in range(len(rows)))


def check(spark, rows, schema="doc_id long, text string"):
    got = neardup.digest(spark.createDataFrame(rows, schema)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_force([r[:2] for r in rows])
    assert all(r.kept == (r.doc_id is not None and r.doc_id == r.component_id) for r in got)


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.01')}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = neardup.digest(docs).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_force(rows)


def edited(rng, words, changes):
    out = list(words)
    for k in rng.choice(len(out), changes, replace=False):
        out[k] = f"new{rng.integers(1 << 30)}"
    return " ".join(out)


def test_groups_and_chains(spark):
    """Star-shaped groups around a hidden middle, chains of small steps, and
    texts that share half their words without being near."""
    rng = np.random.default_rng(3)
    rows = []
    for g in range(4):
        base = [f"g{g}w{k}" for k in range(300)]
        rows += [(len(rows) + i, edited(rng, base, int(rng.integers(1, 9)))) for i in range(120)]
    chain = [f"c{k}" for k in range(200)]
    for i in range(60):
        chain[(7 * i) % 200] = f"step{i}"
        rows.append((len(rows), " ".join(chain)))
    half = [f"h{k}" for k in range(60)]
    for i in range(150):
        rows.append((len(rows), " ".join(half + [f"own{i}x{k}" for k in range(60)])))
    order = rng.permutation(len(rows)).tolist()
    check(spark, [(order[k], t) for k, (_, t) in enumerate(rows)])


def test_rows_grow_with_texts(spark, monkeypatch):
    """Texts near each other but none linked: what the stages write stays in
    proportion to the texts, and the result is that of brute force."""
    rng, rows, written = np.random.default_rng(8), [], {}
    base = [f"b{k}" for k in range(300)]
    rows = [(k, edited(rng, base, 9)) for k in range(600)] + [(600 + k, edited(rng, base, 5)) for k in range(40)]
    plain = neardup.common.written

    def counted(df, label):
        out = plain(df, label)
        size[label] = max(size.get(label, 0), out.count())
        return out

    monkeypatch.setattr(neardup.common, "written", counted)
    for n in (320, 640):
        size = written[n] = {}
        check(spark, rows[-n:])
    bands = neardup.REGISTERS // neardup.BAND
    assert all(count <= 3 * bands * n for n in written for count in written[n].values()), written
    assert all(written[640][label] <= 4 * written[320][label] + 100 for label in written[320]), written


EDGE = [(5, None), (3, ""), (4, " \n\t"), (9, "One two three"), (2, "one  TWO\nthree"), (7, "one two"), (None, "one two three"), (None, "null id " * 9),
        (None, "null id " * 9), (8, "a b c d e"), (8, "a b c d e"), (8, "other text with the same id as before"), (6, "É x"), (10, "é x"),
        (11, "long text " * 40_000), (12, "long text " * 40_001)]


def test_edge_rows(spark):
    check(spark, [(*r, 1, "c") for r in EDGE], "doc_id long, text string, cid int, class_hi string")
    docs = spark.createDataFrame(EDGE, "doc_id long, text string")
    assert neardup.digest(docs.limit(0)).collect() == []
    kept = neardup.keep(docs)
    assert kept.columns == docs.columns
    texts = sorted((r.text or "")[:30] for r in kept.collect())
    assert texts == sorted(["", "", " \n\t", "one  TWO\nthree", "one two", ("null id " * 9)[:30], "a b c d e", "other text with the same id as before"[:30],
                            "É x", "é x", ("long text " * 9)[:30]])


def test_one_word_repeated(spark):
    """Sequences of different length with the same single shingle are linked;
    texts of fewer than five words are one shingle of their own."""
    rows = [(3, "a " * 5), (1, "a " * 6), (2, "A\n" * 9), (4, "a " * 4), (5, "a a a"), (6, "b " * 7), (7, "b " * 70), (8, "a " * 5 + "b"), (9, "a a a a b")]
    rows += [(100 + k, "spam " * (5 + k)) for k in range(400)]
    check(spark, rows)
    kept = Counter(r.text.split()[0] for r in neardup.keep(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert kept == {"a": 5, "b": 1, "spam": 1}


def test_estimate_is_near_the_truth():
    rng = np.random.default_rng(5)
    for share, n_a, n_b in ((0.0, 500, 500), (0.3, 900, 400), (0.75, 700, 650), (0.9, 3000, 3000), (1.0, 50, 50)):
        both = int(share * (n_a + n_b) / (1 + share))
        pool = rng.integers(0, 1 << 63, n_a + n_b, dtype=np.uint64)
        a, b = pool[:n_a], np.concatenate([pool[:both], pool[n_a:n_a + n_b - both]])
        x = neardup.sketch(np.concatenate([a, b]), np.array([0, n_a, n_a + n_b]), 4000)
        j = neardup.estimate(np.array([(x[0] > x[1]).sum()]), np.array([(x[0] < x[1]).sum()]), np.array([(x[0] == x[1]).sum()]),
                             np.array([float(n_a)]), np.array([float(n_b)]))[0]
        assert j == pytest.approx(both / (n_a + n_b - both), abs=0.03)


def test_sketches_merge():
    rng = np.random.default_rng(6)
    h = rng.integers(0, 1 << 63, 100, dtype=np.uint64)
    parts = neardup.sketch(np.concatenate([h[:60], h[40:], h]), np.array([0, 60, 120, 220]))
    assert (neardup.merge(parts[0], parts[1]) == parts[2]).all()


def test_many_texts_at_a_time():
    """Sketches do not depend on how texts are grouped for the computation."""
    texts = [f"t{k} " * (k % 50) + " ".join(f"w{k}x{j}" for j in range(k * 7 % 400)) for k in range(300)]
    whole = neardup.sketch(*neardup.sets_of(pa.array(texts))[:2])
    for k in (0, 1, 50, 299):
        assert (whole[k] == neardup.sketch(*neardup.sets_of(pa.array([texts[k]]))[:2])[0]).all()


def test_shingle_counts():
    texts = ["", "a", "a b c d", "a b c d e", "a b c d e f", None, "a a a a a a a"]
    hashes, offsets = shingle_hashes(*word_hashes(pa.array(texts, pa.string())))
    assert np.diff(offsets).tolist() == [0, 1, 1, 1, 2, 0, 3]
    assert neardup.sets_of(pa.array(texts, pa.string()))[2].tolist() == [len(shingles(t)) for t in texts]
    assert len(set(hashes.tolist())) == 5

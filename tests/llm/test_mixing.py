"""The mix against a plain resharing loop, its SQL, and its schedule."""

import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from compare import compare, duck_connect
from pyspark.sql import functions as F

from tripwise.llm import mixing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def resharing(sizes):
    """Targets by the literal rule: cap, reshare the excess, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(3 * sizes[s] for s in capped)
        target = {s: 3.0 * sizes[s] if s in capped else left * weight[s] / sum(weight[f] for f in free) for s in names}
        above = {s for s in free if target[s] > 3 * sizes[s]}
        if not above:
            return target
        capped |= above


def check(rows, got):
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += words(text)
    assert Counter((r.doc_id, r.size, r.source_size) for r in got) == Counter((d, words(t), sizes[s]) for d, t, s in rows)
    source_of, target, taken = defaultdict(set), resharing(sizes), defaultdict(int)
    for d, _, s in rows:
        source_of[d].add(s)
    for r in got:
        assert r.taken <= 3 * r.size and (not r.size or r.taken % r.size == 0)
        assert (r.position_ppm is None) == (r.taken == 0) and (r.position_ppm is None or 0 <= r.position_ppm <= 1_000_000)
        if len(source_of[r.doc_id]) == 1:
            (s,) = source_of[r.doc_id]
            assert r.target == pytest.approx(target[s])
            taken[s] += r.taken
    return {s: (taken[s], target[s]) for s in sizes}


def fill_up(source_of, got):
    """Every source is below its target by less than the smallest document
    that its last pass leaves out, or above it by taking that one."""
    for source in set(source_of.values()):
        own = [r for r in got if source_of[r.doc_id] == source and r.size]
        left, copies = own[0].target - sum(r.taken for r in own), [r.taken // r.size for r in own]
        assert max(copies) - min(copies) <= 1
        if left > 1e-6:
            assert left < min(r.size for r, c in zip(own, copies) if c == min(copies)) / 2 + 1
        elif left < -1e-6:
            assert any(left + r.size > -left for r, c in zip(own, copies) if c == max(copies))


def test_very_long_documents(spark, monkeypatch):
    """A source of short documents and eight of 75,000 words, wherever its
    last pass ends."""
    rng = np.random.default_rng(3)
    monkeypatch.setattr(mixing, "LIST", 60)  # several rounds
    rows = []
    for source in ("a", "b", "c", "d"):
        sizes = [75_000] * 8 + rng.integers(50, 1500, 200).tolist()
        rows += [(len(rows) + k, "w " * int(n), source) for k, n in enumerate(sizes)]
    docs = spark.createDataFrame([(d, t, "en", s, 0) for d, t, s in rows], SCHEMA).repartition(4)
    got = mixing.assign(docs, cell_rows=20).collect()
    sums = check(rows, got)
    fill_up({d: s for d, _, s in rows}, got)
    assert all(abs(taken - target) <= 75_000 / 2 for taken, target in sums.values())
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    ok, why = compare(mixing.assign(docs), mixing.ORACLE, con)
    assert ok, why


def test_columns_of_any_name(spark):
    docs = spark.createDataFrame([(1, "a b", "x", "keep", 5), (None, "c", None, "this", 6)], "doc_id long, text string, source string, __mix_source string, up_to int")
    rows = mixing.training_order(docs).distinct().collect()
    assert sorted((r["__mix_source"], r.up_to) for r in rows) == [("keep", 5), ("this", 6)]


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.01')}/documents.parquet")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    got = mixing.assign(docs, cell_rows=3).collect()
    check(rows, got)
    fill_up({d: s for d, _, s in rows}, got)


def test_oracle(spark, sf_dir):
    ok, why = compare(mixing.assign(spark.read.parquet(f"{sf_dir}/documents.parquet"), cell_rows=40), mixing.ORACLE, duck_connect(sf_dir))
    assert ok, why


EDGE = [(1, None, "a"), (2, "", "b"), (3, "one two three", None), (None, "x " * 50, "ä"), (4, "p q", "a"), (4, "p q", "a"), (5, "w " * 20_000, "a"),
        (6, "s t u", "b"), (7, "v", "Z"), (8, "only blank \t", "")]


def test_edge_rows(spark):
    docs = spark.createDataFrame([(d, t, "en", s, 1, 2) for d, t, s in EDGE], SCHEMA + ", up_to int")
    check(EDGE, mixing.assign(docs).collect())
    assert mixing.assign(docs.limit(0)).collect() == []
    assert mixing.training_order(docs).columns == docs.columns
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", EDGE)
    ok, why = compare(mixing.assign(docs), mixing.ORACLE, con)
    assert ok, why
    nothing = spark.createDataFrame([(1, None, "en", "a", 0), (2, "", "en", None, 0)], SCHEMA)
    assert [(r.size, r.taken, r.target) for r in mixing.assign(nothing).collect()] == [(0, 0, 0.0)] * 2
    assert mixing.training_order(nothing).collect() == []


def test_training_order(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    copies = Counter(r.doc_id for r in mixing.training_order(docs).collect())
    want = {r.doc_id: r.taken // r.size for r in mixing.assign(docs).collect() if r.taken}
    assert copies == want
    again = Counter(r.doc_id for r in mixing.training_order(docs.repartition(5)).collect())
    assert again == copies


def test_schedule(spark):
    """Words placed before time t follow the integral of the schedule."""
    rows = [(i, "w " * (1 + i % 7), "en", f"s{i % 6}", 0) for i in range(6000)]
    docs = spark.createDataFrame(rows, SCHEMA)
    _, stats, fillers, n, cells = mixing.plan(docs, cell_rows=100)
    light = mixing.running(mixing.sized(docs).drop("text"), cells)
    found = mixing.placed(light, stats, fillers, n).select("source", mixing.SIZE, "slope", F.explode("positions").alias("t")).collect()
    for source in {r.source for r in found}:
        own = [r for r in found if r.source == source]
        total, slope = sum(r[mixing.SIZE] for r in own), own[0].slope
        for t in (0.1, 0.5, 0.9):
            share = sum(r[mixing.SIZE] for r in own if r.t <= t) / total
            assert share == pytest.approx((1 - slope) * t + slope * t * t, abs=0.01)
    # All schedules together are even over time.
    whole = np.histogram([r.t for r in found], 10, (0, 1), weights=[r[mixing.SIZE] for r in found])[0]
    assert whole.max() / whole.min() < 1.05
    times = [r.doc_id for r in mixing.training_order(docs).collect()]
    assert len(times) == len(found)

"""Recall and exactness of the prefix forest against brute force."""

from collections import defaultdict

import numpy as np
import pytest

from tripwise.llm import ann

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute_force(rows, k, every):
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in rows]
    ids, matrix = np.array([i for i, _ in good]), np.array([v for _, v in good])
    out = {}
    for i, v in good:
        if i % every == 0:
            scores = (matrix * v).sum(axis=1)
            best = [j for j in np.lexsort((ids, -scores)) if ids[j] != i][:k]
            out[i] = [(int(ids[j]), float(scores[j])) for j in best]
    return out


def found(frame):
    out = defaultdict(list)
    for r in sorted(frame.collect(), key=lambda r: (r.query_id, r["rank"])):
        assert r["rank"] == len(out[r.query_id]) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return dict(out)


def recall(got, want):
    assert set(got) == set(want)
    return np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / len(want[q]) for q in want])


def test_embeddings(spark, sf_dir):
    frame = spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.1')}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in frame.collect()]
    want, got = brute_force(rows, 20, 20), found(ann.nearest(frame, shard_rows=700, group_rows=40))
    assert recall(got, want) >= 0.95
    scores = {(q, i): s for q, held in want.items() for i, s in held}
    assert all(scores.get((q, i), s) == s for q, held in got.items() for i, s in held)
    assert all(held == sorted(held, key=lambda x: (-x[1], x[0])) for held in got.values())


def test_clusters_end_early():
    """Near neighbours are found without looking at most vectors."""
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((40, 64))
    vectors = np.repeat(centres, 200, axis=0) + 0.05 * rng.standard_normal((8000, 64))
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    planes = ann.projections(64, 12)
    forest = ann.Forest.build(np.arange(8000), vectors, planes)
    looked = []
    plain = forest._best
    forest._best = lambda rows, *rest: (looked.append(len(rows)), plain(rows, *rest))[1]
    q, near, _ = forest.search(np.arange(0, 8000, 50), vectors[::50], 20, 0.97)
    assert np.mean(near // 200 == (q * 50) // 200) == 1.0
    assert sum(looked) < 0.15 * 160 * 8000
    want = np.argsort(-(vectors[::50] @ vectors.T), axis=1)[:, 1:21]
    assert np.mean([len(set(near[q == i]) & set(want[i])) / 20 for i in range(160)]) >= 0.93


def test_ties_and_copies(spark):
    """A third of all rows are one vector: ties go to the smaller ids."""
    rng = np.random.default_rng(2)
    rows = [(i, [1.0, 2.0, -1.0, 0.5] if i % 3 == 0 else rng.standard_normal(4).tolist()) for i in range(600)]
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    want, got = brute_force(rows, 20, 20), found(ann.nearest(frame, shard_rows=100, found=0.999999))
    assert got.keys() == want.keys()
    for q in want:
        if q % 3 == 0:
            assert got[q] == want[q]


def test_lengths_count(spark):
    """Nearness is the inner product: long vectors win over close ones."""
    rng = np.random.default_rng(4)
    rows = [(i, (rng.standard_normal(8) * (10 if i % 7 == 0 else 1)).tolist()) for i in range(800)]
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    assert recall(found(ann.nearest(frame)), brute_force(rows, 20, 20)) >= 0.95


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.5, 0.5]), (1, [0.0, 2.0]), (2, None), (40, [0.0, 0.0]), (60, [nan, 1.0]), (3, [inf, 1.0]), (4, [None, 1.0]),
            (5, [1.0]), (6, []), (None, [1.0, 1.0]), (-20, [-1.0, 0.5]), (1, [0.0, 2.0]), (0, [1.0, 0.0])]
    frame = spark.createDataFrame([(i, v, 0, 1.0, 9) for i, v in rows], SCHEMA + ", score double, rank int")
    got = found(ann.nearest(frame))
    assert got == {0: [(20, 0.5), (1, 0.0), (-20, -1.0)], 20: [(1, 1.0), (0, 0.5), (-20, -0.25)], -20: [(1, 1.0), (20, -0.25), (0, -1.0)]}
    empty = ann.nearest(frame.limit(0))
    assert empty.columns == ["query_id", "rank", "vec_id", "score"] and empty.collect() == []
    assert ann.nearest(frame.filter("vec_id = 1")).collect() == []


@pytest.mark.parametrize("length", [32, 7, 1])
def test_ranges_share_the_prefix(length):
    rng = np.random.default_rng(3)
    vectors = rng.standard_normal((500, 16))
    forest = ann.Forest.build(np.arange(500), vectors, ann.projections(16, 3))
    strings = ann.hash_strings(vectors[:5], forest.planes)
    low, high = forest.ranges(strings, length)
    for t in range(3):
        for q in range(5):
            alike = (forest.codes[t] >> np.uint32(32 - length)) == (strings[t, q] >> np.uint32(32 - length))
            assert np.flatnonzero(alike).tolist() == list(range(low[t, q], high[t, q]))

"""The pipeline's stages, each judged on its own input."""

import re
from collections import Counter, defaultdict

import corpus_pipeline
import pytest

from tripwise.llm import quality
from tripwise.llm.common import written

from .test_mixing import resharing
from .test_neardup import brute_force
from .test_packing import check as check_packing


@pytest.fixture(scope="module")
def steps(spark, sf_dir):
    folder = sf_dir.replace("sf0.001", "sf0.01")
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out.append(docs)
        docs = written(stage(spark, docs, folder), f"test-pipeline-{number}")
    return [*out, docs]


def ids(frame):
    return Counter(r.doc_id for r in frame.select("doc_id").collect())


def test_columns(steps):
    assert [s.columns for s in steps[:5]] == [steps[0].columns] * 5
    assert len(corpus_pipeline.STAGES) == 5


def test_quality(steps):
    want = Counter(r.doc_id for r in quality.judge(steps[0]).filter("kept").collect())
    assert ids(steps[1]) == want and 0 < sum(want.values()) < steps[0].count()


def test_toxicity(spark, sf_dir, steps):
    labels = spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.01')}/labels.parquet")
    before, after = ids(steps[1]), ids(steps[2])
    assert not after - before
    gone = before - after
    known = {r.doc_id: r.toxic for r in labels.collect() if r.doc_id in before}
    toxic, clean = [d for d, t in known.items() if t == 1], [d for d, t in known.items() if t == 0]
    assert sum(d in gone for d in toxic) >= 0.7 * len(toxic)
    assert sum(d in gone for d in clean) <= 0.01 * len(clean)


def test_near_duplicates(steps):
    rows = [(r.doc_id, r.text) for r in steps[2].collect()]
    want = Counter({c for _, _, c in brute_force(rows)})
    assert ids(steps[3]) == want


def test_mixing(steps):
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    source_of = {r.doc_id: (r.source, words(r.text)) for r in steps[3].collect()}
    copies = ids(steps[4])
    assert set(copies) <= set(source_of) and max(copies.values()) <= 3
    sizes, taken = defaultdict(int), defaultdict(int)
    for d, (s, n) in source_of.items():
        sizes[s] += n
        taken[s] += n * copies[d]
    for s, target in resharing(sizes).items():
        own = [(n, copies[d]) for d, (t, n) in source_of.items() if t == s and n]
        short = [n for n, c in own if c == min(c for _, c in own)]
        assert abs(target - taken[s]) <= min(short) / 2 + 1 or taken[s] > target and any(2 * (taken[s] - target) < n for n, c in own if c == max(c for _, c in own))


def test_packing(steps):
    rows = [(r.doc_id, r.text) for r in steps[4].collect()]
    got = steps[5].collect()
    bins = check_packing(rows, got, 4096)
    assert bins <= -(-sum(r.length for r in got) // 4096) + 3


def test_empty_input(spark, sf_dir, steps):
    docs = steps[0].limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert docs.collect() == []


def test_edge_rows(spark, sf_dir, steps):
    """Nulls, empty and long texts, repeats, ties and clashing names, through
    each stage on its own and all in turn."""
    a, b, c = [t for t, in steps[3].select("text").distinct().orderBy("text").limit(3).collect()]
    near = " ".join(a.split()[:-1] + ["changed"]) if len(a.split()) > 60 else a + " "
    long = " ".join(f"{w}{k % 7}" for k, w in enumerate((a + " " + b + " " + c).split() * 40))
    rows = [(1, a, "x"), (1, a, "x"), (2, near, None), (None, b, "x"), (None, b, "x"), (3, None, "y"), (4, "", None), (5, long, "y"), (None, None, None), (6, c, "z"), (7, c, "z")]
    extra = "row string, key long, cid string, label int, text_hash string, `_0` string, up_to int, `__mix_source` string, uid long"
    wide = [(d, t, "en", s, 1, "r", 1, "c", 2, "h", "z", 3, "m", 4) for d, t, s in rows]
    docs = spark.createDataFrame(wide, "doc_id long, text string, lang string, source string, n_chars long, " + extra)
    given = Counter((r.doc_id, r.text) for r in docs.collect())
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, sf_dir)
        found = out.collect()
        assert out.columns == docs.columns and {(r.doc_id, r.text) for r in found} <= set(given), name
        assert all(tuple(r)[5:] == wide[0][5:] for r in found), name
        if name in ("quality rules", "toxicity"):
            assert not Counter((r.doc_id, r.text) for r in found) - given, name
        if name == "near-duplicates":
            worded = sorted((r.doc_id is None, r.doc_id or 0, (r.text or "")[:20]) for r in found if (r.text or "").strip())
            assert worded == sorted([(False, 1, a[:20]), (True, 0, b[:20]), (False, 5, long[:20]), (False, 6, c[:20])])
    pieces = corpus_pipeline.STAGES[4][1](spark, docs, sf_dir).collect()
    check_packing([(d, t) for d, t, _ in rows], pieces, 4096)
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = written(stage(spark, docs, sf_dir), f"test-edge-{number}")
    assert docs.columns[:3] == ["doc_id", "piece", "start"]

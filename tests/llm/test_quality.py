"""The rule ledger against plain Python and against its SQL."""

import re
from collections import Counter

import duckdb
from compare import compare, duck_connect

from tripwise.llm import quality


def expected(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    found = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if found[tuple(words[i:i + 3])] > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


def check(rows, got):
    base = lambda t: (lambda m: m[0] < 50 or 100 * m[4] > 50 * m[0])(expected(t))
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == Counter(
        (d, *expected(t), base(t)) for d, t in rows)
    assert not any(r.kept and r.base_failed for r in got)


EDGE = [(1, None), (2, ""), (None, " \n\t\x0b "), (3, "a b c a b c"), (4, "x x x x x"), (5, " a\x0bb\x0cc \n\n a\x0bb\x0cc"),
        (6, "é ñ ü #*$%&|<> 日本　語 \xa0"), (7, "one two three " * 9000), (8, "l\nl\n l\nl \nm"), (8, "l\nl\n l\nl \nm"), (9, "w " * 70 + "!" * 50)]


def test_edge_rows(spark):
    docs = spark.createDataFrame([(d, t, 3, 4) for d, t in EDGE], "doc_id long, text string, n_words int, failed int")
    check(EDGE, quality.judge(docs).collect())
    assert quality.judge(docs.limit(0)).collect() == []
    assert quality.keep(docs).columns == docs.columns


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    check([(r.doc_id, r.text) for r in docs.collect()], quality.judge(docs).collect())


def test_oracle(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ok, why = compare(quality.judge(docs), quality.oracle(), duck_connect(sf_dir))
    assert ok, why


def test_oracle_on_edge_rows(spark):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", EDGE)
    ok, why = compare(quality.judge(spark.createDataFrame(EDGE, "doc_id long, text string")), quality.oracle(), con)
    assert ok, why


def test_keep_agrees_with_ledger(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = sorted(r.doc_id for r in quality.judge(docs).filter("kept").collect())
    assert sorted(r.doc_id for r in quality.keep(docs).collect()) == want


def test_labels(spark, sf_dir):
    """Junk goes, clean documents of base quality stay."""
    docs, labels = (spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.01')}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.judge(docs).join(labels, "doc_id").filter("NOT base_failed").collect()
    clean, junk = [r for r in rows if r.quality == 1], [r for r in rows if r.quality == 0]
    assert all(r.kept for r in clean)
    assert sum(not r.kept for r in junk) >= 0.9 * len(junk)


def test_ablation(spark, sf_dir):
    entries = quality.ledger(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    policy, masks = quality.POLICIES[2], [r.failed for r in entries.collect()]

    def rejects(p, m):
        return bool(m & p.hard) or (p.soft and bin(m & p.soft).count("1") >= p.most_soft)

    for r in quality.ablation(entries, policy).collect():
        less = policy.without(r.rule)
        assert r.failed == sum(bool(m & quality.BIT[r.rule]) for m in masks)
        assert r.rejected_alone == sum(rejects(policy, m) and not rejects(less, m) for m in masks)
        assert r.kept_without == sum(not rejects(less, m) for m in masks)
    for r in quality.overlaps(entries).collect():
        own = [m for m in masks if m & quality.BIT[r.rule]]
        assert all(m & r.never_without == r.never_without and m | r.ever_with == r.ever_with for m in own)
    assert len(quality.ablation(entries.limit(0), policy).collect()) == len(quality.RULES)

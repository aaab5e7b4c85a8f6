"""Near-duplicate classes with SetSketch registers.

A text's set is its distinct 5-word shingles.  Each of the sketch's registers
keeps a truncated, exponentially spaced minimum of hashed shingles; registers
merge by maximum, and two sketches agree in a register about as often as the
sets' Jaccard similarity.  Texts of equal words form one class.  Classes that
agree in all registers of some band are compared: the joint similarity is
estimated from the registers by maximum likelihood, pairs that may reach the
threshold are verified on their full sets, and verified links are joined into
components.

A bucket never gives all its pairs.  First every class is verified against
the most similar of its buckets' representatives only.  After that, only pairs
from different components are looked at, in blocks of bounded size: the
likelihood tells which classes may have a partner there, and these bring their
whole sets to the block, where they are compared and joined in place.  Rows so
grow with the classes and not with their pairs, a group of thousands of near
copies costs one link for each, and no candidate pair between different
components is left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .shingles import mixed, odd_numbers, shingle_hashes, word_hashes

REGISTERS, BAND = 252, 6
#: Register spacing, rate and range: value k stands for minima near BASE ** -k / RATE.
BASE, RATE, TOP = 1.001, 20.0, (1 << 16) - 2
PERCENT = 75
#: Pairs go on to verification if their estimated similarity is at least this:
#: seven standard errors of the estimate below the threshold.
LIKELY = 0.55
BLOCK = 256


# ---- sketches ---------------------------------------------------------------

def registers(least: np.ndarray) -> np.ndarray:
    """Register values of 64-bit minima: the minimum of n hashes is read as
    the minimum of n exponential variables of rate RATE."""
    u = (least.astype(np.float64) + 0.5) / 2.0 ** 64
    x = -np.log1p(-np.minimum(u, 1 - 1e-16)) / RATE
    return np.clip(np.floor(1 - np.log(x) / np.log(BASE)), 0, TOP + 1).astype("<u2")


def sketch(hashes: np.ndarray, offsets: np.ndarray, count: int = REGISTERS) -> np.ndarray:
    """[texts, count] registers of the texts' shingles (none: all 0)."""
    out = np.zeros((len(offsets) - 1, count), "<u2")
    full = np.flatnonzero(np.diff(offsets))
    if not len(full):
        return out
    factors = odd_numbers(count, 7)
    # Texts are done some at a time, so that the hashes stay in the cache.
    at = 0
    while at < len(full):
        end = max(int(np.searchsorted(offsets, offsets[full[at]] + 32_768)) - 1, full[at] + 1)
        group = full[at:np.searchsorted(full, end)]
        a, b = offsets[group[0]], offsets[group[-1] + 1]
        part, starts = hashes[a:b], offsets[group] - a
        least = np.empty((len(factors), len(group)), np.uint64)
        held = np.empty_like(part)
        for k, factor in enumerate(factors):
            np.multiply(part, factor, out=held)
            least[k] = np.minimum.reduceat(held, starts)
        out[group] = registers(least).T
        at += len(group)
    return out


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union of two sets."""
    return np.maximum(a, b)


def estimate(more: np.ndarray, less: np.ndarray, equal: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Most likely similarity, given in how many registers a is above b, below
    and equal, and the sets' sizes.  With u = n_a / (n_a + n_b), v = 1 - u a
    register of a is above with probability p(u - v J), below with
    p(v - u J), where p(x) = -log_b(1 - x (b - 1) / b)."""
    u = n_a / (n_a + n_b)
    v = 1 - u
    p = lambda x: -np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE)

    def likelihood(j):
        above, below = np.maximum(p(u - v * j), 1e-12), np.maximum(p(v - u * j), 1e-12)
        return more * np.log(above) + less * np.log(below) + equal * np.log(np.maximum(1 - above - below, 1e-12))

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(24):  # the likelihood has one maximum: narrow by thirds
        a, b = low + (high - low) / 3, high - (high - low) / 3
        left = likelihood(a) > likelihood(b)
        low, high = np.where(left, low, a), np.where(left, b, high)
    return (low + high) / 2


def similar(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Estimated similarity of row pairs of registers; 0 where the sizes alone
    rule the threshold out."""
    out = np.zeros(len(a))
    near = np.flatnonzero(100 * np.minimum(n_a, n_b) >= PERCENT * np.maximum(n_a, n_b))
    equal = (a[near] == b[near]).sum(1)
    # The share of equal registers is a rough estimate already: far below
    # the mark the likelihood need not be looked at.
    close = equal >= (LIKELY - 0.15) * a.shape[1]
    near, equal = near[close], equal[close]
    if len(near):
        more = (a[near] > b[near]).sum(1)
        out[near] = estimate(more, a.shape[1] - more - equal, equal, n_a[near].astype(float), n_b[near].astype(float))
    return out


# ---- stages -----------------------------------------------------------------

def sketched(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, class_hi, class_lo (128 bits of the word sequence),
    n_shingles (of the set), registers; a text without words has no class."""
    common.bounded_batches(docs.sparkSession, rows=1000, size=4 << 20)

    def run(batches):
        schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("class_hi", pa.int64()),
                            ("class_lo", pa.int64()), ("n_shingles", pa.int64()), ("registers", pa.binary())])
        for batch in common.lean(batches):
            hashes, offsets, sizes, high, low = sets_of(batch.column("text"))
            rows = sketch(hashes, offsets)
            empty = sizes == 0
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("text_hash"), pa.array(high, pa.int64(), mask=empty), pa.array(low, pa.int64(), mask=empty),
                pa.array(sizes, pa.int64()), pa.array([r.tobytes() for r in rows], pa.binary(), mask=empty)], schema=schema)

    return texts_of(docs).mapInArrow(
        run, "doc_id long, text_hash long, class_hi long, class_lo long, n_shingles long, registers binary")


def texts_of(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, text: id and hash name a text, also without an id."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")


def sets_of(texts: pa.Array):
    """(distinct shingle hashes, offsets, set sizes, two 64-bit hashes of each
    text's word sequence)."""
    words, at = word_hashes(texts)
    hashes, offsets = shingle_hashes(words, at)
    # Distinct within each text: sort by text, then hash.
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    order = np.lexsort((hashes, row))
    hashes, row = hashes[order], row[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
    sizes = np.bincount(row[new], minlength=len(offsets) - 1).astype(np.int64)
    # The sequence: a sum over words weighted by powers of an odd number.
    whole = []
    for seed in (21, 22):
        place = np.arange(len(words)) - np.repeat(at[:-1], np.diff(at))
        longest = int(np.diff(at).max()) if len(at) > 1 else 0
        powers = np.full(longest + 1, odd_numbers(1, seed)[0], np.uint64)
        powers[0] = 1
        powers = np.cumprod(powers, dtype=np.uint64)
        terms = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(mixed(words + np.uint64(seed)) * powers[place], dtype=np.uint64, out=terms[1:])
        counts = np.diff(at).astype(np.uint64)
        whole.append(mixed(terms[at[1:]] - terms[at[:-1]] + counts * np.uint64(0x9E3779B97F4A7C15)).view(np.int64))
    return hashes[new], np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64), sizes, whole[0], whole[1]


def classes_of(rows: DataFrame) -> DataFrame:
    """One row per class (texts of equal words): cid, its first member (the
    smallest doc_id, null ids last), n_shingles, registers."""
    # Which of the equal sketches is kept does not matter.
    member = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")
    found = (rows.filter(F.col("class_hi").isNotNull()).groupBy("class_hi", "class_lo")
             .agg(F.min(member).alias("least"), F.first("n_shingles").alias("n_shingles"), F.first("registers").alias("registers")))
    return common.written(found.withColumn("cid", F.monotonically_increasing_id()), "neardup-classes")


def banded(classes: DataFrame) -> DataFrame:
    """cid, key: the buckets of every class.  A set of a single shingle can
    only equal another one, but classes of different sequences may have it (a
    word repeated 5, 6, ... times): they meet by all their registers at once."""
    wide = 2 * BAND
    keys = [F.xxhash64(F.lit(k), F.substring("registers", k * wide + 1, wide)) for k in range(REGISTERS // BAND)]
    own = F.when(F.col("n_shingles") > 1, F.array(*keys)).otherwise(F.array(F.xxhash64(F.lit(len(keys)), "registers")))
    return classes.select("cid", F.explode(own).alias("key"))


def likely_pairs(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """a, b, likeness of the pairs that may reach the threshold."""
    def run(batches):
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("likeness", pa.float64())])
        for batch in common.lean(batches):
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(-1, REGISTERS) for c in ("ra", "rb"))
            found = similar(x, y, batch.column("na").to_numpy(), batch.column("nb").to_numpy())
            keep = pa.array(found >= LIKELY)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(found)], schema=schema).filter(keep)

    side = lambda n: classes.select(F.col("cid").alias(n), F.col("registers").alias(f"r{n}"), F.col("n_shingles").alias(f"n{n}"))
    rows = pairs.join(side("a").hint("merge"), "a").join(side("b").hint("merge"), "b").select("a", "b", "ra", "rb", "na", "nb")
    return rows.mapInArrow(run, "a long, b long, likeness double")


def texts_of_classes(cids: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """cid, text of the classes named (cid, distinct), written once."""
    wanted = cids.join(classes.select("cid", "least.text_hash", F.col("least.doc_id").alias("id")), "cid")
    met = wanted.join(texts_of(docs).hint("merge"), "text_hash").filter(F.col("id").eqNullSafe(F.col("doc_id")))
    return common.written(met.select("cid", "text").dropDuplicates(["cid"]), "neardup-texts")


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b, and what else they carry) whose full sets reach the
    threshold."""
    carried = pairs.schema

    def confirm(batches):
        for batch in common.lean(batches):
            left, lo, ln, _, _ = sets_of(batch.column("ta"))
            right, ro, rn, _, _ = sets_of(batch.column("tb"))
            row = lambda o: np.repeat(np.arange(len(o) - 1), np.diff(o))
            both = np.concatenate([left, right])
            rows = np.concatenate([row(lo), row(ro)])
            order = np.lexsort((both, rows))
            both, rows = both[order], rows[order]
            twice = (both[1:] == both[:-1]) & (rows[1:] == rows[:-1])
            shared = np.bincount(rows[1:][twice], minlength=len(ln))
            linked = 100 * shared >= PERCENT * (ln + rn - shared)
            yield batch.select(carried.names).filter(pa.array(linked))

    side = lambda n: texts.select(F.col("cid").alias(n), F.col("text").alias(f"t{n}"))
    rows = pairs.join(side("a").hint("merge"), "a").join(side("b").hint("merge"), "b")
    return rows.select(*carried.names, "ta", "tb").mapInArrow(confirm, carried)


def roots(links: DataFrame) -> DataFrame:
    """cid, label of every class that has a parent: links (a, b) give each b
    one smaller a, and pointers are doubled until all are roots."""
    found = common.written(links.select(F.col("b").alias("cid"), F.col("a").alias("label")), "neardup-roots")
    while True:
        up = found.select(F.col("cid").alias("label"), F.col("label").alias("up"))
        step = common.written(found.join(up, "label", "left").select(
            "cid", F.coalesce("up", "label").alias("label"), F.col("up").isNotNull().alias("moved")), "neardup-roots")
        found = step.select("cid", "label")
        if step.filter("moved").isEmpty():
            return found


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` after the components x and y of each link have become one."""
    found = common.written(components(links.select(F.col("x").alias("a"), F.col("y").alias("b"))).filter("cid <> label"), "neardup-merged")
    up = found.select(F.col("cid").alias("label"), F.col("label").alias("up"))
    moved = labels.join(up, "label", "left").select("cid", F.coalesce("up", "label").alias("label"))
    return common.written(moved.unionByName(found.select("cid", "label")), "neardup-labels")


def with_label(rows: DataFrame, labels: DataFrame, cid: str = "cid", label: str = "label") -> DataFrame:
    """``rows`` with the component of ``cid``; classes that are not listed
    are the root of their own."""
    named = labels.select(F.col("cid").alias(cid), F.col("label").alias("__label"))
    return rows.join(named.hint("merge"), cid, "left").withColumn(label, F.coalesce("__label", cid)).drop("__label")


def components(links: DataFrame) -> DataFrame:
    """cid, label (the component's smallest cid) of all linked classes, by
    alternating large-star and small-star rounds: links are moved to ever
    smaller nodes until every component is a star.  No component is gathered
    anywhere; each round is written, which cuts the lineage."""
    edges = common.written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "neardup-links")
    before = None
    while True:
        mark = tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
        if mark == before:
            return edges.select(F.col("u").alias("cid"), F.col("v").alias("label")).union(edges.select("v", "v").distinct())
        before = mark
        # Larger neighbours of a node are linked to its smallest neighbour.
        ends = edges.union(edges.select("v", "u"))
        smallest = ends.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = common.written(ends.join(smallest, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "neardup-large")
        # Smaller neighbours, and the node, are linked to the smallest one.
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(smallest, "u").select(F.inline(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u").alias("u"), F.col("m").alias("v")))))
        edges = common.written(moved.filter("u > v").distinct(), "neardup-small")


def open_members(buckets: DataFrame, labels: DataFrame, classes: DataFrame) -> DataFrame:
    """Rows of the classes that have a likely partner of another component
    in one of their buckets: key, blocks, block, p, q (the pair of blocks it
    was met in), cid, label, n_shingles.

    Buckets with a single component are done.  The others are cut into blocks
    of at most BLOCK classes in expectation, and each pair of blocks is one
    row group of bounded size, whose registers are compared as matrices.
    Only members come out, not their pairs."""
    marked = common.written(with_label(buckets, labels), "neardup-marked")
    mixed_keys = (marked.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.count("*").alias("n"))
                  .filter("x < y").select("key", F.expr(f"CAST(ceil(n / {BLOCK}) AS INT)").alias("blocks")))
    rows = common.written(marked.join(mixed_keys.hint("merge"), "key"), "neardup-mixed")
    # Buckets of one block share a row group; larger ones have their own.
    groups = max(1, -(-rows.count() // (8 * BLOCK)))
    rows = (rows.withColumn("cell", own_cell(groups)).withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
            .join(classes.select("cid", "n_shingles", "registers").hint("merge"), "cid"))
    # A block meets itself and every other block once.
    both = F.expr("transform(sequence(0, blocks - 1), o -> struct(least(block, o) AS p, greatest(block, o) AS q))")
    names = ["key", "blocks", "block", "p", "q", "cid", "label", "n_shingles"]

    def compare(group, table):
        label, n, block, key = (table.column(c).to_numpy() for c in ("label", "n_shingles", "block", "key"))
        held = np.frombuffer(b"".join(table.column("registers").to_pylist()), "<u2").reshape(-1, REGISTERS)
        p, q = group[2].as_py(), group[3].as_py()
        order = np.argsort(key, kind="stable")
        near = np.zeros(len(key), bool)
        for bucket in np.split(order, np.flatnonzero(np.diff(key[order])) + 1):
            left, right = bucket[block[bucket] == p], bucket[block[bucket] == q]
            for at in range(0, len(left), 16):
                i, j = (x.ravel() for x in np.meshgrid(left[at:at + 16], right, indexing="ij"))
                fit = (label[i] != label[j]) & ((i < j) | (p != q)) & (100 * np.minimum(n[i], n[j]) >= PERCENT * np.maximum(n[i], n[j]))
                fit &= ~(near[i] & near[j])
                i, j = i[fit], j[fit]
                likely = similar(held[i], held[j], n[i], n[j]) >= LIKELY
                near[i[likely]] = True
                near[j[likely]] = True
        return table.filter(pa.array(near)).select(names)

    cells = rows.select("key", "cell", "blocks", "block", "cid", "label", "n_shingles", "registers", F.explode(both).alias("c"))
    found = cells.select("*", F.col("c.p").alias("p"), F.col("c.q").alias("q"), (F.col("blocks") == 1).alias("small")).drop("c")
    return common.written(found.groupBy("cell", "small", "p", "q").applyInArrow(
        compare, "key long, blocks int, block int, p int, q int, cid long, label long, n_shingles long"), "neardup-open")


def own_cell(groups: int):
    """The row group of a bucket: shared by buckets of one block."""
    return F.when(F.col("blocks") == 1, F.pmod("key", F.lit(groups))).otherwise(F.col("key"))


def across_components(members: DataFrame, texts: DataFrame) -> DataFrame:
    """x, y: components that a verified link between two of ``members``
    joins.

    Each pair of blocks gets its members' whole sets and compares them
    exactly, but only pairs whose components differ still: links found in a
    row group join components there at once, and only such links come out,
    fewer than the row group has components."""
    def sets(batches):
        schema = pa.schema([("cid", pa.int64()), ("shingles", pa.binary())])
        for batch in common.lean(batches):
            hashes, offsets, *_ = sets_of(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("cid"), pa.array(
                [hashes[a:b].tobytes() for a, b in zip(offsets, offsets[1:])], pa.binary())], schema=schema)

    wanted = texts.join(members.select("cid").distinct().hint("merge"), "cid")
    held = common.written(wanted.mapInArrow(sets, "cid long, shingles binary"), "neardup-sets")
    # Row groups of about a million shingles, or of one bucket or pair of blocks.
    total, = members.agg(F.coalesce(F.sum("n_shingles"), F.lit(0))).first()
    rows = members.withColumn("cell", own_cell(max(1, -(-total // (1 << 20))))).withColumn("small", F.col("blocks") == 1)

    def settle(group, table):
        label, block, key = (table.column(c).to_numpy() for c in ("label", "block", "key"))
        sizes = np.array([len(x.as_buffer()) // 8 for x in table.column("shingles")])
        _, ids = np.unique(np.frombuffer(b"".join(table.column("shingles").to_pylist()), "<u8"), return_inverse=True)
        ends = np.cumsum(sizes)
        marked = np.zeros(len(ids), np.int32)
        names, own = np.unique(label, return_inverse=True)
        root = np.arange(len(names))
        p, q = group[2].as_py(), group[3].as_py()
        order, links = np.argsort(key, kind="stable"), []
        for bucket in np.split(order, np.flatnonzero(np.diff(key[order])) + 1):
            left, right = bucket[block[bucket] == p], bucket[block[bucket] == q]
            if not len(right):
                continue
            theirs = np.concatenate([ids[ends[j] - sizes[j]:ends[j]] for j in right])
            starts = np.concatenate([[0], np.cumsum(sizes[right])[:-1]])
            for i in left:
                fit = (root[own[right]] != root[own[i]]) & (100 * np.minimum(sizes[right], sizes[i]) >= PERCENT * np.maximum(sizes[right], sizes[i]))
                if p == q:
                    fit &= right > i
                if not fit.any():
                    continue
                mine = ids[ends[i] - sizes[i]:ends[i]]
                marked[mine] = 1
                shared = np.add.reduceat(marked[theirs], starts)
                marked[mine] = 0
                for j in right[fit & (100 * shared >= PERCENT * (sizes[right] + sizes[i] - shared))]:
                    if root[own[j]] != root[own[i]]:
                        root[root == root[own[j]]] = root[own[i]]
                        links.append((min(label[i], label[j]), max(label[i], label[j])))
        return pa.table({"x": pa.array([a for a, _ in links], pa.int64()), "y": pa.array([b for _, b in links], pa.int64())})

    found = rows.join(held.hint("merge"), "cid").groupBy("cell", "small", "p", "q").applyInArrow(settle, "x long, y long")
    return common.written(found.distinct(), "neardup-verified")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept (and text_hash, first) per row.

    Texts without words are linked with nothing and are their own component.
    Repeated rows belong to one class.  Null ids come last: a component has
    the name null, and no row that is ``kept``, only if all its ids are."""
    rows = common.written(sketched(docs), "neardup-rows")
    classes = classes_of(rows)
    buckets = banded(classes)
    heads = buckets.groupBy("key").agg(F.min("cid").alias("a"), F.count("*").alias("n")).filter("n > 1").select("key", "a")
    shared = common.written(buckets.join(heads.hint("merge"), "key"), "neardup-buckets")
    # Every class against its buckets' smallest class; the likeliest is verified.
    stars = shared.filter("cid > a").select("a", F.col("cid").alias("b")).distinct()
    buckets = shared.select("key", "cid")
    likely = common.written(likely_pairs(stars, classes), "neardup-stars")
    best = likely.groupBy("b").agg(F.max_by("a", F.struct("likeness", F.negative("a"))).alias("a"))
    tried = common.written(best.select("a", "b"), "neardup-tried")
    texts = texts_of_classes(buckets.select("cid").distinct(), classes, docs)
    labels = roots(verified(tried, texts))
    members = open_members(buckets, labels, classes)
    if not members.isEmpty():
        labels = merged(labels, across_components(members, texts))
    return named(rows, classes, labels)


def named(rows: DataFrame, classes: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, and the row's text_hash and
    whether it is of its component's first member (``first``)."""
    members = with_label(classes, labels)
    firsts = members.groupBy("label").agg(F.min("least").alias("head"))
    of_class = members.select("class_hi", "class_lo", "label").join(firsts, "label").drop("label")
    own = rows.drop("registers")
    worded = own.filter(F.col("class_hi").isNotNull()).join(of_class.hint("merge"), ["class_hi", "class_lo"])
    first = F.col("doc_id").eqNullSafe(F.col("head.doc_id")) & (F.col("text_hash") == F.col("head.text_hash"))
    worded = worded.select("doc_id", "text_hash", "n_shingles", F.col("head.doc_id").alias("component_id"), first.alias("first"))
    blank = own.filter(F.col("class_hi").isNull()).select(
        "doc_id", "text_hash", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("first"))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    return worded.unionByName(blank).withColumn("kept", kept)


def digest(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept")


def keep(docs: DataFrame) -> DataFrame:
    """One row of each component, and all rows without words; columns as in
    ``docs``.  Of rows that repeat the first member one stays."""
    own = F.struct(*[F.col(c).alias(f"_{k}") for k, c in enumerate(docs.columns)]).alias("row")
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("none")).alias("id"), F.xxhash64("text").alias("text_hash"), own)
    worded = near_duplicates(docs).filter("first AND n_shingles > 0").select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("none")).alias("id"), "text_hash").distinct()
    words = F.btrim(F.coalesce(F.col(f"row._{docs.columns.index('text')}"), F.lit("")), F.lit(common.BLANKS)) != ""
    one = rows.filter(words).join(worded.hint("merge"), ["id", "text_hash"]).dropDuplicates(["id", "text_hash"])
    out = one.select("row").union(rows.filter(~words).select("row"))
    return out.select(*[F.col(f"row._{k}").alias(c) for k, c in enumerate(docs.columns)])

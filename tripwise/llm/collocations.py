"""Phrase collocations from a weighted de Bruijn graph.

Nodes are word pairs, edges the word triples that lead from one pair to the
next, both within pieces of text and kept apart by language.  A node or edge
that stands fewer than ``min_count`` times takes no part, and nearly all of
them do, so they are found before anything is spelt out:

* **Names.**  The words of a few megabytes of text are coded once against
  that chunk's own vocabulary.  A chunk asks with the hashed names of its
  distinct words, pairs and triples and how often it has them; the names are
  dealt to buckets by their leading bits, so a frequent word, pair or language
  spreads over all buckets, and a bucket answers by one bit a name.  Names
  that fall together only add up, so no frequent gram is ever turned away.
* **Counts.**  What is left, a small part, is counted by its words, exactly;
  what only shared a name falls out there.

Pairs that are entered by one edge and left by one, with no piece beginning or
ending in them, are unary: maximal runs of them are compacted into paths.
Inside a path all counts are equal, so its grams need no look at other tables.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .shingles import mixed, odd_numbers

MIN_COUNT, LONGEST, PERCENT, TOP = 10, 3, 50, 2000
#: Bytes of text in a chunk, and at most so many grams in a bucket in expectation.
CHUNK, BUCKET = 8 << 20, 1 << 21

CODED = "chunk long, lang string, words long, codes binary, vocabulary binary"
CODED_SCHEMA = pa.schema([("chunk", pa.int64()), ("lang", pa.string()), ("words", pa.int64()), ("codes", pa.binary()), ("vocabulary", pa.binary())])
ASK_SCHEMA = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("names", pa.binary()), ("counts", pa.binary())])
GRAM_SCHEMA = pa.schema([("lang", pa.string()), ("x", pa.string()), ("y", pa.string()), ("z", pa.string()), ("n", pa.int64())])

# Classes of bytes: 0 of words, 1 between words, 2 between pieces.
CLASS = np.zeros(256, np.uint8)
CLASS[[0x20, 0x09]] = 1
CLASS[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
BYTES = odd_numbers(256, 30)


# ---- words ------------------------------------------------------------------

def words_of(texts: list[bytes]):
    """(codes of all words, vocabulary, piece of each word) of texts."""
    data = np.frombuffer(b"\n".join(texts).translate(LOWER), np.uint8)
    kinds = CLASS[data]
    inside = np.concatenate([[False], kinds == 0, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    pieces = np.cumsum(kinds == 2)[starts] if len(starts) else starts
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    flat = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data[kinds == 0].tobytes()))
    coded = flat.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary.cast(pa.string()), pieces


def summed(grams: np.ndarray, n: np.ndarray, vocabulary: int):
    """The distinct columns of ``grams`` [words, places] in order, and the
    sums of n."""
    if not grams.shape[1]:
        return grams, n
    bits = max(1, int(vocabulary - 1).bit_length())
    if bits * len(grams) <= 63:
        key = grams[0]
        for g in grams[1:]:
            key = (key << bits) | g
        order = np.argsort(key)
    else:
        order = np.lexsort(grams[::-1])
    grams, n = grams[:, order], n[order]
    at = np.flatnonzero(np.concatenate([[True], (grams[:, 1:] != grams[:, :-1]).any(0)]))
    return grams[:, at], np.add.reduceat(n, at)


def hashed(vocabulary: pa.Array) -> np.ndarray:
    """A 64-bit hash of every word: its bytes' values, each times a factor of
    its place."""
    lengths = pc.binary_length(vocabulary).to_numpy(zero_copy_only=False).astype(np.int64)
    starts = np.cumsum(lengths) - lengths
    data = np.frombuffer(pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(lengths)], pa.int32()), vocabulary), "")[0].as_buffer(), np.uint8)
    places = (np.arange(len(data)) - np.repeat(starts, lengths)).astype(np.uint64)
    return mixed(np.add.reduceat(BYTES[data] * mixed(places + np.uint64(1)), starts))


# ---- chunks -----------------------------------------------------------------

def packed(chunk: int, lang: str, codes: np.ndarray, vocabulary: pa.Array, pieces: np.ndarray) -> pa.RecordBatch:
    """One row: the codes of the words, 0 between pieces, and the words that
    1, 2, ... stand for, compressed."""
    codes = np.insert(codes + 1, np.flatnonzero(np.diff(pieces)) + 1, 0).astype("<u4")
    spelt = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(vocabulary)], pa.int32()), vocabulary), " ")[0].as_buffer()
    blobs = [np.array([len(b)], "<u8").tobytes() + pa.Codec("zstd", 1).compress(b, asbytes=True) for b in (codes.tobytes(), spelt.to_pybytes())]
    row = (chunk, lang, int(np.count_nonzero(codes)), *blobs)
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, CODED_SCHEMA)], schema=CODED_SCHEMA)


def coded(docs: DataFrame, chunk_bytes: int) -> DataFrame:
    """One row per chunk of one language's texts.  Written, as answers are
    matched with a chunk's names by their order."""
    plain = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("data"))

    def run(batches):
        held, sizes, made = {}, {}, TaskContext.get().partitionId() << 32

        def chunk(lang):
            nonlocal made
            made += 1
            sizes.pop(lang)
            return packed(made, lang, *words_of(held.pop(lang)))

        for batch in batches:
            for lang, data in zip(batch.column("lang").to_pylist(), batch.column("data").to_pylist()):
                held.setdefault(lang, []).append(data)
                sizes[lang] = sizes.get(lang, 0) + len(data)
                # Large chunks share more words; with many languages the
                # largest goes first.
                full = lang if sizes[lang] >= chunk_bytes else max(sizes, key=sizes.get) if sum(sizes.values()) >= 4 * chunk_bytes else None
                if full is not None:
                    yield chunk(full)
        for lang in list(held):
            yield chunk(lang)

    return common.written(plain.mapInArrow(run, CODED), "colloc-chunks")


class Chunk:
    """A chunk's words and the names of its grams: ``buckets`` times a hash
    as a fraction, the bucket above 32 bits of the rest."""

    def __init__(self, row, buckets):
        import xxhash

        unpack = lambda blob: pa.Codec("zstd", 1).decompress(blob[8:], int(np.frombuffer(blob, "<u8", 1)[0]))
        self.lang, self.buckets = row["lang"], np.uint64(buckets)
        self.codes = np.frombuffer(unpack(row["codes"]), "<u4").astype(np.int64) - 1
        self.vocabulary = pc.split_pattern(pa.array([unpack(row["vocabulary"]).to_pybytes()]).cast(pa.string()), " ")[0].values
        self.known = hashed(self.vocabulary)
        self.salt = xxhash.xxh3_64_intdigest(self.lang)

    def places(self, kind: int) -> np.ndarray:
        """Where ``kind`` words stand in one piece."""
        word = self.codes >= 0
        here = word[:max(0, len(word) - kind + 1)]
        for k in range(1, kind):
            here = here & word[k:len(word) - kind + 1 + k]
        return np.flatnonzero(here)

    def names(self, kind: int, at: np.ndarray) -> np.ndarray:
        total = np.full(len(at), self.salt, np.uint64)
        for k, factor in enumerate(odd_numbers(kind, 31 + kind)):
            total += (self.known * factor)[self.codes[at + k]]
        return ((mixed(total) >> np.uint64(20)) * self.buckets) >> np.uint64(12)

    def distinct(self):
        """The distinct names of all grams in order and how often they stand here."""
        names = np.sort(np.concatenate([self.names(kind, self.places(kind)) for kind in range(1, LONGEST + 1)]))
        first = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1]]))
        return names[first], np.diff(np.append(first, len(names)))

    def grams(self, kind: int, at: np.ndarray):
        """Batches of the grams at some places, with their counts."""
        codes, n = summed(np.stack([self.codes[at + k] for k in range(kind)]), np.ones(len(at), np.int64), len(self.vocabulary))
        for a in range(0, len(n), 50_000):
            part, size = codes[:, a:a + 50_000], len(n[a:a + 50_000])
            words = [self.vocabulary.take(pa.array(c)) for c in part] + [pa.nulls(size, pa.string())] * (LONGEST - kind)
            lang = pa.array([self.lang]).take(pa.array(np.zeros(size, np.int64)))
            yield pa.RecordBatch.from_arrays([lang, *words, pa.array(n[a:a + 50_000])], schema=GRAM_SCHEMA)


# ---- counting ---------------------------------------------------------------

def cuts_of(names: np.ndarray) -> np.ndarray:
    """Bounds of the buckets among names in order."""
    bucket = names >> np.uint64(32)
    return np.concatenate([[0], np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, [len(names)]])


def asks_of(chunk: int, names: np.ndarray, n: np.ndarray, counts: str, most: int):
    """(bucket, chunk, lower 32 bits of the names, counts) of every bucket."""
    n, rest, cuts = np.minimum(n, most).astype(counts), names.astype("<u4"), cuts_of(names)
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield int(names[a] >> np.uint64(32)), chunk, rest[a:b].tobytes(), n[a:b].tobytes()


def answered(table: pa.Table, min_count: int, counts: str) -> pa.Table:
    """For one bucket's asks the bits of the names that all chunks together
    have ``min_count`` times."""
    blobs = [np.frombuffer(x, "<u4") for x in table.column("names").to_pylist()]
    n = np.concatenate([np.frombuffer(x, counts) for x in table.column("counts").to_pylist()])
    names = np.concatenate(blobs)
    order = np.argsort(names)
    names = names[order]
    first = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1]]))
    sums = np.add.reduceat(n[order], first, dtype=np.int64)
    bits = np.empty(len(names), bool)
    bits[order] = np.repeat(sums >= min_count, np.diff(np.append(first, len(names))))
    ends = np.cumsum([len(x) for x in blobs])
    return table.select(["chunk", "bucket"]).append_column("bits", pa.array(
        [np.packbits(bits[e - len(x):e]).tobytes() for e, x in zip(ends, blobs)], pa.binary()))


def frequent(chunks: DataFrame, min_count: int, bucket_grams: int) -> DataFrame:
    """lang, x, y, z, n of all words (y and z null), pairs (z null) and triples
    of at least ``min_count`` occurrences."""
    spark, chunks = chunks.sparkSession, chunks.filter("words > 0")
    total, = chunks.agg(F.coalesce(F.sum("words"), F.lit(0))).first()
    buckets = min(1 << 20, max(1, -(-LONGEST * total // bucket_grams)))
    # Counts up to the bound are enough to tell whether the sum reaches it.
    counts, most = ("<u1", 255) if min_count <= 255 else ("<u4", (1 << 32) - 1)

    def ask(batches):
        for batch in batches:
            for row in batch.to_pylist():
                asks = list(asks_of(row["chunk"], *Chunk(row, buckets).distinct(), counts, most))
                for k in range(0, len(asks), 64):
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*asks[k:k + 64]), ASK_SCHEMA)], schema=ASK_SCHEMA)

    def spell(batches):
        for batch in batches:
            for row in batch.to_pylist():
                chunk = Chunk(row, buckets)
                names, _ = chunk.distinct()
                cuts, bits = cuts_of(names), {a["bucket"]: a["bits"] for a in row["answers"]}
                names = np.concatenate([names[a:b][np.unpackbits(np.frombuffer(bits[int(names[a] >> np.uint64(32))], np.uint8), count=b - a).astype(bool)]
                                        for a, b in zip(cuts[:-1], cuts[1:])])
                if not len(names):
                    continue
                fit = np.ones(len(chunk.codes) + 1, bool)
                for kind in range(1, LONGEST + 1):
                    # The parts of a frequent gram are frequent.
                    at = chunk.places(kind)
                    at = at[fit[at] & fit[at + (kind > 1)]]
                    own = chunk.names(kind, at)
                    at = at[names[np.minimum(np.searchsorted(names, own), len(names) - 1)] == own]
                    fit[:] = False
                    fit[at] = True
                    if len(at):
                        yield from chunk.grams(kind, at)

    with common.batches_of(spark, rows=8):
        asks = chunks.select("chunk", "lang", "codes", "vocabulary").mapInArrow(ask, "bucket int, chunk long, names binary, counts binary")
        found = asks.groupBy("bucket").applyInArrow(lambda table: answered(table, min_count, counts), "chunk long, bucket int, bits binary")
        answers = common.written(found.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "bits")).alias("answers")), "colloc-answers")
        left = met(chunks.drop("words"), answers, "chunk").mapInArrow(spell, "lang string, x string, y string, z string, n long")
        return common.written(left.groupBy("lang", "x", "y", "z").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count), "colloc-grams")


def graph_of(chunks: DataFrame, min_count: int = MIN_COUNT, bucket_grams: int = BUCKET):
    grams = frequent(chunks, min_count, bucket_grams)
    return (grams.filter("z IS NOT NULL"), grams.filter("y IS NOT NULL AND z IS NULL").drop("z"), grams.filter("y IS NULL").drop("y", "z"))


def graph(docs: DataFrame, min_count: int = MIN_COUNT, chunk_bytes: int = CHUNK, bucket_grams: int = BUCKET):
    """(edges lang, x, y, z, n; pairs lang, x, y, n; words lang, x, n): those
    of at least ``min_count`` occurrences.  A null language is ``und``, a null
    text empty."""
    with common.batches_of(docs.sparkSession, rows=1000):
        chunks = coded(docs, chunk_bytes)
    return graph_of(chunks, min_count, bucket_grams)


# ---- paths ------------------------------------------------------------------

def met(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """A merge join: both sides grow with the corpus, so none is broadcast."""
    return left.join(right.hint("merge"), on, how)


def unary_paths(edges: DataFrame, pairs: DataFrame) -> DataFrame:
    """lang, words, n of every maximal run of unary pairs, with the word
    before and after it: all occurrences of each of these pairs come from one
    edge and go on along one, so the whole path has the count n.

    Pairs point to the one before them and pointers are doubled until they
    reach the run's first pair; a run cannot be a ring, as pieces end."""
    into = edges.select("lang", F.col("y").alias("x"), F.col("z").alias("y"), "n", F.col("x").alias("before"))
    out = edges.select("lang", "x", "y", "n", F.col("z").alias("after"))
    key = lambda a, b: F.struct("lang", F.col(a).alias("x"), F.col(b).alias("y"))
    unary = common.written(met(met(pairs, into, ["lang", "x", "y", "n"]), out, ["lang", "x", "y", "n"])
                           .select(key("x", "y").alias("pair"), "n", "before", "after"), "colloc-unary")
    last = unary.select(F.struct("pair.lang", F.col("before").alias("x"), F.col("pair.x").alias("y")).alias("up"), "pair")
    found = common.written(met(last, unary.select(F.col("pair").alias("up"), F.lit(1).alias("one")), "up", "left")
                           .select("pair", F.when(F.col("one") == 1, F.col("up")).alias("up"), F.coalesce("one", F.lit(0)).alias("hops")), "colloc-up")
    while True:
        on = found.select(F.col("pair").alias("up"), F.col("up").alias("further"), F.col("hops").alias("more"))
        step = common.written(met(found, on, "up", "left").select(
            "pair", F.coalesce("further", "up").alias("up"), (F.col("hops") + F.coalesce("more", F.lit(0))).alias("hops"),
            F.col("further").isNotNull().alias("moved")), "colloc-up")
        found = step.drop("moved")
        if step.filter("moved").isEmpty():
            break
    # A run is as long as a piece of text at most.
    member = F.struct("hops", F.col("pair.x").alias("x"), F.col("pair.y").alias("y"), "before", "after")
    runs = (met(found, unary, "pair").groupBy(F.coalesce("up", "pair").alias("first"))
            .agg(F.sort_array(F.collect_list(member)).alias("m"), F.first("n").alias("n")))
    end = F.element_at("m", -1)
    return runs.select(F.col("first.lang").alias("lang"), F.concat(
        F.array(F.element_at("m", 1)["before"]), F.transform("m", lambda p: p["x"]), F.array(end["y"], end["after"])).alias("words"), "n")


# ---- phrases ----------------------------------------------------------------

def scored(rows: DataFrame) -> DataFrame:
    """``rows`` (a, cuts: array of k, l, r) with the cut of the lowest score;
    the arithmetic is exact for counts below 10^14."""
    wide = lambda c: f"CAST({c} AS DECIMAL(14,0))"
    score = f"(CAST(1000000 AS DECIMAL(7,0)) * ({wide('a')} * {wide('a')})) div ({wide('c.l')} * {wide('c.r')})"
    best = F.expr(f"array_min(transform(cuts, c -> struct({score} AS score, c.k AS k, c.l AS l, c.r AS r)))")
    return rows.withColumn("best", best).select("lang", "phrase", "a", F.col("best.l").alias("l"), F.col("best.r").alias("r"), F.col("best.score").alias("score"))


def phrases(docs: DataFrame, min_count: int = MIN_COUNT, percent: int = PERCENT, chunk_bytes: int = CHUNK, bucket_grams: int = BUCKET) -> DataFrame:
    """lang, phrase, a, l, r, n, score of every phrase that stands: pairs and
    triples of at least ``min_count`` occurrences, except pairs inside a triple
    that has ``percent`` of their occurrences or more.

    A null language is ``und``, a null or empty text has no words; repeated
    rows count each; other columns are not looked at; no rows give no rows."""
    with common.batches_of(docs.sparkSession, rows=1000):
        chunks = coded(docs, chunk_bytes)
    edges, pairs, words = graph_of(chunks, min_count, bucket_grams)
    paths = common.written(unary_paths(edges, pairs), "colloc-paths")
    totals = chunks.groupBy("lang").agg(F.sum("words").alias("n"))
    inner = F.sequence(F.lit(1), F.size("words") - 3)  # pairs that are unary
    unary = paths.select("lang", F.explode(F.transform(inner, lambda k: F.struct(F.get("words", k).alias("x"), F.get("words", k + 1).alias("y")))).alias("p"))
    unary = unary.select("lang", "p.x", "p.y")
    # An edge between two unary pairs lies inside a path: both its pairs have its count.
    within = paths.filter(F.size("words") >= 5).select("lang", "n", F.explode(F.transform(
        F.sequence(F.lit(1), F.size("words") - 4),
        lambda k: F.struct(F.get("words", k).alias("x"), F.get("words", k + 1).alias("y"), F.get("words", k + 2).alias("z")))).alias("e"))
    within = within.select("lang", "e.x", "e.y", "e.z", "n", F.col("n").alias("xy"), F.col("n").alias("yz"))
    outside = met(edges, within.select("lang", "x", "y", "z"), ["lang", "x", "y", "z"], "left_anti")
    outside = met(met(outside, pairs.withColumnRenamed("n", "xy"), ["lang", "x", "y"]),
                  pairs.select("lang", F.col("x").alias("y"), F.col("y").alias("z"), F.col("n").alias("yz")), ["lang", "y", "z"])
    triples = outside.unionByName(within)
    times = lambda name: words.select("lang", F.col("x").alias(name), F.col("n").alias(f"n_{name}"))
    cut = lambda k, left, right: F.struct(F.lit(k).alias("k"), F.col(left).alias("l"), F.col(right).alias("r"))
    triples = (met(met(triples, times("x"), ["lang", "x"]), times("z"), ["lang", "z"])
               .select("lang", F.concat_ws(" ", "x", "y", "z").alias("phrase"), F.col("n").alias("a"),
                       F.array(cut(1, "n_x", "yz"), cut(2, "xy", "n_z")).alias("cuts")))
    # Unary pairs lie in an edge of equal count; the others look at theirs.
    rest = met(pairs, unary, ["lang", "x", "y"], "left_anti")
    holders = edges.select("lang", "x", "y", F.col("n").alias("most")).union(edges.select("lang", F.col("y"), F.col("z"), F.col("n")))
    most = holders.groupBy("lang", "x", "y").agg(F.max("most").alias("most"))
    rest = met(rest, most, ["lang", "x", "y"], "left").filter(F.coalesce(100 * F.col("most") < percent * F.col("n"), F.lit(percent > 0)))
    rest = (met(met(rest, times("x"), ["lang", "x"]), times("y"), ["lang", "y"])
            .select("lang", F.concat_ws(" ", "x", "y").alias("phrase"), F.col("n").alias("a"), F.array(cut(1, "n_x", "n_y")).alias("cuts")))
    return scored(triples.unionByName(rest)).join(totals, "lang")


def best(docs: DataFrame, top: int = TOP) -> DataFrame:
    """Each language's first ``top`` phrases by score, count and spelling."""
    from pyspark.sql import Window

    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    rows = phrases(docs).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return rows.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


ORACLE = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
spelt AS (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
places AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM spelt),
grams AS (
  SELECT lang, w[i] AS phrase, 1 AS size FROM places
  UNION ALL SELECT lang, w[i] || ' ' || w[i + 1], 2 FROM places WHERE i < len(w)
  UNION ALL SELECT lang, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2], 3 FROM places WHERE i + 1 < len(w)),
counts AS (
  SELECT lang, phrase, size, count(*) AS f FROM grams GROUP BY ALL),
totals AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE size = 1 GROUP BY lang),
candidates AS (
  SELECT lang, phrase, size, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE size >= 2 AND f >= {MIN_COUNT}),
cuts AS (
  SELECT c.*, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS tail
  FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates) c),
scores AS (
  SELECT c.lang, c.phrase, c.size, c.a, h.f AS l, t.f AS r,
         (1000000 * CAST(a AS HUGEINT) * a) // (CAST(h.f AS HUGEINT) * t.f) AS score, k
  FROM cuts c JOIN counts h ON h.lang = c.lang AND h.phrase = c.head JOIN counts t ON t.lang = c.lang AND t.phrase = c.tail),
lowest AS (
  SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
held AS (
  SELECT DISTINCT s.lang, s.phrase FROM candidates t, LATERAL (SELECT unnest([t.w[1] || ' ' || t.w[2], t.w[2] || ' ' || t.w[3]]) AS phrase) p
  JOIN candidates s ON s.lang = t.lang AND s.phrase = p.phrase WHERE t.size = 3 AND 100 * t.a >= {PERCENT} * s.a)
SELECT * FROM (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
         phrase, a, l, r, n, CAST(score AS BIGINT) AS score
  FROM lowest JOIN totals USING (lang) WHERE (lang, phrase) NOT IN (SELECT (lang, phrase) FROM held)) WHERE rank <= {TOP}"""

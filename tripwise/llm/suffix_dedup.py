"""Removal of passages that repeat, by a difference cover and blockwise names.

A byte goes if a string of ``width`` bytes that covers it also starts anywhere
else, in another text or the same one.  Matches never cross texts.

A suffix array would put such suffixes side by side, sorted to depth
``width``.  Here order is not needed, only which suffixes are equal to that
depth, so a suffix is given a name (a hash of its first ``width`` bytes)
instead of a rank, and the construction keeps the two ideas that bound its
memory:

* **Difference cover.**  A set of residues mod ``PERIOD`` such that for any two
  places some common shift below PERIOD takes both into the cover.  Two equal
  strings of ``width`` bytes so hold a pair of equal strings of
  ``width - PERIOD + 1`` bytes at cover places.  Those samples (9 % of all
  places) are named first.  Only suffixes with a sample that repeats are
  compared further; the rest of the text is settled.
* **Blocks.**  The remaining suffixes are named one block of names at a time;
  each block is cut into buckets of bounded size that tasks sort on their own.

Texts are packed once into chunks in the shared folder and never shuffled.  A
chunk asks with its distinct names, each once however often it occurs, and is
answered by one bit a name; so a passage that a third of all texts hold costs
a bucket one name for each chunk.  The names have 64 bits, and suffixes must
also agree on the block and bucket, which come from a second, independent
hash: with more data there are more buckets, so names get longer.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwise.session import scratch_path

from . import common
from .shingles import mixed

WIDTH = 400
FIELD = 11
PERIOD = FIELD * FIELD + FIELD + 1
#: Text bytes a chunk is filled to; a longer text is a chunk of its own.
CHUNK = 2 << 20
#: Names in a bucket, in expectation, and blocks that are named in turn.
NAMES, BLOCKS = 2 << 20, 4


# ---- names ------------------------------------------------------------------

@lru_cache(None)
def difference_cover(q: int = FIELD) -> np.ndarray:
    """q + 1 residues mod q^2 + q + 1 (q prime) whose differences are all
    residues: the powers x^i of a generator of GF(q^3) that have no x^2 term
    (points of a line in the projective plane)."""
    period = q * q + q + 1
    for a, b, c in ((a, b, c) for a in range(q) for b in range(q) for c in range(1, q)):
        power, found = (1, 0, 0), []
        for i in range(period):
            if power[2] == 0:
                found.append(i)
            low, mid, high = power
            power = (c * high % q, (low + b * high) % q, (mid + a * high) % q)
        if len(found) == q + 1 and len({(i - j) % period for i in found for j in found}) == period:
            return np.array(found)
    raise ValueError(f"no difference cover for {q}")


SEGMENT = 1 << 18


@lru_cache(None)
def _tables(seed: int, length: int):
    """Random values of bytes, and powers of an odd base and of its inverse."""
    rng = np.random.default_rng(seed)
    values = rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, 256, dtype=np.uint64)
    base = int(rng.integers(1 << 60, 1 << 63)) * 2 + 1
    powers = []
    for b in (base, pow(base, -1, 1 << 64)):
        p = np.full(length, np.uint64(b % (1 << 64)), np.uint64)
        p[0] = 1
        powers.append(np.cumprod(p, dtype=np.uint64))
    return values, *powers


def window_hashes(data: np.ndarray, width: int, seed: int) -> np.ndarray:
    """A 64-bit hash of the ``width`` bytes from each place on."""
    n = max(0, len(data) - width + 1)
    values, powers, inverse = _tables(seed, SEGMENT + width)
    out = np.empty(n, np.uint64)
    for a in range(0, n, SEGMENT):
        part = data[a:min(a + SEGMENT, n) + width - 1]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(values[part] * powers[:len(part)], dtype=np.uint64, out=sums[1:])
        count = len(part) - width + 1
        out[a:a + count] = (sums[width:] - sums[:count]) * inverse[:count]
    return out


def two_hashes(data, places, width):
    """The name's 64 bits and the independent bits of block and bucket, for
    the strings at some places."""
    if not len(places):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    first, second = (window_hashes(data, width, seed)[places] for seed in (1, 2))
    return first, mixed(second)


class Names:
    """The distinct names of some places of a chunk, by bucket and name, and
    which places have them."""

    def __init__(self, places, first, second, buckets):
        bucket = ((second >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(first)
        near = bucket[order]
        # Then stably by bucket; 16 bits are sorted by counting.
        order = order[np.argsort(near.astype(np.uint16) if buckets <= 1 << 16 else near, kind="stable")]
        self.places, first, bucket = places[order], first[order], bucket[order]
        new = np.ones(len(first), bool)
        new[1:] = (first[1:] != first[:-1]) | (bucket[1:] != bucket[:-1])
        at = np.flatnonzero(new)
        self.counts = np.diff(np.append(at, len(first)))
        self.names, self.bucket = first[at], bucket[at]

    def asks(self, chunk):
        """(bucket, chunk, names, bits of those found twice here)."""
        edges = np.flatnonzero(np.diff(self.bucket)) + 1
        for a, b in zip(np.append(0, edges), np.append(edges, len(self.names))):
            if a < b:
                yield int(self.bucket[a]), chunk, self.names[a:b].astype("<u8").tobytes(), np.packbits(self.counts[a:b] > 1).tobytes()

    def repeated(self, answers) -> np.ndarray:
        """The places whose names are repeated; ``answers`` are the bits by bucket."""
        known = np.zeros(len(self.names), bool)
        for bucket, bits in answers:
            a, b = np.searchsorted(self.bucket, (bucket, bucket + 1))
            known[a:b] = np.unpackbits(np.frombuffer(bits, np.uint8), count=b - a).astype(bool)
        return self.places[np.repeat(known, self.counts)]


def answered(table: pa.Table) -> pa.Table:
    """For one bucket's asks the bits of the names that some chunk has twice,
    or two chunks have."""
    blobs = [np.frombuffer(x, "<u8") for x in table.column("names").to_pylist()]
    sizes = [len(x) for x in blobs]
    twice = np.concatenate([np.unpackbits(np.frombuffer(m, np.uint8), count=n).astype(bool)
                            for m, n in zip(table.column("twice").to_pylist(), sizes)])
    held = np.concatenate(blobs)
    order = np.argsort(held)
    held = held[order]
    same = held[1:] == held[:-1]
    found = twice[order]
    found[1:] |= same
    found[:-1] |= same
    bits = np.empty(len(held), bool)
    bits[order] = found
    ends = np.cumsum(sizes)
    return table.select(["chunk", "bucket"]).append_column("bits", pa.array(
        [np.packbits(bits[e - n:e]).tobytes() for e, n in zip(ends, sizes)], pa.binary()))


# ---- chunks -----------------------------------------------------------------

CHUNK_FIELDS = "chunk long, uri string, at long, packed long, n_bytes long, doc_ids array<long>, ends array<long>"


def packed(docs: DataFrame, chunk_bytes: int) -> DataFrame:
    """One row per chunk of whole texts; their bytes lie compressed in one
    file per task, read back by range."""
    folder = scratch_path(docs.sparkSession, "repeats-texts")

    def run(batches):
        part = TaskContext.get().partitionId()
        uri, codec, rows = f"{folder}/{part:06d}.bin", pa.Codec("zstd", 1), []

        def flush(ids, texts, at):
            data = b"".join(texts)
            blob = codec.compress(data, asbytes=True)
            rows.append(((part << 32) + len(rows), uri, at, len(blob), len(data), ids, np.cumsum([len(t) for t in texts]).tolist()))
            return blob

        def chunks():
            ids, texts, size, at = [], [], 0, 0
            for batch in batches:
                for i, t in zip(batch.column("doc_id").to_pylist(), batch.column("data").to_pylist()):
                    if texts and size + len(t) > chunk_bytes:
                        blob = flush(ids, texts, at)
                        ids, texts, size, at = [], [], 0, at + len(blob)
                        yield blob
                    ids.append(i)
                    texts.append(t)
                    size += len(t)
            if texts:
                yield flush(ids, texts, at)

        common.write_file(uri, chunks())
        schema = pa.schema([("chunk", pa.int64()), ("uri", pa.string()), ("at", pa.int64()), ("packed", pa.int64()), ("n_bytes", pa.int64()),
                            ("doc_ids", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64()))])
        for row in rows:
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("data"))
    return common.written(plain.mapInArrow(run, CHUNK_FIELDS), "repeats-chunks")


def chunk_rows(batches):
    """(row, text bytes as an array) of every chunk."""
    for batch in batches:
        for row in batch.to_pylist():
            fs, path = common.file_system(row["uri"])
            with fs.open_input_file(path) as f:
                f.seek(row["at"])
                blob = f.read(row["packed"])
            yield row, np.frombuffer(pa.Codec("zstd", 1).decompress(blob, row["n_bytes"]) if row["n_bytes"] else b"", np.uint8)


def sample_places(ends, width: int) -> np.ndarray:
    """The cover's places (counted from each text's start) that have
    ``width`` bytes of their text ahead."""
    cover, found, start = difference_cover(), [np.zeros(0, np.int64)], 0
    for end in ends:
        if end - start >= width:
            at = (np.arange(0, end - start, PERIOD)[:, None] + cover).ravel()
            found.append(at[at <= end - start - width] + start)
        start = end
    return np.concatenate(found)


def runs_of(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edges = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def covered(starts: np.ndarray, reach: int, n: int) -> np.ndarray:
    """Which of n bytes lie within ``reach`` from one of the places on."""
    change = np.zeros(n + reach + 1, np.int32)
    change[starts] += 1  # the places differ
    change[starts + reach] -= 1
    return np.cumsum(change[:n], dtype=np.int32) > 0


def open_runs(samples: np.ndarray, ends, n: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs of places that have ``width`` bytes ahead and a repeated sample
    among the next PERIOD places."""
    near = np.zeros(n, bool)
    if len(samples):
        back = covered(n - 1 - samples, PERIOD, n)[::-1]  # PERIOD places up to and with a sample
        start = 0
        for end in ends:  # a text's places never look into the next text
            last = end - width + 1
            if last > start:
                near[start:last] = back[start:last]
            start = end
    return runs_of(near)


class Open:
    """The open places of a chunk and the bytes their strings take, put
    together; a string of an open place stays in one piece."""

    def __init__(self, data, starts, ends, width):
        def within(ends):
            flags = np.zeros(len(data) + 1, np.int32)
            np.add.at(flags, starts, 1)
            np.add.at(flags, ends, -1)
            return np.cumsum(flags[:-1], dtype=np.int32) > 0

        starts, ends = np.asarray(starts, np.int64), np.asarray(ends, np.int64)
        held = within(ends + width - 1)
        self.back = np.flatnonzero(held)
        at = np.flatnonzero(within(ends)[self.back])
        self.first, self.second = two_hashes(data[held], at, width)
        self.at = at

    def names(self, buckets, blocks, block):
        own = np.flatnonzero(self.second % np.uint64(blocks) == block)
        return Names(self.at[own], self.first[own], self.second[own], buckets)


# ---- the operator -----------------------------------------------------------

ASK = "bucket int, chunk long, names binary, twice binary"


def _ask(make):
    """Task that yields the asks of every chunk; ``make(row, data)`` is the
    chunk's Names."""
    def run(batches):
        schema = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("names", pa.binary()), ("twice", pa.binary())])
        for row, data in chunk_rows(batches):
            asks = list(make(row, data).asks(row["chunk"]))
            for k in range(0, len(asks), 64):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*asks[k:k + 64]), schema)], schema=schema)
    return run


def _answers(asks: DataFrame, block: int = 0) -> DataFrame:
    found = asks.groupBy("bucket").applyInArrow(answered, "chunk long, bucket int, bits binary")
    return common.written(found.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "bits")).alias("answers")).withColumn("block", F.lit(block)), "repeats-answers")


def repeats(docs: DataFrame, width: int = WIDTH, chunk_bytes: int = CHUNK, bucket_names: int = NAMES, blocks: int = BLOCKS) -> DataFrame:
    """doc_id, n_bytes (UTF-8), spans (start and length of the maximal runs
    of bytes that go, in order) and kept (the other bytes) of every row.

    A null text is empty; texts shorter than ``width`` keep all bytes; equal
    texts and repeated rows repeat each other, so from ``width`` bytes on they
    keep nothing; null ids stay null.  Other columns are not looked at.  An
    empty table gives no rows.  ``width`` must be at least 2 * PERIOD."""
    if width < 2 * PERIOD:
        raise ValueError(f"width must be at least {2 * PERIOD}")
    spark = docs.sparkSession
    sample = width - PERIOD + 1
    with common.batches_of(spark, rows=1000):
        chunks = packed(docs, chunk_bytes)
        total, = chunks.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()
    with common.batches_of(spark, rows=1):
        tasks = max(1, -(-total // (4 * chunk_bytes)), spark.sparkContext.defaultParallelism)
        few = common.shuffle_partitions(spark)
        place = chunks.select("chunk", "uri", "at", "packed", "n_bytes", "ends")

        buckets = max(few, -(-total * (FIELD + 1) // (PERIOD * bucket_names)))

        def samples(row, data):
            at = sample_places(row["ends"], sample)
            return Names(at, *two_hashes(data, at, sample), buckets)

        answers = _answers(place.repartition(tasks, "chunk").mapInArrow(_ask(samples), ASK))

        def settle(batches):
            schema = pa.schema([("chunk", pa.int64()), ("starts", pa.list_(pa.int64())), ("stops", pa.list_(pa.int64())), ("n_open", pa.int64())])
            for row, data in chunk_rows(batches):
                found = samples(row, data).repeated([(a["bucket"], a["bits"]) for a in row["answers"]])
                starts, stops = open_runs(found, row["ends"], row["n_bytes"], width)
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(
                    (row["chunk"], starts, stops, int((stops - starts).sum())), schema)], schema=schema)

        runs = common.written(place.join(answers.hint("merge"), "chunk").repartition(tasks, "chunk").mapInArrow(
            settle, "chunk long, starts array<long>, stops array<long>, n_open long"), "repeats-open")
        left, = runs.agg(F.coalesce(F.sum("n_open"), F.lit(0))).first()
        opened = common.written(place.drop("ends").join(runs.filter("n_open > 0").hint("merge"), "chunk"), "repeats-left").repartition(tasks, "chunk")

        wide = max(few, -(-left // (blocks * bucket_names)))

        def of_block(block):
            return lambda row, data: Open(data, row["starts"], row["stops"], width).names(wide, blocks, block)

        named = None
        for block in range(blocks):
            part = _answers(opened.mapInArrow(_ask(of_block(block)), ASK), block)
            named = part if named is None else named.unionByName(part)

        gathered = named.groupBy("chunk").agg(F.collect_list(F.struct("block", "answers")).alias("found"))
        rows = chunks.join(runs.hint("merge"), "chunk", "left").join(gathered.hint("merge"), "chunk", "left").repartition(tasks, "chunk")

        def cut(batches):
            schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()),
                                ("spans", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))), ("kept", pa.binary())])
            for row, data in chunk_rows(batches):
                gone = np.zeros(len(data), bool)
                if row["found"]:
                    held = Open(data, row["starts"], row["stops"], width)
                    for f in row["found"]:
                        at = held.names(wide, blocks, f["block"]).repeated([(a["bucket"], a["bits"]) for a in f["answers"]])
                        gone |= covered(held.back[at], width, len(data))
                start, out = 0, []
                for doc_id, end in zip(row["doc_ids"], row["ends"]):
                    mine = gone[start:end]
                    a, b = runs_of(mine)
                    spans = [{"start": int(x), "length": int(y - x)} for x, y in zip(a, b)]
                    out.append((doc_id, end - start, spans, data[start:end][~mine].tobytes()))
                    start = end
                for k in range(0, len(out), 500):
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out[k:k + 500]), schema)], schema=schema)

        # Written while the batch bounds hold; the result is read as often as needed.
        return common.written(rows.mapInArrow(
            cut, "doc_id long, n_bytes long, spans array<struct<start:long,length:long>>, kept binary"), "repeats-cut")


def digest(docs: DataFrame) -> DataFrame:
    return repeats(docs).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))

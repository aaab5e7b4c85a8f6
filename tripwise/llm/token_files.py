"""Token-id files: documents in doc_id order, encoded, Re-Pair compressed per
shard and written as binary files that allow random access.

Texts are dealt by ranges of doc_id, each task encodes its sorted range and
writes one file of consecutive shards (about ``shard_tokens`` ids each, whole
documents), so a task holds one shard at a time.  A manifest table names each
shard's file, place and token counts; a file appears under its name only when
whole, and a retried task replaces it with the same bytes.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripwise.session import scratch_path

from . import common
from .repair import MIN_COUNT, Shard, encode_shard
from .tokens import encode_with_end

MANIFEST = "part int, seq int, file string, offset long, length long, part_start long, n_tokens long, n_docs int"
DOCUMENTS = "part int, doc_id long, local_start long, n_tokens long, ids_crc32 long"


def write_token_files(docs: DataFrame, folder: str, vocabulary: str, end_id: int = 1,
                      shard_tokens: int = 1_000_000, min_count: int = MIN_COUNT,
                      partitions: int | None = None) -> DataFrame:
    """Write the ids of ``docs`` (doc_id, text; more columns are ignored) in
    ascending doc_id order into ``folder``; returns the manifest.

    A null text is empty (only the end id); a null doc_id sorts first and
    stays null; repeated rows are kept, one entry each.  No rows: no files
    and an empty manifest.
    """
    spark = docs.sparkSession
    common.bounded_batches(spark)
    n = partitions or common.shuffle_partitions(spark)
    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
               .repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text"))

    def write(batches):
        part = TaskContext.get().partitionId()
        name, rows = f"part-{part:06d}.rpt", []
        place = {"offset": 0, "start": 0}

        def shard(pieces) -> bytes:
            ids, doc_ids, nulls, tokens = (np.concatenate(x) for x in zip(*pieces))
            payload = encode_shard(ids, doc_ids, nulls, tokens, min_count)
            rows.append((part, len(rows), name, place["offset"], len(payload), place["start"], len(ids), len(tokens)))
            place["offset"] += len(payload)
            place["start"] += len(ids)
            return payload

        def payloads():
            pieces, held = [], 0
            for batch in batches:
                ids, offsets = encode_with_end(batch.column("text"), vocabulary, end_id)
                doc_ids, nulls = common.int_column(batch.column("doc_id"))
                # Cut the batch where the running total passes a shard's size.
                marks = (held + offsets[1:]) // shard_tokens
                cuts = np.flatnonzero(np.diff(marks, prepend=held // shard_tokens)) + 1
                for a, b in zip([0, *cuts], [*cuts, len(doc_ids)]):
                    if b > a:
                        pieces.append((ids[offsets[a]:offsets[b]], doc_ids[a:b], nulls[a:b], np.diff(offsets[a:b + 1])))
                        held += int(offsets[b] - offsets[a])
                    if b in cuts and pieces:
                        yield shard(pieces)
                        pieces, held = [], 0
            if pieces:
                yield shard(pieces)

        chunks = payloads()
        first = next(chunks, None)
        if first is not None:
            common.write_file(f"{folder}/{name}", _chain(first, chunks))
            schema = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("file", pa.string()), ("offset", pa.int64()),
                                ("length", pa.int64()), ("part_start", pa.int64()), ("n_tokens", pa.int64()),
                                ("n_docs", pa.int32())])
            yield common.rows_batch(schema, dict(zip(schema.names, map(list, zip(*rows)))))

    return ordered.mapInArrow(write, MANIFEST)


def _chain(first, rest):
    yield first
    yield from rest


def read_token_files(manifest: DataFrame, folder: str, partitions: int | None = None) -> DataFrame:
    """Per document: doc_id, start (ids of all documents before it),
    n_tokens and ids_crc32, from the files of the manifest."""
    spark = manifest.sparkSession
    n = partitions or common.shuffle_partitions(spark)

    def read(batches):
        schema = pa.schema([("part", pa.int32()), ("doc_id", pa.int64()), ("local_start", pa.int64()),
                            ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
        for batch in batches:
            for row in batch.to_pylist():
                fs, path = common.file_system(f"{folder}/{row['file']}")
                with fs.open_input_file(path) as f:
                    f.seek(row["offset"])
                    shard = Shard(f.read(row["length"]))
                raw = memoryview(shard.decode().astype("<u4").tobytes())
                starts, ends = 4 * shard.doc_starts, 4 * (shard.doc_starts + shard.doc_tokens)
                crc = [zlib.crc32(raw[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
                docs = len(crc)
                yield common.rows_batch(schema, {
                    "part": np.full(docs, row["part"], np.int32),
                    "doc_id": pa.array(shard.doc_ids.astype(np.int64), pa.int64(), mask=shard.doc_nulls),
                    "local_start": row["part_start"] + shard.doc_starts,
                    "n_tokens": shard.doc_tokens, "ids_crc32": np.array(crc, np.int64)})

    # One row per file: as many rows as the writing job had tasks.
    totals = manifest.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = totals.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("before"))
    rows = manifest.repartition(n).mapInArrow(read, DOCUMENTS)
    return (rows.join(F.broadcast(before), "part")
            .select("doc_id", (F.col("before") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32"))


def token_files(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Write and read back: the digest of every document's ids.

    A null text is empty (the end id alone), texts of any length are taken
    whole; null ids sort first and stay null; repeated rows are an entry each;
    other columns are not looked at; an empty table gives no rows."""
    folder = scratch_path(docs.sparkSession, "token-files")
    manifest = common.written(write_token_files(docs, f"{folder}/data", vocabulary), "token-manifest")
    return read_token_files(manifest, f"{folder}/data")

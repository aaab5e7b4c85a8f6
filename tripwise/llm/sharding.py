"""Sharding by fixed virtual slots.

Records are hashed into a fixed number of virtual slots.  A versioned map says
which shard holds each slot: version 1 deals the slots round robin, and each
rebalancing stores a new version in which slots have been moved or swapped
between shards until the shards' bytes are near equal.  Records never change
their slot, so a rebalancing edits a small map and moves whole slots.

The law kept is ``bytes``: shards hold near equal sizes.  All work on records
is DataFrame operations; the driver only sees one total per slot, a number
fixed by the parameter.
"""

from __future__ import annotations

import bisect

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripwise.session import scratch_path

from . import common

SLOTS = 8192


def size_column(text) -> F.Column:
    """UTF-8 bytes of the text (null: none) plus 8."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long")


def rebalance(bytes_of: list[int], shard_of: list[int], shards: int, tolerance: float = 1e-4,
              most_edits: int | None = None) -> list[int]:
    """An edited slot-to-shard map: while the fullest and the emptiest shard
    differ by more than ``tolerance`` of a mean shard, the best single move or
    swap of slots between those two is made.  Every edit lowers the squared
    spread, so it ends; it also ends when no move or swap helps."""
    held = [sorted((bytes_of[s], s) for s in range(len(bytes_of)) if shard_of[s] == k) for k in range(shards)]
    load = [sum(b for b, _ in h) for h in held]
    close = tolerance * sum(load) / shards
    edits = 0
    out = list(shard_of)
    while most_edits is None or edits < most_edits:
        pair = _best_pair(held, load, close)
        if pair is None:
            break
        high, low, give, take = pair
        for item, a, b in ((give, high, low), (take, low, high)):
            if item is not None:
                held[a].remove(item)
                bisect.insort(held[b], item)
                load[a] -= item[0]
                load[b] += item[0]
                out[item[1]] = b
        edits += 1
    return out


def _best_pair(held, load, close):
    """(shard that gives, shard that takes, slot given, slot taken or None):
    the exchange that brings the two nearest to equal.  Fuller givers and
    emptier takers come first; a shard that one huge slot keeps full is
    passed over."""
    by_load = sorted(range(len(load)), key=lambda k: (load[k], k))
    for high in reversed(by_load):
        for low in by_load:
            gap = load[high] - load[low]
            if gap <= max(close, 1):
                break
            options = [(0, None), *held[low]]
            sizes = [b for b, _ in options]
            best = None
            for give in held[high]:
                # After giving g and taking t the gap is gap - 2 (g - t).
                at = bisect.bisect_left(sizes, give[0] - gap / 2)
                for j in (at - 1, at):
                    if 0 <= j < len(options):
                        left = abs(gap - 2 * (give[0] - sizes[j]))
                        if best is None or left < best[0]:
                            best = (left, give, options[j] if j else None)
            if best and best[0] < gap * 0.99:
                return high, low, best[1], best[2]
    return None


def slot_bytes(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """virtual_slot, rows, bytes: one row per slot that holds records."""
    return docs.groupBy("virtual_slot").agg(F.count("*").alias("rows"), F.sum("size").alias("bytes"))


def write_map(spark, shard_of: list[int], version: int, folder: str) -> None:
    """Store one version of the map as a folder of its own."""
    listed = F.split(F.lit(",".join(map(str, shard_of))), ",")
    (spark.range(1).select(F.posexplode(listed).alias("virtual_slot", "shard"))
     .select("virtual_slot", F.col("shard").cast("int").alias("shard"))
     .coalesce(1).write.mode("overwrite").parquet(f"{folder}/version={version}"))


def read_map(spark, folder: str, version: int) -> DataFrame:
    return spark.read.schema("virtual_slot int, shard int").parquet(f"{folder}/version={version}")


def with_slots(docs: DataFrame, slots: int = SLOTS, block: int = 10_000) -> DataFrame:
    """doc_id, size, text_crc32, ordinal, virtual_slot of the records.

    Equal rows are counted and numbered again from 0 (which of them has which
    number makes no difference), a block at a time, and the hash takes the id,
    the text and that number: neither null ids, nor copies of one text, nor
    repeats of a whole row fill a single slot.  A null text has no bytes."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), size_column(F.col("text")).alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("spelt"))
    counted = rows.groupBy("doc_id", "size", "text_crc32", "spelt").agg(F.count("*").alias("n"))
    blocks = counted.withColumn("first", F.explode(F.sequence(F.lit(0), F.col("n") - 1, F.lit(block))))
    each = blocks.withColumn("ordinal", F.explode(F.sequence(F.col("first"), F.least(F.col("first") + block, F.col("n")) - 1)))
    return each.select("doc_id", "size", "text_crc32", "ordinal", F.pmod(F.xxhash64("doc_id", "spelt", "ordinal"), F.lit(slots)).cast("int").alias("virtual_slot"))


def shard_documents(docs: DataFrame, shards: int = 24, slots: int = SLOTS, cell_rows: int = 20_000) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, virtual_slot
    of every row: ``slot`` numbers a shard's rows gaplessly from 0.

    Null ids and texts, repeated rows and ties are all kept, each with its own
    place; an empty table gives no rows.  Extra columns are ignored."""
    spark = docs.sparkSession
    records = common.written(with_slots(docs, slots), "slot-records")
    per_slot = [(r.virtual_slot, r.rows, r.bytes) for r in slot_bytes(records, slots).collect()]  # at most ``slots`` rows
    bytes_of = [0] * slots
    for slot, _, total in per_slot:
        bytes_of[slot] = total
    folder = f"{scratch_path(spark, 'slot-map')}/map"
    dealt = [s % shards for s in range(slots)]
    write_map(spark, dealt, 1, folder)
    write_map(spark, rebalance(bytes_of, dealt, shards), 2, folder)
    # Rows are numbered within cells of bounded size (parts of a slot), and
    # the cells' totals are summed up per shard.
    parts = max(1, -(-max((rows for _, rows, _ in per_slot), default=0) // cell_rows))
    placed = (records.join(F.broadcast(read_map(spark, folder, 2)), "virtual_slot")  # ``slots`` rows
              .withColumn("cell", F.pmod(F.xxhash64("text_crc32", "doc_id", "size", "ordinal"), F.lit(parts)).cast("int")))
    cells = placed.groupBy("shard", "virtual_slot", "cell").agg(F.count("*").alias("rows"))
    up_to = Window.partitionBy("shard").orderBy("virtual_slot", "cell")
    before = cells.select("virtual_slot", "cell", (F.sum("rows").over(up_to) - F.col("rows")).alias("before"))
    number = F.row_number().over(Window.partitionBy("virtual_slot", "cell").orderBy("doc_id", "text_crc32", "size"))
    return (placed.withColumn("number", number).join(before, ["virtual_slot", "cell"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("before") + F.col("number") - 1).alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard"), "virtual_slot"))

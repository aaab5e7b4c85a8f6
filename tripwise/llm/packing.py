"""Best-fit packing with a grouping genetic algorithm on Spark.

Documents become pieces of at most ``capacity`` tokens; pieces are items to be
put into as few sequences (bins) as possible.  Items are dealt at random into
blocks of bounded size.  On each block several islands evolve populations of
packings: crossover injects whole well-filled bins of one parent into the
other, dissolves the bins that hold duplicates of the injected items, and
best-fits the displaced items.  Between epochs every island sends its elite
to the next island of its block.  The bins that the best packing of a block
leaves badly filled are dissolved, and their items are dealt into new blocks
and packed by the same algorithm, so blocks do not each waste a bin.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .tokens import encode_with_end

PIECES = "uid long, doc_id long, piece int, start long, length long, ids binary"
PLACES = "uid long, sequence_id long, offset long"
STATE = "block long, island int, uids binary, sizes binary, population binary"


# ---- pieces ---------------------------------------------------------------

def token_pieces(docs: DataFrame, vocabulary: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """Ids of every whole text (null: empty) plus the end id, cut into pieces
    of ``capacity`` only where longer.  ``uid`` numbers the pieces; repeated
    rows and null ids are kept, each as its own document.  Write the result
    before using it twice, so that uids stay as they are."""
    common.bounded_batches(docs.sparkSession, size=4 << 20)

    def cut(batches):
        schema = pa.schema([("uid", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                            ("length", pa.int64()), ("ids", pa.binary())])
        uid = TaskContext.get().partitionId() << 40
        for batch in common.lean(batches, keep=True):
            ids, offsets = encode_with_end(batch.column("text"), vocabulary, end_id)
            doc_ids, nulls = common.int_column(batch.column("doc_id"))
            tokens = np.diff(offsets)
            pieces = -(-tokens // capacity)
            row = np.repeat(np.arange(len(tokens)), pieces)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = piece * capacity
            length = np.minimum(capacity, tokens[row] - start)
            raw = ids.astype("<u4").tobytes()
            at = 4 * (offsets[:-1][row] + start)
            yield common.rows_batch(schema, {
                "uid": uid + np.arange(len(row)), "doc_id": pa.array(doc_ids[row], pa.int64(), mask=nulls[row]),
                "piece": piece.astype(np.int32), "start": start, "length": length,
                "ids": [raw[a:a + n] for a, n in zip(at.tolist(), (4 * length).tolist())]})
            uid += len(row)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, PIECES)


def digests(pieces: DataFrame) -> DataFrame:
    """The pieces with the crc32 of their ids in place of the ids."""
    def crc(batches):
        for batch in common.lean(batches):
            sums = pa.array([zlib.crc32(x.as_buffer()) for x in batch.column("ids")], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], sums], names=[*batch.schema.names[:5], "ids_crc32"])

    return pieces.mapInArrow(crc, "uid long, doc_id long, piece int, start long, length long, ids_crc32 long")


# ---- the genetic algorithm on one block -----------------------------------

def best_fit(items: np.ndarray, sizes: np.ndarray, assign: np.ndarray, room: list[int], capacity: int) -> None:
    """Put the items, largest first, where the least room is left that still
    holds them; ``room`` is the free space of each bin and grows by new bins.
    A bit set of the free spaces finds that bin without a search."""
    by_room: dict[int, list[int]] = {}
    bits = 0
    for b, r in enumerate(room):
        if r > 0:
            by_room.setdefault(r, []).append(b)
            bits |= 1 << r
    for i, s in zip(items.tolist(), sizes[items].tolist()):
        fits = bits >> s
        if fits:
            r = s + (fits & -fits).bit_length() - 1
            bins = by_room[r]
            b = bins.pop()
            if not bins:
                bits ^= 1 << r
        else:
            b, r = len(room), capacity
            room.append(r)
        assign[i] = b
        r -= s
        room[b] = r
        if r:
            bins = by_room.setdefault(r, [])
            if not bins:
                bits |= 1 << r
            bins.append(b)


def largest_first(items: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return items[np.argsort(-sizes[items], kind="stable")]


def fitness(assign: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[int, float]:
    """Fewer bins first, then unevenly filled ones: full bins are worth
    keeping, and near-empty ones are close to being dissolved."""
    fill = np.bincount(assign, sizes)
    return -len(fill), float(((fill / capacity) ** 2).sum())


def crossover(mother: np.ndarray, father: np.ndarray, sizes: np.ndarray, capacity: int,
              rng: np.random.Generator, share: float = 0.25) -> np.ndarray:
    """The mother's packing with a share of the father's best bins injected."""
    fill = np.bincount(father, sizes)
    # Well-filled bins are likelier to be drawn; noise keeps children apart.
    order = np.argsort(-(fill + rng.random(len(fill)) * capacity * 0.05))
    chosen = np.zeros(len(fill), bool)
    chosen[order[:max(1, int(len(fill) * share * rng.random()))]] = True
    injected = chosen[father]
    dissolved = np.zeros(int(mother.max()) + 1, bool)
    dissolved[mother[injected]] = True
    # The emptiest kept bin gives up its items as well.
    rest = np.bincount(mother, sizes, minlength=len(dissolved))
    rest[dissolved] = np.inf
    if np.isfinite(rest).any():
        dissolved[int(np.argmin(rest))] = True
    displaced = np.flatnonzero(dissolved[mother] & ~injected)
    child = np.where(injected, father, len(fill) + mother)
    child[displaced] = -1
    held = child >= 0
    used, child[held] = np.unique(child[held], return_inverse=True)
    room = (capacity - np.bincount(child[held], sizes[held], minlength=len(used))).astype(int).tolist()
    best_fit(largest_first(displaced, sizes), sizes, child, room, capacity)
    return child


def first_population(sizes: np.ndarray, capacity: int, count: int, rng: np.random.Generator, exact: bool) -> list:
    """Best-fit packings of the items in nearly decreasing order."""
    out = []
    for k in range(count):
        noise = 0 if exact and not k else rng.random(len(sizes)) * 0.1
        assign = np.zeros(len(sizes), np.int64)
        best_fit(np.argsort(-sizes * (1 + noise), kind="stable"), sizes, assign, [], capacity)
        out.append(assign)
    return out


def evolve(population: list, sizes: np.ndarray, capacity: int, generations: int, rng: np.random.Generator) -> list:
    """Best first.  Stops early once a packing needs no more bins than the
    items' total asks for."""
    least = -(-int(sizes.sum()) // capacity)
    scored = sorted(((fitness(a, sizes, capacity), k, a) for k, a in enumerate(population)), key=lambda x: (x[0], -x[1]), reverse=True)
    keep = len(scored)
    for _ in range(generations):
        if -scored[0][0][0] <= least or keep < 2:
            break
        for k in range(keep):
            a, b = rng.choice(keep, 2, replace=False)
            child = crossover(scored[min(a, b)][2], scored[max(a, b)][2], sizes, capacity, rng)
            scored.append((fitness(child, sizes, capacity), keep + k, child))
        # The better half goes on; equal fitness counts once.
        best = {x[0]: x for x in sorted(scored, key=lambda x: (x[0], -x[1]))}
        scored = sorted(best.values(), key=lambda x: (x[0], -x[1]), reverse=True)[:keep]
        keep = len(scored)
    return [a for _, _, a in scored]


# ---- islands on Spark ------------------------------------------------------

def _blob(arrays: list) -> bytes:
    return np.concatenate(arrays).astype("<u2").tobytes()


def _unblob(raw: bytes, n: int) -> list:
    return list(np.frombuffer(raw, "<u2").astype(np.int64).reshape(-1, n))


def pack_level(items: DataFrame, count: int, level: int, capacity: int, block_items: int, islands: int,
               population: int, generations: int, epochs: int) -> DataFrame:
    """(uid, length, sequence_id, offset, fill) of items (uid, length)."""
    blocks = max(1, -(-count // block_items))
    dealt = items.withColumn("block", F.pmod(F.xxhash64("uid", F.lit(level)), F.lit(blocks)))

    def start(pdf):
        pdf = pdf.sort_values("uid")
        sizes = pdf["length"].to_numpy()
        uids, raw = pdf["uid"].to_numpy().astype("<i8").tobytes(), sizes.astype("<i4").tobytes()
        block = int(pdf["block"].iloc[0])
        return pd.DataFrame([(block, k, uids, raw, _blob(first_population(
            sizes, capacity, population, np.random.default_rng([level, block, k]), k == 0)))
            for k in range(islands)], columns=["block", "island", "uids", "sizes", "population"])

    def epoch(number):
        def run(pdf):
            # An island's own row has its population, a neighbour's only its elite.
            sizes = np.frombuffer(pdf["sizes"].iloc[0], "<i4").astype(np.int64)
            pdf = pdf.assign(n=pdf["population"].map(len)).sort_values("n", ascending=False, kind="stable")
            people = [a for raw in pdf["population"] for a in _unblob(raw, len(sizes))]
            rng = np.random.default_rng([level, number, int(pdf["block"].iloc[0]), int(pdf["island"].iloc[0])])
            best = evolve(people, sizes, capacity, generations, rng)[:population]
            return pdf.iloc[:1].drop(columns="n").assign(population=[_blob(best)])
        return run

    def finish(pdf):
        sizes = np.frombuffer(pdf["sizes"].iloc[0], "<i4").astype(np.int64)
        pdf = pdf.sort_values("island")
        best = max((_unblob(raw, len(sizes))[0] for raw in pdf["population"]), key=lambda a: fitness(a, sizes, capacity))
        order = np.argsort(best, kind="stable")
        uids, sizes, bins = np.frombuffer(pdf["uids"].iloc[0], "<i8")[order], sizes[order], best[order]
        first = np.concatenate([[True], bins[1:] != bins[:-1]])
        before = np.cumsum(sizes) - sizes
        return pd.DataFrame({"uid": uids, "length": sizes,
                             "sequence_id": ((int(pdf["block"].iloc[0]) * 2 + level) << 16) + bins,
                             "offset": before - np.maximum.accumulate(np.where(first, before, 0)),
                             "fill": np.bincount(bins, sizes)[bins].astype(np.int64)})

    state = dealt.groupBy("block").applyInPandas(start, STATE)
    for number in range(epochs):
        moved = F.struct(*[elite_column(c, islands) for c in state.columns])
        both = state.select(F.inline(F.array(F.struct(*state.columns), moved)))
        state = both.groupBy("block", "island").applyInPandas(epoch(number), STATE)
    return state.groupBy("block").applyInPandas(
        finish, "uid long, length long, sequence_id long, offset long, fill long")


def elite_column(name: str, islands: int):
    """Columns of the row that carries an island's best packing to the next."""
    if name == "island":
        return F.pmod(F.col("island") + 1, F.lit(islands)).cast("int").alias("island")
    if name == "population":  # u16 for each item, where sizes has i32
        return F.expr("substring(population, 1, length(sizes) div 2)").alias("population")
    return F.col(name)


def pack(items: DataFrame, capacity: int = 4096, block_items: int = 4096, islands: int = 2, population: int = 4,
         generations: int = 6, epochs: int = 2, good_fill: float = 0.98) -> DataFrame:
    """uid, sequence_id, offset of every item (uid unique, length from 1 to
    ``capacity``).  Items of full length are a sequence of their own; no items
    give no rows.  ``block_items`` is below 65,536, as bins are numbered in
    16 bits."""
    items = items.select("uid", "length")
    settings = (capacity, block_items, islands, population, generations, epochs)
    small = items.filter(F.col("length") < capacity)
    first = common.written(pack_level(small, small.count(), 0, *settings), "packing")
    poor = F.col("fill") < int(good_fill * capacity)
    pool = first.filter(poor).select("uid", "length")
    second = pack_level(pool, pool.count(), 1, *settings)
    full = items.filter(F.col("length") == capacity).select("uid", (-1 - F.col("uid")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return full.unionByName(first.filter(~poor).select("uid", "sequence_id", "offset")).unionByName(
        second.select("uid", "sequence_id", "offset"))


def sequences(pieces: DataFrame, places: DataFrame) -> DataFrame:
    """The packed ids: sequence_id, ids (little-endian u32, pieces by offset)."""
    def join(pdf):
        pdf = pdf.sort_values("offset")
        return pd.DataFrame({"sequence_id": pdf["sequence_id"].iloc[:1], "ids": [b"".join(pdf["ids"])]})

    rows = pieces.select("uid", "ids").join(places, "uid")
    return rows.groupBy("sequence_id").applyInPandas(join, "sequence_id long, ids binary")


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = 4096) -> DataFrame:
    """Digest of the packing of ``docs``: doc_id, piece, start, length,
    ids_crc32, sequence_id, offset.

    A null or empty text is its end id; a text longer than ``capacity`` tokens
    is cut into pieces; null ids, ties and repeated rows are packed each on
    their own; other columns are not looked at; no rows give no pieces."""
    pieces = common.written(token_pieces(docs, vocabulary, capacity), "pieces")
    places = pack(pieces, capacity)
    return digests(pieces).join(places.hint("merge"), "uid").drop("uid")

"""Mixing sources to target weights along a time-varying curriculum.

Sources share the words of the corpus by weight; a target stops at
``most_passes`` times its source, and the excess is reshared by weight.  A
source's documents stand in a fixed random order (a hash of id and text) that
is passed through as often as its target asks, the last pass in part: whole
documents only.  Where a document is longer than what is left to the target it
is skipped, and those after it go on filling until no further document fits; the
smallest one left is taken too if that comes nearer.  So a source misses its
target by at most half of the smallest document that could not be fitted in.  Each
source has a weight schedule over training time, linear from start to end.  Its integral is the source's cumulative word demand; inverting
that at the middle of a document's copy gives the copy's training position.
Documents are then sorted by position over range partitions.

Running totals are taken within cells of a source of bounded size, so a source
that holds a third of all rows is spread over many tasks.  Built-in functions
only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripwise.operators.joins import bounded_broadcast

from . import common
from .quality import words_of

WEIGHTS = (5, 2, 1)
SOURCE, SIZE, ORDER = "__mix_source", "__mix_size", "__mix_order"
#: Documents of a source that one round of filling looks at.
LIST = 1000


def sized(docs: DataFrame) -> DataFrame:
    """``docs`` with the words of the text (null: 0), a source key that is
    never null, and the place in the source's order."""
    text = F.col("text")
    spelt = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit("")))
    return docs.withColumns({
        SOURCE: F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("z")),  # null after all others
        SIZE: F.coalesce(F.size(words_of(F.coalesce(text, F.lit("")))), F.lit(0)).cast("long"),
        ORDER: F.md5(spelt.cast("binary"))})


def tilt(rank: Column) -> Column:
    """Slope of a source's schedule before centring: -1/2 (early) to 1/2 (late)."""
    return (F.pmod(rank, F.lit(5)) - 2) / F.lit(4.0)


def source_targets(rows: DataFrame, weights=WEIGHTS, most_passes: int = 3) -> DataFrame:
    """One row per source: source_size, n_rows, target, passes (whole ones),
    extra_words (of the last, partial pass) and slope of the schedule.

    With sources in ascending order of cap / weight, the words left over by
    those capped before, shared by the weights from there on, rise until the
    first source that is not capped and fall after it: the level at which
    resharing ends is their maximum."""
    sizes = rows.groupBy(SOURCE).agg(F.sum(SIZE).alias("source_size"), F.count("*").alias("n_rows"))
    # One row per source from here on.
    rank = F.row_number().over(Window.orderBy(SOURCE)) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod("rank", F.lit(len(weights))) + 1).cast("int"))
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_cap = Window.orderBy(F.col("source_size") / F.col("weight"), "rank")
    cap = F.col("source_size") * most_passes
    level = ((F.col("total") - (F.sum(cap).over(by_cap) - cap))
             / (F.sum("weight").over(everything) - F.sum("weight").over(by_cap) + F.col("weight")))
    shares = (sizes.withColumn("rank", rank).withColumn("weight", weight)
              .withColumn("total", F.sum("source_size").over(everything))
              .withColumn("level", level).withColumn("level", F.max("level").over(everything))
              .withColumn("target", F.least(cap.cast("double"), F.col("level") * F.col("weight"))))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    # Slopes are centred by share, so all schedules together stay constant.
    mean = F.sum(tilt(F.col("rank")) * F.col("target")).over(everything) / F.col("total")
    return (shares.withColumn("slope", F.when(F.col("total") > 0, tilt(F.col("rank")) - mean).otherwise(0.0))
            .withColumn("passes", whole.cast("long"))
            .withColumn("extra_words", F.col("target") - F.col("passes") * F.col("source_size"))
            .select(SOURCE, "source_size", "n_rows", "target", "passes", "extra_words", "slope"))


def running(rows: DataFrame, cells: int) -> DataFrame:
    """``rows`` with ``up_to``: words of the source's documents up to and with
    this one.  A source is cut into ``cells`` ranges of the hash; totals run
    within a cell, and over the cells of a source."""
    first = F.conv(F.substring(ORDER, 1, 8), 16, 10).cast("long")
    rows = rows.withColumn("__mix_cell", F.floor(first * F.lit(cells) / F.lit(1 << 32)).cast("int"))
    totals = rows.groupBy(SOURCE, "__mix_cell").agg(F.sum(SIZE).alias("words"))
    before = totals.select(SOURCE, "__mix_cell", (F.sum("words").over(Window.partitionBy(SOURCE).orderBy("__mix_cell")) - F.col("words")).alias("before"))
    within = Window.partitionBy(SOURCE, "__mix_cell").orderBy(ORDER, "doc_id", SIZE).rowsBetween(Window.unboundedPreceding, 0)
    return (rows.join(before.hint("shuffle_merge"), [SOURCE, "__mix_cell"])
            .withColumn("up_to", F.col("before") + F.sum(SIZE).over(within)).drop("before"))


def with_sources(rows: DataFrame, stats: DataFrame, n_sources: int) -> DataFrame:
    """Join a table of one row per source, by broadcast only while few."""
    return rows.join(F.broadcast(stats) if n_sources <= 100_000 else stats, SOURCE)


def filled(rows: DataFrame, gaps: DataFrame, n_sources: int) -> DataFrame:
    """SOURCE, up_to, size of the documents that fill the gaps: in hash order
    each document that still fits, and then the smallest other one if the
    target is nearer with it.

    A round folds over each source's next LIST documents that are no longer
    than its gap; only later ones that may still fit go on to the next round.
    The gap soon is smaller than any document, so rounds are few.  Places are
    counted within cells."""
    size, taken = F.col(SIZE), None
    gaps = gaps.select(SOURCE, "gap", F.lit(0).cast("long").alias("after"))
    left = rows.filter(size > 0).select(SOURCE, SIZE, "up_to", "__mix_cell")
    none = F.array().cast("array<struct<up_to:bigint,words:bigint>>")
    while True:
        fits = with_sources(left, gaps, n_sources).filter((size <= F.col("gap")) & (F.col("up_to") > F.col("after"))).drop("gap", "after")
        left = common.written(fits, "mix-open")
        if left.isEmpty():
            break
        counts = left.groupBy(SOURCE, "__mix_cell").agg(F.count("*").alias("n"))
        before = F.sum("n").over(Window.partitionBy(SOURCE).orderBy("__mix_cell")) - F.col("n")
        near = counts.withColumn("before", before).filter(F.col("before") < LIST).drop("n")
        place = F.row_number().over(Window.partitionBy(SOURCE, "__mix_cell").orderBy("up_to"))
        first = left.join(near.hint("shuffle_merge"), [SOURCE, "__mix_cell"]).withColumn("place", F.col("before") + place).filter(F.col("place") <= LIST)
        lists = first.groupBy(SOURCE).agg(F.sort_array(F.collect_list(F.struct("up_to", size.alias("words")))).alias("found"))

        def fill(held, d):
            return F.when(d["words"] <= held["gap"], F.struct(
                (held["gap"] - d["words"]).alias("gap"), F.array_append(held["taken"], d).alias("taken"))).otherwise(held)

        step = common.written(
            gaps.join(lists, SOURCE, "left")
            .withColumn("held", F.aggregate(F.coalesce("found", none), F.struct(F.col("gap").alias("gap"), none.alias("taken")), fill))
            .select(SOURCE, F.col("held.gap").alias("gap"), F.coalesce(F.element_at("found", -1)["up_to"], F.col("after")).alias("after"),
                    F.col("held.taken").alias("taken")), "mix-filled")
        chosen = step.select(SOURCE, F.inline("taken")).withColumnRenamed("words", SIZE)
        taken = chosen if taken is None else taken.unionByName(chosen)
        gaps = step.drop("taken")
    over = with_sources(rows.filter(size > 0).select(SOURCE, SIZE, "up_to"), gaps.select(SOURCE, "gap"), n_sources)
    over = over.filter((size > F.col("gap")) & (size < 2 * F.col("gap")))
    if taken is not None:
        over = over.join(taken.select(SOURCE, "up_to").hint("shuffle_merge"), [SOURCE, "up_to"], "left_anti")
    last = over.groupBy(SOURCE).agg(F.min(F.struct(SIZE, "up_to")).alias("d")).select(SOURCE, "d.up_to", f"d.{SIZE}")
    return last if taken is None else taken.unionByName(last)


def plan(docs: DataFrame, weights=WEIGHTS, most_passes: int = 3, cell_rows: int = 5000):
    """(rows without texts with running totals, statistics per source, the
    fillers, number of sources, cells): all that placing the documents needs."""
    light = common.written(sized(docs.select("doc_id", "text", "source")).drop("text", "source"), "mix-sizes")
    targets = common.written(source_targets(light, weights, most_passes), "mix-targets")
    n_sources, most = targets.agg(F.count("*"), F.max("n_rows")).first()
    cells = max(1, -(-(most or 0) // cell_rows))
    rows = common.written(running(light, cells), "mix-running")
    near = with_sources(rows, targets, n_sources)
    inside = F.col("up_to") <= F.col("extra_words")
    gaps = near.groupBy(SOURCE).agg(F.sum(F.when(inside, F.col(SIZE)).otherwise(0)).alias("inside_words"))
    targets = common.written(targets.join(gaps, SOURCE).withColumn("gap", F.col("extra_words") - F.col("inside_words")), "mix-inside")
    outside = with_sources(rows, targets.select(SOURCE, "extra_words"), n_sources).filter(~inside)
    fillers = common.written(filled(outside, targets, n_sources), "mix-fillers")
    more = fillers.groupBy(SOURCE).agg(F.sum(SIZE).alias("filled_words"))
    stats = (targets.join(more, SOURCE, "left")
             .withColumn("source_taken", F.col("passes") * F.col("source_size") + F.col("inside_words") + F.coalesce("filled_words", F.lit(0)))
             .drop("filled_words", "gap", "n_rows"))
    return rows, common.written(stats, "mix-sources"), fillers.select(SOURCE, "up_to"), n_sources, cells


def placed(rows: DataFrame, stats: DataFrame, fillers: DataFrame, n_sources: int) -> DataFrame:
    """``rows`` with copies, taken and positions (one per copy, from 0 to 1)."""
    size = F.col(SIZE)
    # A source's total up to a document names the document, if it has words.
    rows = rows.join(bounded_broadcast(fillers.withColumn("__mix_filler", F.lit(True))), [SOURCE, "up_to"], "left")
    filler = F.coalesce("__mix_filler", F.lit(False)) & (size > 0)
    inside = F.col("up_to") <= F.col("extra_words")
    copies = F.when(size > 0, F.col("passes") + (inside | filler).cast("long")).otherwise(0).cast("int")
    # Where the middle of copy k lies in the source's stream of taken words.
    start = F.when(filler & ~inside, F.col("inside_words")).otherwise(F.col("up_to") - size)
    rows = with_sources(rows, stats, n_sources).withColumn("copies", copies).withColumn("last_start", start)

    def position(k):
        start = F.when(k < F.col("passes"), F.col("up_to") - size).otherwise(F.col("last_start"))
        demand = (k * F.col("source_size") + start + size / F.lit(2.0)) / F.col("source_taken")
        return invert(demand, F.col("slope"))

    return rows.withColumn("taken", size * F.col("copies")).withColumn("positions", F.transform(
        F.when(F.col("copies") > 0, F.sequence(F.lit(0), F.col("copies") - 1)).otherwise(F.array().cast("array<int>")), position))


def invert(demand: Column, slope: Column) -> Column:
    """The time t at which the schedule 1 + slope (2t - 1) has met a share
    ``demand`` of the source's words: (1 - slope) t + slope t^2 = demand."""
    b = 1 - slope
    return F.when(F.abs(slope) < 1e-9, demand).otherwise(
        2 * demand / (b + F.sqrt(F.greatest(b * b + 4 * slope * demand, F.lit(0.0)))))


def assign(docs: DataFrame, weights=WEIGHTS, most_passes: int = 3, cell_rows: int = 5000) -> DataFrame:
    """doc_id, size, source_size, target, taken, position_ppm (of the first
    copy, in millionths; null if none) for every row.  Null sources are one
    source, the last; repeated rows count each; no rows give no rows."""
    rows, stats, fillers, n_sources, _ = plan(docs, weights, most_passes, cell_rows)
    return placed(rows, stats, fillers, n_sources).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col(SIZE).alias("size"), "source_size", "target", "taken",
        F.floor(F.get("positions", F.lit(0)) * 1_000_000).cast("long").alias("position_ppm"))


def training_order(docs: DataFrame, weights=WEIGHTS, most_passes: int = 3, cell_rows: int = 5000) -> DataFrame:
    """The mixed corpus: ``docs`` with one row per copy, sorted by training
    position over range partitions; columns as given, whatever their names.
    Null ids, sources and repeated rows as in ``assign``; texts without words
    have no copy; no rows give no rows."""
    names = docs.columns
    _, stats, fillers, n_sources, cells = plan(docs, weights, most_passes, cell_rows)
    whole = F.struct(*[F.col(c) for c in names]).alias("__mix_row")
    rows = sized(docs.select("doc_id", "text", "source", whole)).drop("text", "source")
    copies = placed(running(rows, cells), stats, fillers, n_sources).select("__mix_row", F.explode("positions").alias("__mix_position"))
    return copies.repartitionByRange("__mix_position").sortWithinPartitions("__mix_position").select("__mix_row.*")


ORACLE = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS place FROM documents),
sources AS (
  SELECT source, sum(size) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM docs GROUP BY source),
weighted AS (
  SELECT *, [{", ".join(map(str, WEIGHTS))}][rank % {len(WEIGHTS)} + 1] AS weight, sum(source_size) OVER () AS total FROM sources),
levels AS (
  SELECT *, CAST(total - sum(3 * source_size) OVER before AS DOUBLE) + 3 * source_size AS free,
         CAST(sum(weight) OVER () - sum(weight) OVER before + weight AS DOUBLE) AS open_weight FROM weighted
  WINDOW before AS (ORDER BY source_size / weight, rank)),
targets AS (
  SELECT *, least(CAST(3 * source_size AS DOUBLE), max(free / open_weight) OVER () * weight) AS target FROM levels),
passes AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS passes,
         (rank % 5 - 2) / 4.0 - sum((rank % 5 - 2) / 4.0 * target) OVER () / total AS slope FROM targets),
running AS (
  SELECT d.*, p.* EXCLUDE (source), target - passes * source_size AS extra_words,
         CAST(sum(size) OVER (PARTITION BY d.source ORDER BY place, doc_id, size ROWS UNBOUNDED PRECEDING) AS BIGINT) AS up_to
  FROM docs d JOIN passes p ON d.source IS NOT DISTINCT FROM p.source),
inside AS (
  SELECT *, up_to <= extra_words AS is_inside,
         sum(CASE WHEN up_to <= extra_words THEN size ELSE 0 END) OVER (PARTITION BY source) AS inside_words FROM running),
gaps AS (
  SELECT *, extra_words - inside_words AS gap FROM inside),
outside AS (
  SELECT source, gap, size, up_to FROM gaps WHERE NOT is_inside AND size > 0),
fill AS (
  SELECT source, CAST(max(gap) AS DOUBLE) AS gap, CAST(0 AS BIGINT) AS up_to FROM gaps GROUP BY source
  UNION ALL
  SELECT f.source, arg_min(f.gap - o.size, o.up_to), min(o.up_to)
  FROM fill f JOIN outside o ON o.source IS NOT DISTINCT FROM f.source AND o.up_to > f.up_to AND o.size <= f.gap GROUP BY f.source),
rest AS (
  SELECT source, arg_max(gap, up_to) AS gap FROM fill GROUP BY source),
closing AS (
  SELECT o.source, o.up_to, row_number() OVER (PARTITION BY o.source ORDER BY o.size, o.up_to) AS nth
  FROM outside o JOIN rest e ON o.source IS NOT DISTINCT FROM e.source
  LEFT JOIN fill g ON g.source IS NOT DISTINCT FROM o.source AND g.up_to = o.up_to
  WHERE g.up_to IS NULL AND o.size > e.gap AND o.size < 2 * e.gap),
extra AS (
  SELECT source, up_to FROM fill WHERE up_to > 0 UNION ALL SELECT source, up_to FROM closing WHERE nth = 1),
fillers AS (
  SELECT g.*, size > 0 AND e.up_to IS NOT NULL AS is_filler
  FROM gaps g LEFT JOIN extra e ON g.source IS NOT DISTINCT FROM e.source AND g.up_to = e.up_to AND size > 0),
copies AS (
  SELECT *, CASE WHEN size > 0 THEN passes + CASE WHEN is_inside OR is_filler THEN 1 ELSE 0 END ELSE 0 END AS copies FROM fillers),
demand AS (
  SELECT *, (CASE WHEN passes = 0 AND is_filler THEN inside_words ELSE up_to - size END + size / 2.0)
            / sum(copies * size) OVER (PARTITION BY source) AS demand FROM copies),
positions AS (
  SELECT *, CASE WHEN abs(slope) < 1e-9 THEN demand
                 ELSE 2 * demand / (1 - slope + sqrt(greatest((1 - slope) * (1 - slope) + 4 * slope * demand, 0))) END AS position FROM demand)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, target,
       CAST(size * copies AS BIGINT) AS taken,
       CASE WHEN copies > 0 THEN CAST(floor(position * 1000000) AS BIGINT) END AS position_ppm
FROM positions"""

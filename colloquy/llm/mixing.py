"""Mixing sources to target weights by Pfair scheduling, with DataFrame and SQL functions only.

A source's documents are laid end to end and cut into blocks of `block_chars` characters; a document belongs to the block
in which it starts.  So that the schedule stays small beside any corpus, blocks get longer where there would be more than `max_blocks`.
Shares are used as they are, without rounding: while sources have blocks left, each gets its share of
the room divided by the shares of those, so block k of a source of share s and b blocks would begin at T(k / s) and end at
T((k + 1) / s), where T(v) is the sum over sources of min(b, s v).  The floor of the one is the block's release and the ceiling
of the other its deadline.  Each slot goes to the released block with the earliest deadline (ties: by source), which
meets every deadline and leaves no slot empty, so after any number of slots a source is less than one block away from its
target.  Slots depend on one another, so one task goes through them, at most `max_blocks` and one a source; it holds one
number per block, and no documents.

Every document is scheduled once; none is dropped or repeated.  Positions inside a source come from sums per bucket of
hashed ids, so that no task holds a whole source.  Rules: a null source counts as the source '', null and empty texts
take no room and belong to the block that is open; a text longer than a block takes the room of several and belongs to the first; repeated
rows are scheduled each; a source of weight 0 comes last; other columns are ignored, whatever their names; an empty table gives none.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import drop_stored, fresh, stored, table, with_row_ids

BLOCK_CHARS = 16_384
#: Blocks that the corpus is cut into at most, besides one for each source.
MAX_BLOCKS = 1 << 20
#: Without target weights, a source weighs its size to this power.
TEMPERATURE = 0.5
#: Schedules up to so many slots (about 250 bytes each) are broadcast; longer ones are joined by shuffle.
BROADCAST_SLOTS = 1 << 17
#: Slots in one array of the pass over them.
PIECE = 512
#: Times this close to a whole number are that number.
_NEAR = 1e-6


def schedule(docs: DataFrame, weights: dict[str, float] | None = None, *, block_chars: int = BLOCK_CHARS, max_blocks: int = MAX_BLOCKS, temperature: float = TEMPERATURE, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, source, n_units, block, release, deadline, slot for every row of docs (doc_id, text, source), and the columns to keep.

    weights maps sources to target weights; sources it doesn't name weigh as the least it names.
    """
    rows = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("source"), F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_units"), *keep)
    rows = rows.withColumn("key", F.xxhash64("doc_id", "n_units"))
    n = docs.select("doc_id").count()
    rows = rows.withColumn("bucket", F.pmod("key", F.lit(max(64, math.isqrt(4 * n)))))
    # a second level keeps the window over buckets short: sums per bucket, then offsets of buckets within a source
    sums = stored(rows.groupBy("source", "bucket").agg(F.sum("n_units").alias("units")))
    size = max(block_chars, -(-(sums.agg(F.sum("units")).first()[0] or 0) // max_blocks))
    of_source = Window.partitionBy("source")
    before = F.sum("units").over(of_source.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sums.select("source", "bucket", F.coalesce(before, F.lit(0)).alias("offset"), _blocks(F.sum("units").over(of_source), size).alias("blocks"))
    within = Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "n_units", *keep)
    placed = rows.withColumn("inside", F.coalesce(F.sum("n_units").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    # the last block may be one too far where a source's last documents are empty: they join the block before
    block = F.least(F.expr(f"(offset + inside) div {size}L"), F.col("blocks") - 1)
    placed = placed.join(offsets, ["source", "bucket"]).select("doc_id", "source", "n_units", *keep, block.alias("block"))
    slots, count = plan(sums, weights, size, temperature)
    out = placed.join(F.broadcast(slots) if count <= BROADCAST_SLOTS else slots, ["source", "block"])
    return out.select("doc_id", "source", "n_units", "block", "release", "deadline", "slot", *keep)


def _blocks(units, size: int):
    return F.greatest(F.lit(1), F.ceil(units / F.lit(size))).cast("long")


def plan(sums: DataFrame, weights: dict[str, float] | None, size: int, temperature: float) -> tuple[DataFrame, int]:
    """The schedule (source, block, release, deadline, slot) of sources cut into blocks of `size` units, and its length; sums has (source, units)."""
    totals = sums.groupBy("source").agg(F.sum("units").alias("units"))
    if weights:
        named = F.create_map(*[x for k, v in weights.items() for x in (F.lit(k), F.lit(float(v)))])
        share = F.coalesce(named[F.col("source")], F.lit(float(min(weights.values()))))
    else:
        share = F.pow(F.greatest(F.col("units"), F.lit(1)).cast("double"), F.lit(float(temperature)))
    return scheduled(totals.select("source", share.alias("share"), _blocks(F.col("units"), size).alias("blocks")))


def scheduled(sources: DataFrame) -> tuple[DataFrame, int]:
    """(source, block, release, deadline, slot) of every block of sources (source, share, blocks), stored, and how many there are."""
    everything = Window.partitionBy(F.lit(0))  # a row per source
    least = F.greatest(F.max("share").over(everything) * 1e-9, F.lit(1e-300))
    sources = sources.withColumn("share", F.greatest("share", least)).withColumn("end", F.col("blocks") / F.col("share"))
    earlier = Window.partitionBy(F.lit(0)).orderBy("end", "source").rowsBetween(Window.unboundedPreceding, 0)
    later = Window.partitionBy(F.lit(0)).orderBy(F.desc("end"), F.desc("source")).rowsBetween(Window.unboundedPreceding, -1)
    phase = F.struct(F.sum("blocks").over(earlier).alias("gone"), F.coalesce(F.sum("share").over(later), F.lit(0.0)).alias("going"))
    sources = sources.select("source", "share", "blocks", phase.alias("phase"), F.sum("share").over(everything).alias("all"))
    # T at the start of every block; where a source's last block ends, its share goes to the others
    points = sources.select("*", F.explode(F.sequence(F.lit(0).cast("long"), "blocks")).alias("block")).withColumn("v", F.col("block") / F.col("share"))
    so_far = Window.partitionBy(F.lit(0)).orderBy("v", "source", "block").rowsBetween(Window.unboundedPreceding, 0)
    points = points.withColumn("now", F.last(F.when(F.col("block") == F.col("blocks"), F.col("phase")), ignorenulls=True).over(so_far))
    points = points.withColumn("time", F.coalesce("now.gone", F.lit(0)) + F.coalesce("now.going", "all") * F.col("v"))
    ends = F.lead("time").over(Window.partitionBy("source").orderBy("block"))
    points = points.withColumn("ends", ends).where("block < blocks")
    points = points.select("source", "block", F.floor(F.col("time") + _NEAR).alias("release"), F.ceil(F.col("ends") - _NEAR).alias("deadline"))
    # a block's number is its place by deadline: the earliest deadline is the least number
    number = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("deadline", "source", "block"))
    blocks = stored(points.withColumn("number", number))
    count = blocks.count()
    came = blocks.groupBy("release").agg(F.collect_list("number").alias("numbers"))
    slots = sources.sparkSession.range(count).select(F.col("id").alias("release")).join(came, "release", "left")
    none = F.expr("cast(array() as array<int>)")
    pieces = slots.groupBy(F.expr(f"release div {PIECE}").alias("piece")).agg(F.sort_array(F.collect_list(F.struct("release", F.coalesce("numbers", none).alias("numbers"))))["numbers"].alias("slots"))
    whole = pieces.agg(F.sort_array(F.collect_list(F.struct("piece", "slots")))["slots"].alias("pieces"))
    order = whole.select(F.posexplode(F.expr(_EARLIEST_DEADLINE_FIRST)).alias("at", "number"))
    out = stored(order.join(blocks, "number").select("source", "block", "release", "deadline", F.col("at").cast("long").alias("slot")))
    drop_stored(blocks)
    return out, count


def _let(name: str, value: str, body: str) -> str:
    """body with name bound to value, worked out once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


_SLOT = _let("r", "concat(x.ready, came)", _let("next", "array_min(r)", "named_struct('ready', array_remove(r, next), 'out', concat(x.out, array(next)))"))
_PIECE_DONE = f"aggregate(p, named_struct('ready', s.ready, 'out', cast(array() as array<int>)), (x, came) -> {_SLOT})"
#: From pieces, the numbers of the blocks released at each slot, to the numbers in the order of slots.
_EARLIEST_DEADLINE_FIRST = (
    "aggregate(pieces, named_struct('ready', cast(array() as array<int>), 'outs', cast(array() as array<array<int>>)), (s, p) -> "
    + _let("y", _PIECE_DONE, "named_struct('ready', y.ready, 'outs', concat(s.outs, array(y.out)))")
    + ", s -> flatten(s.outs))"
)


def mixed(docs: DataFrame, weights: dict[str, float] | None = None, **kwargs) -> DataFrame:
    """docs in schedule order: partitions follow one another in slots, and rows are sorted within each."""
    spark, columns = docs.sparkSession, docs.columns
    file, row, slot = (fresh(docs, x) for x in ("file", "row", "slot"))
    rows = with_row_ids(docs, file=file, row=row)
    slots = schedule(rows, weights, keep=(file, row), **kwargs).select(file, row, F.col("slot").alias(slot))
    slots = stored(slots)
    last = slots.agg(F.max(slot)).first()[0]
    if last is None:
        return docs
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.join(slots, [file, row])
    rows = rows.repartitionById(parts, F.expr(f"cast(`{slot}` * {parts} div {last + 1} as int)"))
    return rows.sortWithinPartitions(slot, "doc_id", row).select(*columns)


def op7_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schedule(table(spark, sf_dir, "documents"))

"""As-of join: for each row of one side the nearest row of the other in time, within equal keys.

Both sides are laid side by side (a union, not a join) and cut into (key, slot of time); a running
``last`` over each slot in time order gives every left row the right row before it. What a slot
inherits from earlier ones is a prefix maximum in two levels: over the slots of a block of ``SLOT_BLOCK``, and over one row per
block and key. So no task holds more than the rows of one key and slot, and
no intermediate result has more rows than the two sides together, whatever the span of time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SLOT_BLOCK = 1024
HOUR_MS = 3_600_000


def asof_join(
    left: DataFrame, right: DataFrame, left_time: str, right_time: str, by: tuple[str, ...] | list[str] = (),
    direction: str = "backward", ties: str = "max", slot_ms: int = HOUR_MS,
) -> DataFrame:
    """Every row of ``left`` with the columns of its row of ``right``, nulls if it has none.

    ``backward`` takes the latest right row at or before the left row's time, ``forward`` the earliest at or after it. Of
    right rows with equal keys and time the greatest by all other columns counts (``ties="min"``: the least). Times are
    long columns. Null keys or times match nothing. Columns of ``right`` other than ``by`` must not occur in ``left``.
    """
    if direction not in ("backward", "forward") or ties not in ("max", "min"):
        raise ValueError("direction is backward or forward, ties max or min")
    by = list(by)
    values = [c for c in right.columns if c not in by]
    if clash := set(values) & set(left.columns):
        raise ValueError(f"columns of both sides: {sorted(clash)}")
    sign = 1 if direction == "backward" else -1
    keys = [f"_k{i}" for i in range(len(by))]
    slot = F.floor(F.col("_t") / F.lit(slot_ms)).cast("bigint")
    usable = F.col(right_time).isNotNull()
    for c in by:
        usable &= F.col(c).isNotNull()
    rest = [c for c in values if c != right_time]
    pick = (F.max if ties == "max" else F.min)(F.struct(*rest, right_time))
    r = right.filter(usable).select(*[F.col(c).alias(k) for c, k in zip(by, keys, strict=True)], (sign * F.col(right_time)).cast("bigint").alias("_t"), *values)
    r = r.groupBy(*keys, "_t").agg(pick.alias("_v")).withColumn("_slot", slot)
    rows = left.select(F.struct(*left.columns).alias("_row"), *[F.col(c).alias(k) for c, k in zip(by, keys, strict=True)], (sign * F.col(left_time)).cast("bigint").alias("_t")).withColumn("_slot", slot)

    # what each slot with rows inherits from the slots before it
    found = r.groupBy(*keys, "_slot").agg(F.max_by("_v", "_t").alias("_last"))
    none = F.lit(None).cast(found.schema["_last"].dataType)
    slots = found.unionByName(rows.select(*keys, "_slot").distinct().withColumn("_last", none))
    slots = slots.groupBy(*keys, "_slot").agg(F.first("_last", ignorenulls=True).alias("_last"))
    slots = slots.withColumn("_block", F.floor(F.col("_slot") / SLOT_BLOCK).cast("bigint"))
    before = lambda order, *part: F.last("_last", ignorenulls=True).over(Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    blocks = slots.filter("_last IS NOT NULL").groupBy(*keys, "_block").agg(F.max_by("_last", "_slot").alias("_last"))
    # a block without right rows of its own inherits too
    blocks = blocks.unionByName(slots.select(*keys, "_block").distinct().withColumn("_last", none))
    blocks = blocks.groupBy(*keys, "_block").agg(F.first("_last", ignorenulls=True).alias("_last"))
    blocks = blocks.select(*keys, "_block", before("_block", *keys).alias("_earlier"))
    seeds = slots.withColumn("_inside", before("_slot", *keys, "_block"))
    same = F.lit(True)
    for k in [*keys, "_block"]:
        same &= seeds[k].eqNullSafe(blocks[k])
    seeds = seeds.join(blocks, same).select(*[seeds[k] for k in keys], "_slot", F.coalesce("_inside", "_earlier").alias("_v")).filter("_v IS NOT NULL")

    empty = F.lit(None).cast(rows.schema["_row"].dataType)
    marks = rows.withColumn("_v", none).withColumn("_kind", F.lit(2))
    marks = marks.unionByName(r.withColumn("_row", empty).withColumn("_kind", F.lit(1)))
    marks = marks.unionByName(seeds.withColumn("_row", empty).withColumn("_t", F.lit(None).cast("bigint")).withColumn("_kind", F.lit(0)))
    running = Window.partitionBy(*keys, "_slot").orderBy(F.col("_t").asc_nulls_first(), "_kind").rowsBetween(Window.unboundedPreceding, 0)
    out = marks.withColumn("_v", F.last("_v", ignorenulls=True).over(running)).filter("_kind = 2")
    return out.select("_row.*", *[F.col("_v")[c].alias(c) for c in values])

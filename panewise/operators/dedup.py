"""T2 (batch form): keep the first arrival per key, or first-per-TTL.

Semantics of the job's dedup: keyed by ``event_id`` alone; the first arrival
wins even if payloads differ; an accepted row starts a clock of ``ttl_ms`` and
rejected duplicates do not restart it; once the clock runs out the next
arrival is accepted again (an arrival exactly ``ttl_ms`` later is accepted).
In batch form the processing-time clock is a given arrival column.

Nulls: a null key is a key like any other (its rows are duplicates of each other).
A row without an arrival time has no place on the clock: it is always kept and
starts no clock. Both are settled before rows take one of the two paths below,
so the result never depends on how many rows a key has.

Kept rows of one key form the chain ``s, nxt(s), nxt(nxt(s)), ...`` where
``s`` is the first arrival and ``nxt(x)`` the first arrival ``>= x + ttl``.

Scale plan:
* ``ttl_ms=None`` (never expire) is ``min(struct)`` per key: a combinable
  aggregate, partial before the shuffle, so a hot key costs one row per task.
* With a TTL, keys are split by their row count. Ordinary keys (at most
  ``max_light`` rows) fold their sorted arrivals in one JVM ``aggregate``
  (bounded by ``max_light``). Hot keys link their distinct arrival times to
  ``nxt`` with windows partitioned by (key, slot of time). A slot is the smaller of
  the TTL / ``SLOTS_PER_TTL`` and ``MAX_SLOT_MS``, so one window holds few distinct times
  whatever the TTL; the next later slot with rows is found in two levels (within
  ``SLOT_BLOCK`` slots, then over blocks). The chain is found by pointer doubling
  (``log2`` of the chain length joins on (key, time), checkpointed).
* No side is broadcast by hint: Spark decides by the bytes it has seen at run time.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panewise.session import ensure_checkpoint_dir

# A key with more rows than this goes through the split (hot-key) path.
DEFAULT_MAX_LIGHT = 1000
SLOTS_PER_TTL, MAX_SLOT_MS, SLOT_BLOCK = 64, 60_000, 1024
_MAX_LONG = (1 << 63) - 1


def dedup_first(df: DataFrame, key: str = "event_id", time_col: str = "arrival_ms") -> DataFrame:
    """Unbounded dedup: the earliest row per key (ties broken by the other columns)."""
    rest = [c for c in df.columns if c not in (key, time_col)]
    first = df.groupBy(key).agg(F.min(F.struct(time_col, *rest)).alias("_r"))
    return first.select(key, "_r.*").select(*df.columns)


def dedup_ttl(
    df: DataFrame,
    key: str = "event_id",
    time_col: str = "arrival_ms",
    ttl_ms: int | None = 3_600_000,
    max_light: int = DEFAULT_MAX_LIGHT,
) -> DataFrame:
    """First arrival per key, accepted again once ``ttl_ms`` has passed since the last accept."""
    if ttl_ms is None:
        return dedup_first(df, key, time_col)
    if ttl_ms <= 0:
        return df
    untimed = df.filter(F.col(time_col).isNull())
    timed = df.filter(F.col(time_col).isNotNull())
    heavy_keys = timed.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > max_light)
    heavy_keys = heavy_keys.select(F.col(key).alias("_hk"))
    if heavy_keys.isEmpty():
        return _fold_light(timed, key, time_col, ttl_ms).unionByName(untimed)
    same = F.col(key).eqNullSafe(F.col("_hk"))
    light = timed.join(heavy_keys, same, "left_anti")
    heavy = timed.join(heavy_keys, same, "left_semi")
    kept = _fold_light(light, key, time_col, ttl_ms).unionByName(_chain_heavy(heavy, key, time_col, ttl_ms))
    return kept.unionByName(untimed)


def _fold_light(df: DataFrame, key: str, time_col: str, ttl_ms: int) -> DataFrame:
    """Greedy TTL walk over each key's sorted arrivals, entirely in JVM expressions."""
    rest = [c for c in df.columns if c not in (key, time_col)]
    item = F.struct(time_col, *rest)
    grouped = df.groupBy(key).agg(F.sort_array(F.collect_list(item)).alias("_xs"))
    ttl = F.lit(ttl_ms).cast("bigint")
    init = F.struct(
        F.lit(None).cast("bigint").alias("last"),
        F.slice(F.col("_xs"), 1, 0).alias("kept"),
    )

    def step(acc, x):
        # times ascend, so a difference beyond the largest long is longer than any TTL
        take = acc["last"].isNull() | F.coalesce(F.try_subtract(x[time_col], acc["last"]) >= ttl, F.lit(True))
        return F.when(
            take, F.struct(x[time_col].alias("last"), F.concat(acc["kept"], F.array(x)).alias("kept"))
        ).otherwise(acc)

    kept = F.aggregate(F.col("_xs"), init, step, lambda acc: acc["kept"])
    return grouped.select(key, F.inline(kept)).select(*df.columns)


def _chain_heavy(df: DataFrame, key: str, time_col: str, ttl_ms: int) -> DataFrame:
    """Exact TTL dedup for hot keys without gathering any key in one task."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    rest = [c for c in df.columns if c not in (key, time_col)]
    ttl = F.lit(ttl_ms).cast("bigint")
    slot = F.lit(max(1, min(ttl_ms // SLOTS_PER_TTL, MAX_SLOT_MS))).cast("bigint")

    # Distinct arrival times per key; only the first row at a time can be accepted.
    item = F.struct(*rest) if rest else F.struct(F.lit(0).alias("_none"))
    firsts = df.groupBy(F.col(key).alias("_k"), F.col(time_col).cast("bigint").alias("_t")).agg(F.min(item).alias("_r"))
    firsts = firsts.checkpoint()
    times = firsts.select("_k", "_t")

    # nxt(x) = min{t >= x + ttl}. A probe at x + ttl lands in a slot; the answer is the
    # first time in that slot from the probe on, else the first time of a later slot.
    null = F.lit(None).cast("bigint")
    reals = times.select("_k", F.col("_t").alias("_pos"), F.lit(0).alias("_kind"), F.col("_t").alias("_val"), null.alias("_src"))
    # a time whose TTL ends beyond the largest long has no next accept
    probes = times.filter(F.try_add("_t", ttl).isNotNull()).select("_k", (F.col("_t") + ttl).alias("_pos"), F.lit(1).alias("_kind"), null.alias("_val"),
                          F.col("_t").alias("_src"))
    marks = reals.unionByName(probes).withColumn("_slot", F.floor(F.col("_pos") / slot).cast("bigint"))
    slots = marks.groupBy("_k", "_slot").agg(F.min("_val").alias("_m"))
    slots = slots.withColumn("_blk", F.floor(F.col("_slot") / SLOT_BLOCK).cast("bigint"))
    blocks = slots.groupBy("_k", "_blk").agg(F.min("_m").alias("_bm"))
    after_block = Window.partitionBy("_k").orderBy(F.col("_blk").desc()).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(F.col("_k").alias("_bk"), F.col("_blk").alias("_bb"), F.min("_bm").over(after_block).alias("_in_later"))
    after_slot = Window.partitionBy("_k", "_blk").orderBy(F.col("_slot").desc()).rowsBetween(Window.unboundedPreceding, -1)
    seeds = slots.withColumn("_in_block", F.min("_m").over(after_slot)).join(
        blocks, F.col("_k").eqNullSafe(F.col("_bk")) & (F.col("_blk") == F.col("_bb"))
    )
    seeds = seeds.select("_k", F.lit(_MAX_LONG).alias("_pos"), F.lit(0).alias("_kind"),
                         F.coalesce("_in_block", "_in_later").alias("_val"), null.alias("_src"), "_slot")
    run = (Window.partitionBy("_k", "_slot").orderBy(F.col("_pos").desc(), F.col("_kind"))
           .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    links = (marks.unionByName(seeds)
             .withColumn("_nxt", F.min("_val").over(run))
             .filter(F.col("_kind") == 1)
             .select("_k", F.col("_src").alias("_t"), "_nxt")
             .checkpoint())

    # Pointer doubling: jumps[j] maps a time to the accept 2^j steps later. Accepts of a key are a TTL apart.
    reach = F.coalesce(F.try_subtract(F.max("_t"), F.min("_t")), F.lit(_MAX_LONG))
    span = times.groupBy("_k").agg(F.floor(reach / ttl).alias("_n"), F.count(F.lit(1)).alias("_c"))
    longest = (span.agg(F.max(F.least("_n", "_c"))).first()[0] or 0) + 1
    levels = max(1, math.ceil(math.log2(max(2, longest))))
    jumps = [links]
    for _ in range(1, levels):
        a, b = jumps[-1], jumps[-1].select(F.col("_k").alias("_bk"), F.col("_t").alias("_bt"), F.col("_nxt").alias("_far"))
        hop = a.join(b, F.col("_k").eqNullSafe(F.col("_bk")) & (F.col("_nxt") == F.col("_bt")), "left")
        jumps.append(hop.select("_k", "_t", F.col("_far").alias("_nxt")).checkpoint())

    # Chain = start plus every sum of distinct powers of two below 2^levels.
    chain = times.groupBy("_k").agg(F.min("_t").alias("_t")).checkpoint()
    for hop in reversed(jumps):
        far = hop.filter(F.col("_nxt").isNotNull()).select(F.col("_k").alias("_bk"), F.col("_t").alias("_bt"), "_nxt")
        step = chain.join(far, F.col("_k").eqNullSafe(F.col("_bk")) & (F.col("_t") == F.col("_bt")))
        chain = chain.unionByName(step.select("_k", F.col("_nxt").alias("_t"))).checkpoint()

    chain = chain.select(F.col("_k").alias("_ck"), F.col("_t").alias("_ct"))
    kept = firsts.join(chain, F.col("_k").eqNullSafe(F.col("_ck")) & (F.col("_t") == F.col("_ct")), "left_semi")
    cols = [F.col("_k").alias(key), F.col("_t").cast(df.schema[time_col].dataType).alias(time_col)]
    return kept.select(*cols, *[F.col("_r")[c].alias(c) for c in rest]).select(*df.columns)

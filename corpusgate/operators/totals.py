"""Running totals over a whole table without a one-partition window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FANOUT_BITS = 16


def global_running_total(df: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """Exclusive running total of ``value`` in order of a unique, non-negative integer key.

    Keys are grouped by their high bits, level by level; a window never spans more than ``2**16`` rows, and the total
    of everything before a group is added on the way down.  The number of levels follows from the largest key.
    """
    low, high = df.agg(F.min(key), F.max(key)).first()
    if low is not None and low < 0:
        raise ValueError(f"a negative key: {low}")
    levels = max(1, -(-int(high or 0).bit_length() // FANOUT_BITS))
    rungs = [df.select(F.col(key).alias("_id0"), F.col(value).cast("bigint").alias("_v"))]
    for level in range(1, levels):
        prev = rungs[-1]
        group = F.shiftright(F.col(f"_id{level - 1}"), FANOUT_BITS).alias(f"_id{level}")
        rungs.append(prev.groupBy(group).agg(F.sum("_v").alias("_v")))
    above = None
    for level in range(levels - 1, -1, -1):
        me, up = f"_id{level}", f"_up{level}"
        r = rungs[level].withColumn(up, F.shiftright(F.col(me), FANOUT_BITS))
        w = Window.partitionBy(up).orderBy(me).rowsBetween(Window.unboundedPreceding, -1)
        r = r.withColumn("_run", F.coalesce(F.sum("_v").over(w), F.lit(0).cast("bigint")))
        if above is not None:
            r = r.join(above.select(F.col(f"_id{level + 1}").alias(up), F.col("_run").alias("_base")), up)
            r = r.withColumn("_run", F.col("_run") + F.col("_base"))
        above = r.select(me, "_run")
    return df.join(above.select(F.col("_id0").alias(key), F.col("_run").alias(out)), key)

"""Exact quantiles without a task that holds a whole group.

A value -> count histogram is cut into value ranges; totals per range are a
small table, whose running sums place each range among the group's ranks. A
rank is then looked up inside its range alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, qs: Sequence[float], ranges: int = 256) -> DataFrame:
    """One row per group of ``keys``: ``n`` and ``q0, q1, ...``, the quantiles
    ``qs`` of the non-null values with linear interpolation. ``ranges`` bounds
    the cut points (from a sketch of the distinct values) that reach the
    driver; a window never spans more than one range of one group."""
    keys = list(keys)
    hist = (df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).cast("double").alias("_v"))
            .agg(F.count(F.lit(1)).alias("_c")))
    cuts = sorted(set(hist.approxQuantile("_v", [i / ranges for i in range(1, ranges)], 0.25 / ranges)))
    bucket = F.lit(0)
    if cuts:
        bucket = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c < F.col("_v")))
    h = hist.withColumn("_b", bucket)
    totals = h.groupBy(*keys, "_b").agg(F.sum("_c").alias("_t"))
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    place = totals.select(*keys, "_b", (F.sum("_t").over(before) - F.col("_t")).alias("_off"),
                          F.sum("_t").over(Window.partitionBy(*keys)).alias("_n"))
    inside = Window.partitionBy(*keys, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = (h.withColumn("_to", F.sum("_c").over(inside)).join(place, [*keys, "_b"])
              .withColumn("_to", F.col("_off") + F.col("_to")).withColumn("_from", F.col("_to") - F.col("_c")))
    aggs = [F.max("_n").alias("n")]
    for k, q in enumerate(qs):
        at = F.lit(float(q)) * (F.col("_n") - 1)
        for name, rank in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            aggs.append(F.max(F.when((F.col("_from") <= rank) & (rank < F.col("_to")), F.col("_v"))).alias(f"_{name}{k}"))
    found = ranked.groupBy(*keys).agg(*aggs)
    part = lambda q: F.lit(float(q)) * (F.col("n") - 1) - F.floor(F.lit(float(q)) * (F.col("n") - 1))
    return found.select(*keys, "n", *[(F.col(f"_lo{k}") + (F.col(f"_hi{k}") - F.col(f"_lo{k}")) * part(q)).alias(f"q{k}")
                                      for k, q in enumerate(qs)])

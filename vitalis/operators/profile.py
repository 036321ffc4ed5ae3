"""Profiling and data-quality aggregates (inventory 2.4).

Rule: one aggregate pass per profile (conditional sums in a single
``agg``), never one job per column; only grouped or bounded results are
reshaped with ``stack``/windows afterwards.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalis import schemas as S
from vitalis.operators.clean import target_ordinal


def class_distribution(df: DataFrame, target: str = "target",
                       order: Sequence[str] | None = S.TARGET_ORDER) -> DataFrame:
    """``agg_class_distribution`` / ``agg_table_distribution``: rows and
    rate per class. The total is one row, from the grouped result."""
    g = df.groupBy(target).agg(F.count(F.lit(1)).alias("rows"))
    total = g.agg(F.sum("rows").alias("_n"), F.lit(0).alias("_g"))  # one row
    out = (g.withColumn("_g", F.lit(0)).join(F.broadcast(total), "_g")
           .select(target, "rows", (F.col("rows") / F.col("_n")).alias("rate")))
    if order is not None:
        out = out.withColumn("class_order", target_ordinal(target))
    return out


def imbalance_ratio(df: DataFrame, target: str = "target") -> DataFrame:
    """``agg_imbalance_ratio``: largest class count / smallest."""
    g = df.groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    return g.agg((F.max("n") / F.min("n")).alias("imbalance_ratio"))


def unpivot_stats(row_df: DataFrame, names: Sequence[str], fields: Sequence[str],
                  key: str = "field") -> DataFrame:
    """Turn one wide aggregate row with columns ``{name}__{field}`` into one
    row per name (``stack``); input is a single row."""
    n = len(names)
    args = ", ".join(
        f"'{nm}', " + ", ".join(f"`{nm}__{f}`" for f in fields) for nm in names)
    cols = ", ".join([key, *fields])
    return row_df.selectExpr(f"stack({n}, {args}) AS ({cols})")


def schema_profile(df: DataFrame, exact_distinct: bool = True) -> DataFrame:
    """``agg_schema_profile``: per column dtype, nulls, null_rate and
    unique values in one aggregate pass. ``exact_distinct=False`` swaps the
    exact distinct count for HyperLogLog++ (bounded memory at any scale).
    The repeated ``count(1)`` is one aggregate after Catalyst dedup."""
    aggs = []
    for c in df.columns:
        d = F.countDistinct(F.col(c)) if exact_distinct else F.approx_count_distinct(F.col(c))
        aggs += [F.count(F.lit(1)).alias(f"{c}__rows"),
                 F.count_if(F.col(c).isNull()).alias(f"{c}__nulls"),
                 d.alias(f"{c}__unique_values")]
    long = unpivot_stats(df.agg(*aggs), df.columns, ["rows", "nulls", "unique_values"], "column")
    dtypes = dict(df.dtypes)
    dt = F.create_map(*[x for c in df.columns for x in (F.lit(c), F.lit(dtypes[c]))])
    return long.select(
        "column", dt[F.col("column")].alias("dtype"), F.col("nulls").cast("bigint").alias("nulls"),
        F.when(F.col("rows") > 0, F.col("nulls") / F.col("rows")).otherwise(F.lit(0.0)).alias("null_rate"),
        F.col("unique_values").cast("bigint").alias("unique_values"))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """``agg_duplicate_rows``: rows and copies after the first (NULL equals
    NULL), grouped by the SHA-256 of the row: whole texts stay where they are,
    32 bytes a row move, with map-side partial counts."""
    # As JSON, a NULL is left out and anything else is quoted: no two rows share one.
    row = F.unhex(F.sha2(F.to_json(F.struct(*df.columns)), 256))
    g = df.groupBy(row.alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    return g.agg(F.sum("_n").alias("rows"), F.sum(F.col("_n") - 1).alias("duplicate_rows"))


def duplicate_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``agg_duplicate_key``: rows with a missing key part, and rows beyond
    the first per key."""
    miss = F.lit(False)
    for k in keys:
        miss = miss | F.col(k).isNull()
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.count_if(miss).alias("_m"))
    return g.agg(F.sum("_m").cast("bigint").alias("missing_keys"),
                 F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("duplicated_keys"))


def binary_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``agg_binary_column``: non-null values outside {0, 1}, per column,
    in one pass."""
    row = df.agg(*[F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(0, 1)).alias(f"{c}__invalid_rows")
                   for c in cols])
    return unpivot_stats(row, list(cols), ["invalid_rows"], "column")


def describe_lengths(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``agg_text_describe``: count, mean, sample std, min, 5/50/95 %
    (linear interpolation) and max per numeric column, one pass. Exact
    percentiles hold a value->count map, bounded by distinct lengths."""
    aggs = []
    for c in cols:
        q = F.percentile(F.col(c), [0.05, 0.5, 0.95])
        aggs += [F.count(c).alias(f"{c}__count"), F.round(F.avg(c), 6).alias(f"{c}__mean"),
                 F.round(F.stddev_samp(c), 6).alias(f"{c}__std"), F.min(c).cast("double").alias(f"{c}__min"),
                 F.round(q[0], 6).alias(f"{c}__p05"), F.round(q[1], 6).alias(f"{c}__p50"),
                 F.round(q[2], 6).alias(f"{c}__p95"), F.max(c).cast("double").alias(f"{c}__max")]
    return unpivot_stats(df.agg(*aggs), list(cols),
                         ["count", "mean", "std", "min", "p05", "p50", "p95", "max"], "measure")


def split_audit(df: DataFrame, group: str = "text_hash", target: str = "target", split: str = "split",
                digits: int | None = 6) -> DataFrame:
    """``agg_split_audit``: unique texts, repeated / conflicting / crossing
    groups, and the largest class-share drift of any split from the whole
    table in percentage points. Two grouped passes; the drift is computed on
    the (split x class) table, at most 9 rows."""
    # "More than one distinct value in the group" is max <> min (both skip
    # NULL like a distinct count): one hash aggregate, no Expand.
    g = df.groupBy(group).agg(F.count(F.lit(1)).alias("n"), (F.max(target) != F.min(target)).alias("nt"),
                              (F.max(split) != F.min(split)).alias("ns"))
    groups = g.agg(F.count(F.lit(1)).alias("unique_texts"), F.count_if(F.col("n") > 1).alias("repeated_groups"),
                   F.count_if(F.col("nt")).alias("conflicting_groups"),
                   F.count_if(F.col("ns")).alias("crossing_groups"), F.lit(0).alias("_g"))
    st = df.groupBy(split, target).agg(F.count(F.lit(1)).alias("c"))
    w_split = Window.partitionBy(split)
    w_tgt = Window.partitionBy(target)
    w_all = Window.partitionBy(F.lit(0))
    st = st.select(split, target, (F.col("c") / F.sum("c").over(w_split)).alias("sr"),
                   (F.sum("c").over(w_tgt) / F.sum("c").over(w_all)).alias("gr"))
    points = F.max(F.abs(F.col("sr") - F.col("gr"))) * 100  # a gate compares the raw value (digits=None)
    drift = st.agg((points if digits is None else F.round(points, digits)).alias("max_drift_points"),
                   F.lit(0).alias("_g"))
    return groups.join(drift, "_g").drop("_g")

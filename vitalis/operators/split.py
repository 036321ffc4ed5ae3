"""``win_quota_split``: stratified, group-safe, deterministic 20-fold split.

Contract kept from the survey pipeline: whole text groups stay in one fold,
classes are stratified, folds 0-13 train, 14-16 validation, 17-19 test.

Distributed form (no single-partition window anywhere):

1. group rows by ``text_hash`` -> (stratum, n); a hot text is one row here;
2. order groups inside a stratum by ``h = sha2(seed:text_hash)``;
3. count rows per (stratum, bucket) where bucket = first 4 hex digits of
   ``h`` -- at most 3 x 65,536 rows whatever the data size, so its prefix
   sum is a tiny job and the table is safe to broadcast;
4. running sum inside each (stratum, bucket) ordered by ``h, text_hash``
   plus the bucket offset gives the rows before each group;
5. ``fold = floor(20 * rows_before / rows_in_stratum)``;
6. join the fold back to rows on ``text_hash`` (AQE splits a skewed key).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitalis import schemas as S

BUCKET_HEX_DIGITS = 4  # 65,536 buckets per stratum: bounded side table


def group_folds(df: DataFrame, group_col: str = "text_hash", strat_col: str = "target",
                seed: int = S.SPLIT_SEED, n_folds: int = S.N_FOLDS) -> DataFrame:
    """One row per group: (group, stratum, n, fold). A group whose rows carry
    several strata is stratified under the smallest one (the gate reports
    it); it still lands in one fold."""
    # Stratum as an int ordinal (alphabetical, so min = string min) keeps
    # the aggregate buffer fixed-width: hash aggregate, not sort aggregate.
    strata = F.array(*[F.lit(t) for t in sorted(S.TARGET_ORDER)])
    # Stratum and bucket are made non-nullable: otherwise the join below
    # infers IS NOT NULL filters that Catalyst pushes under the group-by
    # into the scan, the two uses of ``groups`` stop being identical and the
    # whole-table aggregate runs twice instead of reusing one exchange.
    groups = (df.groupBy(group_col)
                .agg(F.coalesce(F.min(F.array_position(strata, F.col(strat_col))), F.lit(0)).alias("_stratum"),
                     F.count(F.lit(1)).alias("_n")))
    # A group in bytes counts as its hexadecimal digits, which sort alike.
    name = F.lower(F.hex(group_col)) if dict(df.dtypes)[group_col] == "binary" else F.col(group_col)
    h = F.sha2(F.concat_ws(":", F.lit(str(seed)), name), 256)
    groups = groups.withColumn("_bucket", F.coalesce(F.conv(F.substring(h, 1, BUCKET_HEX_DIGITS), 16, 10).cast("int"), F.lit(0)))

    # Small table: rows per (stratum, bucket) and their prefix offsets.
    per_bucket = groups.groupBy("_stratum", "_bucket").agg(F.sum("_n").alias("_bn"))
    w_prefix = (Window.partitionBy("_stratum").orderBy("_bucket")
                .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    offsets = per_bucket.select(
        "_stratum", "_bucket",
        (F.sum("_bn").over(w_prefix) - F.col("_bn")).alias("_offset"),
        F.sum("_bn").over(Window.partitionBy("_stratum")).alias("_total"))

    w_in = (Window.partitionBy("_stratum", "_bucket").orderBy("_h", group_col)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # Groups move to their bucket without the hash, which is reckoned again there.
    placed = groups.repartition("_stratum", "_bucket").withColumn("_h", h)
    ranked = placed.select(group_col, "_stratum", "_n", "_bucket", (F.sum("_n").over(w_in) - F.col("_n")).alias("_before_in"))
    j = ranked.join(F.broadcast(offsets), ["_stratum", "_bucket"])
    fold = F.floor(F.lit(n_folds) * (F.col("_offset") + F.col("_before_in")) / F.col("_total")).cast("int")
    # Stratum 0 (no known class in the group) keeps a NULL stratum name.
    stratum = F.when(F.col("_stratum") > 0, F.element_at(strata, F.col("_stratum").cast("int")))
    return j.select(group_col, stratum.alias("stratum"),
                    F.col("_n").alias("n"), fold.alias("fold"))


def split_name(fold_col: str = "fold"):
    """Fold id -> split name (fixed 14/3/3 layout)."""
    arr = F.array(*[F.lit(s) for s in S.SPLIT_BY_FOLD])
    return F.element_at(arr, F.col(fold_col) + 1)


def assign_splits(df: DataFrame, group_col: str = "text_hash", strat_col: str = "target") -> DataFrame:
    """Attach ``split`` to every row of ``df``."""
    folds = group_folds(df, group_col, strat_col).select(group_col, split_name().alias("split"))
    return df.join(folds, group_col, "left")

"""Data-quality gates as aggregate queries (inventory 2.8).

Each gate set is one aggregate pass producing booleans, reshaped to
``(check, passed)`` rows with ``stack``; :func:`enforce` raises listing all
failed checks together (the only driver-side step, on a bounded result).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalis import schemas as S
from vitalis.functions import text as X
from vitalis.operators.score import strip_text


def checks_long(row: DataFrame, names: list[str]) -> DataFrame:
    """One row of boolean columns -> (check, passed)."""
    args = ", ".join(f"'{n}', `{n}`" for n in names)
    return row.selectExpr(f"stack({len(names)}, {args}) AS (check, passed)")


def enforce(checks: DataFrame) -> None:
    """Raise with every failed check named; reads a bounded result."""
    failed = [r["check"] for r in checks.where(~F.col("passed")).select("check").collect()]
    if failed:
        raise ValueError("; ".join(sorted(failed)))


def _exactly(col: str, values: Iterable[str], name: str) -> list[Column]:
    """One aggregate: every known value occurs and no other does. It holds one
    flag per known value, however many values a dirty column has."""
    values = list(values)
    seen = F.lit(True)
    for v in values:
        seen = seen & F.bool_or(F.col(col) == v)
    return [(seen & F.bool_and(F.col(col).isin(values))).alias(name)]


def training_contract(df: DataFrame, version: str = S.DATASET_VERSION) -> DataFrame:
    """``dq_training_contract``: the 11 checks of the training table. The
    row-level checks are one aggregate; the two group checks are one
    grouped pass on ``text_hash`` rolled into the same row."""
    schema_ok = tuple(df.columns) == S.TRAINING_COLUMNS
    any_null = F.lit(False)
    for c in df.columns:
        any_null = any_null | F.col(c).isNull()
    row = df.agg(
        (F.count(F.lit(1)) > 0).alias("not_empty"),
        (~F.bool_or(any_null)).alias("no_nulls"),
        (F.count(F.lit(1)) == F.countDistinct("record_id")).alias("record_id_unique"),
        *_exactly("target", S.TARGET_ORDER, "classes_valid"), *_exactly("split", S.SPLIT_NAMES, "splits_valid"),
        F.bool_and(F.col("dataset_version") == version).alias("version_ok"),
        F.bool_and(F.coalesce(strip_text("clinical_text") != "", F.lit(False))).alias("text_not_blank"),
        F.bool_and(F.col("text_hash") == X.text_hash("clinical_text")).alias("text_hash_valid"),
        F.lit(0).alias("_g"))
    # "At most one distinct value per group" is min = max (both skip
    # NULL, like a distinct count): one hash aggregate with map-side
    # partial results, no Expand doubling the rows for two distinct counts.
    def varies(c: str) -> Column:
        return F.coalesce(F.max(c) != F.min(c), F.lit(False))
    grp = (df.groupBy("text_hash").agg(varies("split").alias("ns"), varies("target").alias("nt"))
             .agg(F.coalesce(F.bool_or("ns"), F.lit(False)).alias("_ms"),
                  F.coalesce(F.bool_or("nt"), F.lit(False)).alias("_mt"), F.lit(0).alias("_g")))
    j = row.join(grp, "_g")
    out = j.select(
        F.lit(schema_ok).alias("schema_valid"), "not_empty", F.coalesce("no_nulls", F.lit(True)).alias("no_nulls"),
        "record_id_unique",
        F.coalesce("classes_valid", F.lit(False)).alias("classes_valid"),
        F.coalesce("splits_valid", F.lit(False)).alias("splits_valid"),
        F.coalesce("version_ok", F.lit(False)).alias("version_valid"),
        F.coalesce("text_not_blank", F.lit(False)).alias("text_not_blank"),
        F.coalesce("text_hash_valid", F.lit(False)).alias("text_hash_valid"),
        (~F.col("_ms")).alias("text_in_one_split"),
        (~F.col("_mt")).alias("text_one_target"))
    return checks_long(out, out.columns)


def expected_counts(df: DataFrame, rows: int | None = None, classes: Mapping[str, int] | None = None,
                    splits: Mapping[str, int] | None = None, unique_texts: int | None = None) -> DataFrame:
    """``dq_expected_counts``: observed counts vs optional expectations,
    as (check, key, observed, expected, passed) rows."""
    spark = df.sparkSession
    # Rows, class and split counts come from one (class, split) table;
    # distinct texts need their own grouped pass.
    cells = df.groupBy("target", "split").agg(F.count(F.lit(1)).alias("n"))
    texts = df.agg(F.countDistinct("text_hash").alias("observed"))
    parts = [cells.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("observed")).select(
                 F.lit("rows").alias("check"), F.lit("").alias("key"), "observed"),
             texts.select(F.lit("unique_texts").alias("check"), F.lit("").alias("key"), "observed"),
             cells.groupBy("target").agg(F.sum("n").alias("observed")).select(
                 F.lit("class").alias("check"), F.col("target").alias("key"), "observed"),
             cells.groupBy("split").agg(F.sum("n").alias("observed")).select(
                 F.lit("split").alias("check"), F.col("split").alias("key"), "observed")]
    o = parts[0]
    for p in parts[1:]:
        o = o.unionByName(p)
    exp = [("rows", "", rows), ("unique_texts", "", unique_texts)]
    exp += [("class", k, v) for k, v in (classes or {}).items()]
    exp += [("split", k, v) for k, v in (splits or {}).items()]
    e = spark.createDataFrame(exp, "check string, key string, expected long")
    j = o.join(F.broadcast(e), ["check", "key"], "full_outer")
    return j.select("check", "key", "observed", "expected",
                    (F.col("expected").isNull() | F.col("observed").eqNullSafe(F.col("expected"))).alias("passed"))


def content_checksum(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """One row ``value``: the sum over all rows of 28 bits of the MD5 of the
    columns, so it depends on the content but not on order or files."""
    row = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    bits = F.conv(F.substring(F.md5(row), 1, 7), 16, 10).cast("long")
    return df.agg(F.coalesce(F.sum(bits), F.lit(0)).cast("string").alias("value"))


def metadata_table(df: DataFrame, version: str = S.DATASET_VERSION, seed: int = S.SPLIT_SEED,
                   checksum: DataFrame | None = None) -> DataFrame:
    """``sink_metadata``: provenance key/value rows; class and split counts
    as key-sorted JSON built from the tiny grouped results; ``checksum`` is
    the source's :func:`content_checksum`."""
    # One pass: the (class, split) cell counts feed the row count and both
    # count maps (the three consumers reuse its exchange).
    cells = df.groupBy("target", "split").agg(F.count(F.lit(1)).alias("count"))

    def counts_json(col: str) -> DataFrame:
        g = cells.groupBy(col).agg(F.sum("count").alias("count"))
        entry = F.concat(F.lit('"'), F.col(col), F.lit('": '), F.col("count").cast("string"))
        return g.agg(F.concat(F.lit("{"), F.array_join(F.array_sort(F.collect_list(entry)), ", "), F.lit("}"))
                     .alias("value"))
    spark = df.sparkSession
    fixed = spark.createDataFrame(
        [("dataset_version", version),
         ("split_strategy", "stratified group quota split: 70/15/15 by text_hash"),
         ("random_state", str(seed))], "key string, value string")
    rc = cells.agg(F.coalesce(F.sum("count"), F.lit(0)).cast("string").alias("value")).select(
        F.lit("row_count").alias("key"), "value")
    cc = counts_json("target").select(F.lit("class_counts").alias("key"), "value")
    sc = counts_json("split").select(F.lit("split_counts").alias("key"), "value")
    out = fixed.unionByName(rc).unionByName(cc).unionByName(sc)
    return out if checksum is None else out.unionByName(checksum.select(F.lit("source_checksum").alias("key"), "value"))


def allowed_features(df: DataFrame, allowed: Iterable[str], blocked: Iterable[str]) -> DataFrame:
    """``flt_allowed_features``: allow- and block-lists must not overlap and
    every allowed column must exist (schema-only, no job)."""
    allowed, blocked = list(allowed), list(blocked)
    overlap = sorted(set(allowed) & set(blocked))
    missing = sorted(set(allowed) - set(df.columns))
    rows = [("no_overlap", not overlap, ",".join(overlap)),
            ("allowed_present", not missing, ",".join(missing)),
            ("blocked_excluded", True, ",".join(sorted(set(blocked) & set(df.columns))))]
    return df.sparkSession.createDataFrame(rows, "check string, passed boolean, detail string")


def model_gate(metrics: DataFrame, min_f1: float = S.GATE_MIN_F1_MACRO,
               min_urgent_recall: float = S.GATE_MIN_URGENT_RECALL) -> DataFrame:
    """``dq_model_gate``: F1 macro and urgent recall floors on a one-row
    metrics table with ``f1_macro`` and ``urgent_recall``."""
    out = metrics.select((F.col("f1_macro") >= min_f1).alias("f1_macro"),
                         (F.col("urgent_recall") >= min_urgent_recall).alias("urgent_recall"))
    return checks_long(out, out.columns)


def status(c: str | Column) -> Column:
    return X.status(c)

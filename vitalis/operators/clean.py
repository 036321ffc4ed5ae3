"""Filters, projections and code-book decoding (inventory 2.2, 2.3).

Two invalid-value policies exist: the training build *raises* (fail-fast
inside the same job via ``raise_error``), the EDA cohort *nulls* and counts.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalis import schemas as S
from vitalis.functions import nulls as N
from vitalis.functions import text as X


def require_columns(df: DataFrame, required: Iterable[str]) -> None:
    """``prj_required_columns``: metadata-only check, sorted missing list."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"required columns missing: {missing}")


def target_expr(code: str | Column = "IMMEDR") -> Column:
    """``prj_target_map``: immediacy code -> class (NULL when ineligible)."""
    c = F.col(code) if isinstance(code, str) else code
    expr = None
    for k, v in S.TARGET_MAP.items():
        expr = F.when(c == k, F.lit(v)) if expr is None else expr.when(c == k, F.lit(v))
    return expr


def eligible(df: DataFrame, code: str = "IMMEDR") -> DataFrame:
    """``flt_eligible``: keep rows with a mapped triage code (pushed to the
    scan as an ``IN`` filter)."""
    return df.where(F.col(code).isin(list(S.TARGET_MAP)))


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """``df``, or an error if it is empty (one row is looked for)."""
    if df.limit(1).count() == 0:
        raise ValueError(f"no {what}")
    return df


def target_ordinal(c: str | Column = "target") -> Column:
    """``prj_category_order``: ordinal of the ordered class (1-based)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.array_position(F.array(*[F.lit(t) for t in S.TARGET_ORDER]), col)


def require_unique_codes(codebook: DataFrame) -> None:
    """A code book with a repeated code would multiply the rows that use it:
    it is refused, whatever its size (a few of the codes are named)."""
    twice = codebook.groupBy("code").count().where("count > 1").orderBy("code").limit(5).collect()
    if twice:
        raise ValueError(f"repeated codes in a code book: {[r['code'] for r in twice]}")


def decode(df: DataFrame, codebook: DataFrame, code_col: str, out_col: str,
           positive_only: bool = True) -> DataFrame:
    """``prj_code_label`` / ``join_small_dim``: left lookup, NULL when
    unmapped. A code book whose size is proven under
    :data:`BROADCAST_MAX_ROWS` is broadcast explicitly: in-memory or
    derived dimensions carry no size statistics, and a shuffle join on a
    low-cardinality code (two sex codes) would put every fact row into as
    many tasks as there are codes. Larger code books take a shuffle join."""
    from vitalis.session import BROADCAST_MAX_ROWS, small_enough

    cb = codebook.select(F.col("code").alias("_code"), F.col("label").alias(out_col))
    if positive_only:
        cb = cb.where(F.col("_code") > 0)
    require_unique_codes(cb.withColumnRenamed("_code", "code"))
    if small_enough(cb, BROADCAST_MAX_ROWS):
        cb = F.broadcast(cb)
    return df.join(cb, df[code_col] == cb["_code"], "left").drop("_code")


def decode_complaints(df: DataFrame, codebook: DataFrame, cols: Sequence[str] = S.RFV_COLUMNS) -> DataFrame:
    """``join_codebook_multi``: decode all complaint slots against one code
    book. Repeated codes are refused. A small code book (its size is checked)
    is broadcast, one left lookup per slot; with a larger one only the codes are
    shuffled to their labels, not the rows once per slot."""
    from vitalis.session import BROADCAST_MAX_ROWS, small_enough

    cb = codebook.where(F.col("code") > 0).select(F.col("code").cast("bigint").alias("code"), "label")
    require_unique_codes(cb)
    if small_enough(cb, BROADCAST_MAX_ROWS):
        return decode_complaints_wide(df, cb, cols, broadcast=True)
    return decode_complaints_long(df, cb, cols)


def decode_complaints_long(df: DataFrame, codebook: DataFrame, cols: Sequence[str] = S.RFV_COLUMNS) -> DataFrame:
    """Codes move with a hash of their row, find their labels and come back as
    one map a row; the rows are shuffled once, without descriptions. Labels are
    looked up by code, so rows of equal hash (copies, or by chance) share a map
    that holds the codes of each of them."""
    key = F.xxhash64(*[c for c in ("visit_row",) if c in df.columns], *cols)
    codes = F.array_distinct(F.filter(F.array(*[F.col(c).cast("bigint") for c in cols]), lambda c: c > 0))
    long = df.select(key.alias("_key"), F.explode(codes).alias("_code"))
    labels = (long.join(codebook, long["_code"] == codebook["code"]).groupBy("_key")
              .agg(F.map_from_entries(F.collect_set(F.struct("code", "label"))).alias("_labels")))
    out = df.withColumn("_key", key).join(labels, "_key", "left")
    return out.select(*df.columns, *[F.try_element_at("_labels", F.col(c).cast("bigint")).alias(f"{c}_description") for c in cols])


def decode_complaints_wide(df: DataFrame, codebook: DataFrame,
                           cols: Sequence[str] = S.RFV_COLUMNS, broadcast: bool = False) -> DataFrame:
    """One lookup per slot against the same dimension; with ``broadcast``
    (size already proven) every join is a map-side hash join."""
    cb = codebook.where(F.col("code") > 0)
    out = df
    for c in cols:
        side = cb.select(F.col("code").alias(f"_k_{c}"), F.col("label").alias(f"{c}_description"))
        if broadcast:
            side = F.broadcast(side)
        out = out.join(side, out[c] == side[f"_k_{c}"], "left").drop(f"_k_{c}")
    return out


def clean_vitals(df: DataFrame, policy: str = "raise") -> DataFrame:
    """Sentinels -> NULL, domain check, scale (``prj_sentinel_null``,
    ``flt_domain_violation``, ``prj_domain_null``, ``prj_scale``).

    ``policy='raise'``: a usable value outside its domain aborts the job.
    ``policy='null'``: it becomes NULL."""
    cols = []
    for r in S.VITAL_RULES:
        src = F.col(r.source)
        usable = N.is_usable(src, r.sentinels)
        if policy == "raise":
            val = N.fail_if(usable & ~src.between(r.lower, r.upper),
                            f"values outside the domain in {r.source}",
                            F.when(usable, src))
        elif policy == "null":
            val = F.when(usable & N.in_domain(src, r.lower, r.upper), src)
        else:
            raise ValueError("policy must be 'raise' or 'null'")
        cols.append((val / F.lit(float(r.scale))).alias(r.clean))
    return df.select("*", *cols)


def outcome_flags(df: DataFrame) -> DataFrame:
    """``prj_outcome_flags``: admission, critical care, death in the ED."""
    return df.select(
        "*",
        (F.coalesce(F.col("ADMITHOS") == 1, F.lit(False))
         | F.coalesce(F.col("OBSHOS") == 1, F.lit(False))).alias("hospital_admission"),
        F.coalesce(F.col("ADMIT") == 1, F.lit(False)).alias("critical_care_admission"),
        F.coalesce(F.col("DIEDED") == 1, F.lit(False)).alias("died_in_ed"),
    )


def eda_cohort(visits: DataFrame, rfv_codebook: DataFrame, sex_codebook: DataFrame,
               diag_ref: DataFrame) -> DataFrame:
    """Eligible visits decoded and cleaned with the null policy, plus the
    normalised primary diagnosis and its description: the table the
    analytic queries run on (``sink_eda_artifact`` writes it)."""
    from vitalis.session import small_enough

    v = eligible(visits).withColumn("target", target_expr())
    v = decode(v, sex_codebook, "SEX", "sex_label", positive_only=False)
    v = decode_complaints(v, rfv_codebook)
    v = clean_vitals(v, policy="null")
    v = v.withColumn("DIAG1_code", X.diag_normalize("DIAG1"))
    # Few codes name many visits: shuffling the visits on the code would gather
    # them in a few tasks, so a small reference (its size is checked) is broadcast.
    dr = diag_ref.select(F.col("code").alias("_dcode"), F.col("description").alias("DIAG1_description"))
    dr = F.broadcast(dr) if small_enough(dr) else dr
    v = v.join(dr, v["DIAG1_code"] == dr["_dcode"], "left").drop("_dcode")
    return v


EDA_COLUMNS = (
    "visit_row", "IMMEDR", "target", "AGE", "AGEDAYS", "SEX", "sex_label",
    *S.RFV_COLUMNS, *[f"{c}_description" for c in S.RFV_COLUMNS],
    "DIAG1_code", "DIAG1_description",
    *[r.clean for r in S.VITAL_RULES],
    "ADMITHOS", "OBSHOS", "ADMIT", "DIEDED",
)


def eda_table(visits: DataFrame, rfv_codebook: DataFrame, sex_codebook: DataFrame,
              diag_ref: DataFrame) -> DataFrame:
    """``sink_eda_artifact`` / ``prj_column_contract``: fixed column order
    plus the EDA clinical text."""
    v = eda_cohort(visits, rfv_codebook, sex_codebook, diag_ref)
    return v.select(*EDA_COLUMNS, X.clinical_text(eda=True).alias("clinical_text"))

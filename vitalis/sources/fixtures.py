"""Derived source views over the driver tables.

``visits`` stands in for the coded survey (one row per order), the code
books come from ``part`` / ``customer``, ``scored`` / ``scored_mc`` are
prediction tables and ``requests`` is the request/prediction event stream.
All are lazy DataFrames derived by Spark from the given tables, so their
size grows with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalis.sources.tables import table


def _i(c: Column) -> Column:
    return c.cast("int")


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coded survey rows. Complaint codes RFV1..RFV5 are the smallest part
    key (+20000) of line numbers 1..5 of each order, computed in a single
    aggregate instead of aggregate-then-pivot."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    # One hash aggregate with a conditional min per line number (a fixed
    # list): one shuffle on l_orderkey, no pivot-first phase.
    rfv = (li.where(F.col("l_linenumber").between(1, 5))
             .groupBy("l_orderkey")
             .agg(*[(F.min(F.when(F.col("l_linenumber") == k, F.col("l_partkey"))) + F.lit(20000)).alias(f"r{k}")
                    for k in range(1, 6)]))
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    j = (orders.join(rfv, orders.o_orderkey == rfv.l_orderkey, "left")
               .join(cust, orders.o_custkey == cust.c_custkey, "left"))
    ok, ck, tp = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_totalprice")

    def code_or(mod_cases, default):
        expr = None
        for m, v in mod_cases:
            cond = (ok % m) == 0
            expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
        return expr.otherwise(default)

    return j.select(
        ok.alias("visit_row"),
        code_or([(11, -9), (23, 0)], _i(F.substring("o_orderpriority", 1, 1))).alias("IMMEDR"),
        _i(ck % 94).alias("AGE"),
        F.when(ck % 94 == 0, _i(ok % 366)).otherwise(F.lit(-7)).alias("AGEDAYS"),
        _i(1 + ck % 2).alias("SEX"),
        *[F.coalesce(F.col(f"r{k}"), F.lit(-9).cast("bigint")).alias(f"RFV{k}") for k in range(1, 6)],
        code_or([(13, -9)], _i(950 + ok % 100)).alias("TEMPF"),
        code_or([(17, 998), (19, -9)], _i(50 + ok % 121)).alias("PULSE"),
        code_or([(29, -9)], _i(10 + ok % 30)).alias("RESPR"),
        code_or([(31, -9)], _i(90 + ck % 90)).alias("BPSYS"),
        code_or([(7, 998)], _i(50 + ck % 60)).alias("BPDIAS"),
        code_or([(37, -9)], _i(85 + ok % 16)).alias("POPCT"),
        code_or([(5, -9), (41, -8)], _i(ok % 11)).alias("PAINSCALE"),
        F.when(ok % 43 == 0, F.lit("-9")).otherwise(
            F.concat(F.substring("c_mktsegment", 1, 3), F.lit("."),
                     (ok % 7).cast("string"), F.lit("-"))).alias("DIAG1"),
        F.when(tp > 300000, 1).otherwise(0).alias("ADMITHOS"),
        F.when(tp.between(250000, 260000), 1).otherwise(0).alias("OBSHOS"),
        F.when(tp > 400000, 1).otherwise(2).alias("ADMIT"),
        F.when(ok % 997 == 0, 1).otherwise(0).alias("DIEDED"),
    )


def rfv_codebook(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complaint code book ``(code, label)``; grows with ``part``."""
    return table(spark, sf_dir, "part").select(
        (F.col("p_partkey") + 20000).alias("code"), F.col("p_name").alias("label"))


def sex_codebook(spark: SparkSession) -> DataFrame:
    # FIXED VALUES: sex code book of the survey.
    return spark.createDataFrame([(1, "Female"), (2, "Male")], "code int, label string")


def diag_ref(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Diagnosis reference: ``(code, description)`` per market segment and
    type 0..5 (type 6 is absent on purpose). Distinct keeps it small."""
    seg = table(spark, sf_dir, "customer").select("c_mktsegment").distinct()
    # Segments are few, so the exploded dimension stays small.
    k = F.explode(F.array(*[F.lit(i) for i in range(6)])).alias("k")
    return (seg.select("c_mktsegment", k)
               .select(F.concat(F.substring("c_mktsegment", 1, 3), F.col("k").cast("string")).alias("code"),
                       F.concat(F.col("c_mktsegment"), F.lit(" type "), F.col("k").cast("string")).alias("description"))
               .distinct())


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binary predictions: truth = ``labels.quality``; every fifth doc flipped."""
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality")
    j = d.join(lab, "doc_id")
    return j.select(
        "doc_id", F.col("quality").alias("y_true"),
        F.when(F.col("doc_id") % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")).alias("y_pred"),
        F.round(0.6 * F.col("quality") + (F.col("n_chars") % 100) / 200.0, 6).alias("score"))


def scored_mc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten-class predictions over ``embeddings``: every fourth row shifted."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "label")
    return e.select(
        "vec_id", F.col("label").alias("y_true"),
        F.when(F.col("vec_id") % 4 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("y_pred"))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request/prediction events derived from ``events``. ``ts`` stays a
    ``timestamp_ntz`` (wall clock, zone-free) for batch queries; the
    streaming form casts it to ``timestamp`` for watermarks."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    return ev.select(
        "event_id",
        "ts",
        F.col("event_type").alias("handler"),
        F.when(F.col("event_type") == "error", 500)
         .when(F.col("event_id") % 10 == 0, 422).otherwise(200).alias("status"),
        (F.col("value") / 100.0).alias("duration_s"),
        F.when(F.col("value") > 150, 1.0).otherwise(0.25 + F.col("value") / 200.0).alias("confidence"),
        F.when(F.col("event_id") % 3 == 0, "v2").otherwise("v1").alias("model_version"),
    )

"""Flagship: coded visits -> the six-column training table.

Plan: eligibility filter (pushed to the scan) -> sex and complaint code
books (left joins; AQE broadcasts them when small) -> vitals cleaned with
fail-fast domain checks -> one projection building the templated text,
hashes and ids (codegen, Arrow UDF only for non-ASCII rows) -> two-phase
quota split -> fixed column contract. Shuffles: the complaint join and
re-pivot on ``visit_row``, the split's group-by and join on ``text_hash``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalis import schemas as S
from vitalis.functions import nulls as N
from vitalis.functions import text as X
from vitalis.operators import clean as C
from vitalis.operators import gates as G
from vitalis.operators.split import assign_splits
from vitalis.session import discard, materialize, scratch
from vitalis.sources import fixtures as FX
from vitalis.sources.files import files_signature


def decoded_visits(visits: DataFrame, rfv_codebook: DataFrame, sex_codebook: DataFrame) -> DataFrame:
    """Eligible, labelled, decoded and cleaned visits (raise policy)."""
    C.require_columns(visits, ("visit_row", *S.SOURCE_COLUMNS))
    v = C.eligible(visits.select("visit_row", *S.SOURCE_COLUMNS))
    v = v.withColumn("target", C.target_expr())
    v = C.decode(v, sex_codebook, "SEX", "sex_label", positive_only=False)
    v = v.withColumn("sex_label", N.fail_if(F.col("sex_label").isNull(),
                                            "sex codes without a label", F.col("sex_label")))
    v = C.decode_complaints(v, rfv_codebook)
    for c in S.RFV_COLUMNS:
        d = f"{c}_description"
        v = v.withColumn(d, N.fail_if((F.col(c) > 0) & F.col(d).isNull(),
                                      f"{c} codes without a description", F.col(d)))
    v = C.clean_vitals(v, policy="raise")
    has_any = N.any_not_null([f"{c}_description" for c in S.RFV_COLUMNS]
                             + [r.clean for r in S.VITAL_RULES])
    return v.withColumn("target", N.fail_if(~has_any, "visit without complaint or observation",
                                            F.col("target")))


def training_rows(decoded: DataFrame, version: str = S.DATASET_VERSION) -> DataFrame:
    """Text, id and hash per visit, before the split."""
    raw = decoded.select("visit_row", "target", X.clinical_text(eda=False).alias("_raw"))
    text, hashed = X.normalize_with_hash("_raw")
    return raw.select(
        X.record_id("visit_row", version).alias("record_id"),
        text.alias("clinical_text"),
        "target",
        hashed.alias("text_hash"),
        F.lit(version).alias("dataset_version"))


def build_training_table(visits: DataFrame, rfv_codebook: DataFrame, sex_codebook: DataFrame,
                         version: str = S.DATASET_VERSION, materialize_rows: bool = True) -> DataFrame:
    """The split reads the rows twice (group sizes, then the join back), so
    the rows are written once to the checkpoint folder first: the decode,
    template and UDF run exactly once and the lineage is cut. The finished
    table is written too, partitioned by ``split``: every gate, report and
    fit reads it again, and a split filter then prunes whole folders
    instead of recomputing the split. Ids and hashes, which don't compress, are
    bytes until then, half as long as their digits. ``materialize_rows=False`` keeps the
    whole build lazy (fail-fast checks surface at the first action)."""
    rows = training_rows(decoded_visits(visits, rfv_codebook, sex_codebook), version)
    if not materialize_rows:
        return assign_splits(rows).select(*S.TRAINING_COLUMNS)
    spark = rows.sparkSession
    draft = scratch(spark, "training-rows")
    digests = ("record_id", "text_hash")  # 64 lower-case digits or null
    rows.withColumns({c: F.unhex(c) for c in digests}).write.parquet(draft)
    split = assign_splits(spark.read.parquet(draft)).withColumns({c: F.lower(F.hex(c)) for c in digests})
    table = materialize(split.select(*S.TRAINING_COLUMNS), "training-table", partition_by=("split",))
    discard(spark, draft)
    return table.select(*S.TRAINING_COLUMNS)


#: Checks of the training contract that stop a build. Equal texts with different
#: targets are a property of the source: the gate query reports them.
ENFORCED = ("schema_valid", "not_empty", "no_nulls", "record_id_unique", "version_valid", "text_not_blank",
            "text_hash_valid", "text_in_one_split")
_published: dict[tuple, DataFrame] = {}


def source_key(spark: SparkSession, sf_dir: str, version: str = S.DATASET_VERSION) -> tuple:
    """What the training table depends on: this application, the version and
    the input files, by name, length and time, so that a rewritten file of the
    same name counts as new."""
    files = {*FX.visits(spark, sf_dir).inputFiles(), *FX.rfv_codebook(spark, sf_dir).inputFiles()}
    return spark.sparkContext.applicationId, version, files_signature(spark, sorted(files))


def training_table(spark: SparkSession, sf_dir: str, version: str = S.DATASET_VERSION) -> DataFrame:
    """The training table of the tables under ``sf_dir``: built once for an
    application, its input files and a dataset version, and published only if
    the enforced checks of the contract hold; every gate, report and fit reads
    what was published."""
    key = source_key(spark, sf_dir, version)
    if key not in _published:
        table = build_training_table(FX.visits(spark, sf_dir), FX.rfv_codebook(spark, sf_dir), FX.sex_codebook(spark), version)
        G.enforce(G.training_contract(table, version).where(F.col("check").isin(*ENFORCED)))
        _published[key] = table
    return _published[key]

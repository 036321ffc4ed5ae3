"""Table scans, loaders and table sinks (inventory 2.1)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


# Tables whose rows feed CPU-heavy per-row work (templated text, regexes,
# tokenisers, hashes), with their unique key.
SPREAD_KEYS = {"orders": "o_orderkey", "documents": "doc_id"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one driver table; Catalyst prunes columns and pushes
    filters into the scan (through :func:`spread` too), so callers just
    ``select``/``where``."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df, SPREAD_KEYS[name]) if name in SPREAD_KEYS else df


def spread(df: DataFrame, key: str) -> DataFrame:
    """Spread a scan that yields at most half as many partitions as the session
    has task slots (a small table landed as one file or row group: one task would
    run all the per-row work) over every slot by a hash of its key. A large
    input already has more partitions than slots and passes through with
    no shuffle. Hashing an expression of the key (not the key itself)
    keeps later ``groupBy``/window exchanges, and their reuse, unchanged."""
    slots = df.sparkSession.sparkContext.defaultParallelism
    # Half of the slots busy is no reason to shuffle the texts.
    if slots <= 1 or 2 * df.rdd.getNumPartitions() > slots:
        return df
    return df.repartition(slots, F.xxhash64(key))


def projected_scan(spark: SparkSession, path: str, columns: Iterable[str],
                   schema: T.StructType | None = None) -> DataFrame:
    """Read only the declared columns of a wide source (``src_projected_scan``).
    Missing columns fail before any job runs, listing the sorted names."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(path)
    columns = list(columns)
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"required columns missing: {missing}")
    return df.select(*columns)


def load_csv_tables(spark: SparkSession, base_dir: str,
                    files: Mapping[str, str],
                    options: Mapping[str, str] | None = None,
                    schemas: Mapping[str, T.StructType] | None = None,
                    ) -> dict[str, DataFrame]:
    """``src_csv_tables``: one lazy DataFrame per name. An explicit schema
    avoids the extra inference pass over the file."""
    opts = {"header": "true"}
    opts.update(options or {})
    out = {}
    for name, file_name in files.items():
        reader = spark.read.options(**opts)
        if schemas and name in schemas:
            reader = reader.schema(schemas[name])
        else:
            reader = reader.option("inferSchema", "true")
        out[name] = reader.csv(f"{base_dir.rstrip('/')}/{file_name}")
    return out


def load_table(spark: SparkSession, name: str, columns: Iterable[str] | None = None,
               where: str | None = None) -> DataFrame:
    """``src_table_read``: catalog table with projection and a SQL predicate
    (both reach the scan)."""
    df = spark.table(name)
    if columns:
        df = df.select(*columns)
    if where:
        df = df.where(where)
    return df


def save_table(df: DataFrame, path: str, if_exists: str = "replace",
               max_records_per_file: int = 1_000_000,
               partition_by: Iterable[str] | None = None) -> None:
    """``sink_table_write``: parquet write. ``replace``/``append``/``fail``
    map to Spark save modes; the reference's chunk size becomes
    ``maxRecordsPerFile`` so no file grows without bound."""
    modes = {"replace": "overwrite", "append": "append", "fail": "errorifexists"}
    if if_exists not in modes:
        raise ValueError(f"if_exists must be one of {sorted(modes)}")
    writer = df.write.mode(modes[if_exists]).option(
        "maxRecordsPerFile", max_records_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def readback_check(spark: SparkSession, path: str, expected_rows: int,
                   expected_columns: Iterable[str]) -> DataFrame:
    """``sink_readback_check``: persisted rows and column set against the
    expectation, as one small (check, passed) frame. The count reads only
    parquet footers."""
    back = spark.read.parquet(path)
    rows = back.count()
    same_cols = set(back.columns) == set(expected_columns)
    return spark.createDataFrame(
        [("row_count", rows == expected_rows, str(rows)),
         ("column_set", same_cols, ",".join(sorted(back.columns)))],
        "check string, passed boolean, observed string")


def table_with_metadata(df: DataFrame, comments: Mapping[str, str]) -> DataFrame:
    """Attach variable labels as ``StructField`` metadata (``comment``)."""
    return df.select(*[
        F.col(c).alias(c, metadata={"comment": comments[c]}) if c in comments
        else F.col(c) for c in df.columns])


def column_labels(spark: SparkSession, df: DataFrame) -> DataFrame:
    """``src_column_labels``: schema report with descriptions. Only the
    schema is read (driver metadata, no job)."""
    rows = [(i, f.name, f.dataType.simpleString(), f.metadata.get("comment"))
            for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(
        rows, "position int, column string, dtype string, description string")

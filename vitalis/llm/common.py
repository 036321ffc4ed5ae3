"""Shared pieces of the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitalis.session import checkpoint_dir, discard

#: A word: a run of anything but ASCII white space (space, tab to CR).
WORD = r"[^\x20\x09-\x0D]+"
ASCII_SPACE = " \t\n\x0b\x0c\r"


#: Rows of an Arrow batch where the session keeps Spark's default: whole texts
#: are long, and a batch is held several times outside the executor's heap.
BATCH_ROWS = "500"
_BATCH_KEY, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"


def modest_batches(spark: SparkSession) -> None:
    """Smaller Arrow batches, unless the session has a setting of its own."""
    if spark.conf.get(_BATCH_KEY) == _BATCH_DEFAULT:
        spark.conf.set(_BATCH_KEY, BATCH_ROWS)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Plain Parquet scan of one table."""
    modest_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            *more: Column) -> DataFrame:
    """``doc_id`` (long) and ``text`` (a null becomes the empty text), and
    nothing else of the input, so that no other column can clash."""
    modest_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"), *more)


def remainder(doc_id: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; null for a null id."""
    return F.crc32(doc_id.cast("string")) % mod


def is_held_out(doc_id: Column, mod: int, rest: int) -> Column:
    """Whether the id falls into the held-out fold; a null id does not."""
    return F.coalesce(remainder(doc_id, mod) == rest, F.lit(False))


_CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends there
    and a lost executor costs no recomputation of it. What it shuffled is of
    no use then and is removed, not kept until the driver collects garbage."""
    spark = df.sparkSession
    modest_batches(spark)
    path = f"{checkpoint_dir(spark).rstrip('/')}/vitalis-llm-{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP_KEY, None)
    spark.conf.set(_CLEANUP_KEY, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(_CLEANUP_KEY) if before is None else spark.conf.set(_CLEANUP_KEY, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.table_path = path
    return out


def drop_table(table: DataFrame) -> None:
    """Remove a table of :func:`write_table` that nothing reads any more."""
    discard(table.sparkSession, table.table_path)


def slices(batches: Iterable[pa.RecordBatch], limit: int = 2 << 20,
           column: str = "text") -> Iterator[pa.RecordBatch]:
    """The batches' rows again, in runs of about ``limit`` bytes of ``column``;
    a longer row comes alone, so memory follows the longest row at most."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column))
        ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to


def named(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def bounded_sample(rows: DataFrame, by: str, per_group: int, order: Column,
                   max_groups: int = 500) -> DataFrame:
    """At most ``per_group`` rows of each of the ``max_groups`` most frequent
    values of ``by`` (null is none; ties by value), those first in ``order``,
    a long that is uniform over its range. Counts come from all rows; a
    threshold on ``order`` keeps about three times the number wanted before
    the exact cut, so no group is sorted whole."""
    counts = (rows.where(F.col(by).isNotNull()).groupBy(by).count()
              .orderBy(F.desc("count"), F.asc(by)).limit(max_groups).collect())
    if not counts:
        return rows.where(F.lit(False))
    spread = 2.0 ** 64
    rate = F.lit(0.0)
    for value, n in ((r[0], r[1]) for r in counts):
        rate = F.when(F.col(by) == F.lit(value), F.lit(min(1.0, 3.0 * per_group / n + 50.0 / n))).otherwise(rate)
    w = Window.partitionBy(by).orderBy("__order")
    return (rows.where(F.col(by).isin([r[0] for r in counts]))
            .withColumn("__order", order)
            .where(F.col("__order").cast("double") / spread + 0.5 <= rate)
            .withColumn("__n", F.row_number().over(w))
            .where(F.col("__n") <= per_group).drop("__n", "__order"))

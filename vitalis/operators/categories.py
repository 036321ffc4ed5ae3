"""One-hot codes of columns with any number of categories.

The dictionary of a column (its distinct values in order, numbered from 0) is a
table that no driver sees: values are sorted by range, each range is counted,
and a value's number is its place in its range plus the values of the ranges
before. Rows get their numbers by a join and become sparse vectors.
"""

from __future__ import annotations

from pyspark.ml import Estimator, Model
from pyspark.ml.feature import OneHotEncoder
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitalis.operators.stored import Stored
from vitalis.session import materialize, small_enough

#: monotonically_increasing_id keeps the partition above these bits.
_ROW_BITS = 33


def dictionary(df: DataFrame, col: str) -> DataFrame:
    """``value, id``: the distinct non-null values of ``col`` as text, numbered
    from 0 in order of code points. A frequent value is one row before the
    sort. No values: no rows."""
    values = df.select(F.col(col).cast("string").alias("value")).where("value is not null").distinct()
    # Written with its place, as ranges are sampled anew at each run.
    placed = materialize(values.orderBy("value").withColumn("place", F.monotonically_increasing_id()), "categories")
    placed = placed.select("value", F.shiftright("place", _ROW_BITS).alias("range"),
                           F.col("place").bitwiseAND((1 << _ROW_BITS) - 1).alias("row"))
    # One row per range, so as many as the sort had tasks.
    before = (placed.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
              .select("range", (F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy("range")) - F.col("n")).alias("before")))
    return placed.join(F.broadcast(before), "range").select("value", (F.col("before") + F.col("row")).alias("id"))


class _Columns(Params):
    inputCols = Param(Params._dummy(), "inputCols", "columns to encode", TypeConverters.toListString)
    prefix = Param(Params._dummy(), "prefix", "of the names of the encoded columns", TypeConverters.toString)

    def _defaults(self) -> None:
        self._setDefault(inputCols=[], prefix="cat__")


class SparseOneHot(Estimator, _Columns, Stored):
    """Learns a dictionary per column; the model adds one sparse vector per
    column, ``cat__<col>``, of the dictionary's length with a 1 at the value's
    number. An unknown or null value gives no 1; a column without any value
    gives vectors of length 1 without a 1."""

    def __init__(self, inputCols=(), prefix: str = "cat__"):
        super().__init__()
        self._defaults()
        self._set(inputCols=list(inputCols), prefix=prefix)

    def _fit(self, df: DataFrame) -> "SparseOneHotModel":
        tables = {c: dictionary(df, c) for c in self.getOrDefault("inputCols")}
        return self._copyValues(SparseOneHotModel()._learnt(tables))


class SparseOneHotModel(Model, _Columns, Stored):
    """Dictionaries as tables; small ones are broadcast, others are joined by a
    shuffle, where Spark splits a frequent value's rows."""

    def __init__(self):
        super().__init__()
        self._defaults()

    def _learnt(self, tables: dict[str, DataFrame]) -> "SparseOneHotModel":
        self.dictionaries = tables
        self.sizes = {c: t.count() for c, t in tables.items()}
        self._small = {c: small_enough(t) for c, t in tables.items()}
        return self

    def _transform(self, df: DataFrame) -> DataFrame:
        out = df
        for c in self.getOrDefault("inputCols"):
            n, name = self.sizes[c], f"{self.getOrDefault('prefix')}{c}"
            value, number, at = f"__value_{c}", f"__id_{c}", f"__at_{c}"
            words = self.dictionaries[c].select(F.col("value").alias(value), F.col("id").alias(number))
            joined = out.join(F.broadcast(words) if self._small[c] else words, F.col(c).cast("string") == F.col(value), "left")
            # Known length, so the encoder reads no data; n stands for "no category".
            length = {"ml_attr": {"type": "nominal", "num_vals": max(n, 1)}}
            at_col = F.coalesce(F.col(number), F.lit(max(n, 1))).cast("double").alias(at, metadata=length)
            encoder = OneHotEncoder(inputCols=[at], outputCols=[name], dropLast=True, handleInvalid="keep")
            numbered = joined.select(*out.columns, at_col)
            out = encoder.fit(numbered).transform(numbered).drop(at)
        return out

    def _tables(self, spark: SparkSession) -> dict[str, DataFrame]:
        return {f"column{k}": self.dictionaries[c] for k, c in enumerate(self.getOrDefault("inputCols"))}

    def _restore(self, tables: dict[str, DataFrame]) -> None:
        self._learnt({c: tables[f"column{k}"] for k, c in enumerate(self.getOrDefault("inputCols"))})

"""Python estimators and models that can be saved inside a pipeline.

A stage's params are saved as Spark saves them; whatever else it learnt is a
set of tables, saved as Parquet beside them.
"""

from __future__ import annotations

from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession


class StoredWriter(MLWriter):
    def __init__(self, stage: "Stored"):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        spark = SparkSession.getActiveSession()
        tables = self.stage._tables(spark)
        DefaultParamsWriter.saveMetadata(self.stage, path, spark, extraMetadata={"tables": sorted(tables)})
        for name, table in tables.items():
            table.write.parquet(f"{path}/tables/{name}")


class StoredReader(MLReader):
    def __init__(self, cls: type):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> "Stored":
        spark = SparkSession.getActiveSession()
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        stage = self.cls()
        stage._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(stage, metadata)
        stage._restore({name: spark.read.parquet(f"{path}/tables/{name}") for name in metadata["tables"]})
        return stage


class Stored(MLReadable, MLWritable):
    """A stage whose params and tables are saved and loaded."""

    def _tables(self, spark: SparkSession) -> dict[str, DataFrame]:
        return {}

    def _restore(self, tables: dict[str, DataFrame]) -> None:
        pass

    def write(self) -> StoredWriter:
        return StoredWriter(self)

    @classmethod
    def read(cls) -> StoredReader:
        return StoredReader(cls)

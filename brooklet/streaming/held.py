"""Tables that live from one micro-batch to the next, for steps that run in ``foreachBatch``.

Each batch writes a version of its own, so a batch that is replayed starts from the same version and overwrites its
own outcome. A stream that joins or scans such rows uses the batch operators for it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


class Held:
    """Versions of a table under ``folder``; the two latest are kept."""

    def __init__(self, folder: str, schema: T.StructType):
        self.folder, self.schema = folder, schema

    def _path(self, batch_id: int) -> str:
        return f"{self.folder}/batch={batch_id:012d}"

    def _exists(self, spark: SparkSession, batch_id: int):
        path = spark._jvm.org.apache.hadoop.fs.Path(self._path(batch_id))
        return path.getFileSystem(spark._jsc.hadoopConfiguration()), path

    def before(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """The table as the batch before has left it, empty for the first one."""
        store, path = self._exists(spark, batch_id - 1)
        if batch_id == 0 or not store.exists(path):
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(self._path(batch_id - 1))

    def write(self, df: DataFrame, batch_id: int) -> DataFrame:
        spark = df.sparkSession
        df.select(*self.schema.fieldNames()).write.mode("overwrite").parquet(self._path(batch_id))
        store, old = self._exists(spark, batch_id - 2)
        if batch_id > 1 and store.exists(old):
            store.delete(old, True)
        return spark.read.schema(self.schema).parquet(self._path(batch_id))

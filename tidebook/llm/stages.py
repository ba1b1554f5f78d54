"""Tables written between the steps of an operator.

A step that several jobs read, or that a loop builds on, is written to the folder all executors
share and read back. That cuts its lineage, and a lost executor costs a re-read only.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from tidebook.session import shared_folder


class Stages:
    """Tables of one run of an operator, below one folder of the shared folder."""

    def __init__(self, spark: SparkSession, operator: str):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/{operator}-{uuid4().hex}"
        self._count = 0

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` written once and read back with the same schema."""
        self._count += 1
        path = f"{self.folder}/{self._count:03d}-{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *tables: DataFrame) -> None:
        """Remove tables of this run that no later step reads."""
        for df in tables:
            for file in df.inputFiles()[:1]:
                path = self.spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
                if self.folder.split("/")[-1] in path.toString():
                    fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
                    fs.delete(path, True)

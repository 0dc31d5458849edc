"""A lake of named datasets below one root: views, arbitrary SQL, typed empty tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


class Lake:
    """Datasets with declared schemas; one without files reads as zero typed rows."""

    def __init__(self, spark: SparkSession, root: str, schemas: dict[str, str]):
        self.spark, self.root = spark, root.rstrip("/")
        self.schemas = {n: T._parse_datatype_string(s) for n, s in schemas.items()}
        self.refresh()

    def _path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _exists(self, name: str) -> bool:
        jvm, path = self.spark._jvm, self._path(name)
        hadoop = jvm.org.apache.hadoop.fs.Path(path)
        return hadoop.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)

    def table(self, name: str) -> DataFrame:
        """The declared columns by name over all files; absent ones null; unreadable files skipped."""
        if not self._exists(name):
            return self.spark.createDataFrame([], self.schemas[name])
        return self.spark.read.schema(self.schemas[name]).option("recursiveFileLookup", True).option("ignoreCorruptFiles", True).parquet(self._path(name))

    def refresh(self) -> None:
        """Register every dataset as a view again, after files changed."""
        for name in self.schemas:
            self.table(name).createOrReplaceTempView(name)

    def sql(self, query: str, args: list | dict | None = None) -> DataFrame:
        return self.spark.sql(query, args=args)

    def arrow(self, query: str, args: list | dict | None = None):
        return self.sql(query, args).toArrow()

    def columns_on_disk(self, name: str) -> list[str]:
        return self.spark.read.option("mergeSchema", True).option("recursiveFileLookup", True).option("ignoreCorruptFiles", True).parquet(self._path(name)).columns

    def counts(self) -> DataFrame:
        """Rows per dataset."""
        parts = [self.table(n).agg(F.count("*").alias("n")).select(F.lit(n).alias("dataset"), "n") for n in self.schemas]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionAll(p)
        return out

    def files(self, name: str) -> DataFrame:
        """Files of a dataset with their bytes; contents are not read."""
        return self.spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(self._path(name)).select("path", "length", "modificationTime")

    def export(self, query: str, path: str) -> None:
        """A query's result as CSV or Parquet, by the path's ending."""
        df = self.sql(query)
        if path.endswith(".csv"):
            df.write.mode("overwrite").option("header", True).csv(path)
        else:
            df.write.mode("overwrite").parquet(path)

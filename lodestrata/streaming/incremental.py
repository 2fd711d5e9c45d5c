"""Incremental loads with Structured Streaming: new files are picked up once, and rows already loaded are left out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def new_rows(spark: SparkSession, source: str, schema: StructType | str, max_files: int | None = None) -> DataFrame:
    """A stream of the rows of Parquet files as they appear under a path."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).parquet(source)


def load(stream: DataFrame, key: str, target: str, checkpoint: str) -> StreamingQuery:
    """Append rows whose key the target doesn't have, once each; runs until the source has nothing new.

    A batch that is tried again after a failure finds its own rows in the target and adds nothing twice.
    """

    def append(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        rows = batch.dropDuplicates([key])
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(target)
        if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            rows = rows.join(spark.read.schema(batch.schema).parquet(target).select(key), key, "left_anti")
        rows.select(*batch.columns).write.mode("append").parquet(target)

    return stream.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def counts(stream: DataFrame, at: str, late: str, *by: str) -> DataFrame:
    """Rows by time window of ``late`` and ``by``, with rows later than that left out."""
    from pyspark.sql import functions as F

    return stream.withWatermark(at, late).groupBy(F.window(at, late), *by).agg(F.count("*").alias("n"))

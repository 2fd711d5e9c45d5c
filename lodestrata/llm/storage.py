"""Lineage cuts in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.folders import new_path, shared_folder

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to a new path in the shared folder and read again; what was shuffled for it is let go."""
    spark: SparkSession = df.sparkSession
    path = new_path(spark)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed and stored under spark.checkpoint.dir, so that a lost executor costs a read, not a recompute."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def let_go(*tables: DataFrame) -> None:
    """Delete the files of what ``stored`` has made: only for tables that nothing still to be computed reads."""
    for df in tables:
        jvm, files = df.sparkSession._jvm, df.inputFiles()
        if files:
            folder = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(files[0])).getParent()
            folder.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)

"""Run what has not run yet: scripts found in directories, less those in a ledger, in order, each noted after it succeeds."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

# Fixed value: the file names that count as scripts.
SCRIPT = r"^\d+.*\.(js|ts)$"


def scripts(spark: SparkSession, *directories: str) -> DataFrame:
    """(name, path): the scripts in some directories; only paths are read."""
    files = None
    for d in directories:
        found = spark.read.format("binaryFile").option("pathGlobFilter", "*").load(d).select("path")
        files = found if files is None else files.unionByName(found)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "path").where(F.col("name").rlike(SCRIPT))


def pending(found: DataFrame, done: DataFrame) -> DataFrame:
    """Rows of ``found`` (name) that are scripts and not in the ledger ``done`` (name)."""
    return found.where(F.col("name").rlike(SCRIPT)).join(done.select("name").where("name is not null"), "name", "left_anti")


def in_order(found: DataFrame) -> DataFrame:
    """Scripts in the order of a language's collation, in which digits and letters go before case."""
    return found.orderBy(F.collate("name", "UNICODE"), "name")


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger at a path; made empty if there is none."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        spark.createDataFrame([], "name string").write.parquet(path)
    return spark.read.schema("name string").parquet(path)


def note(names: DataFrame, path: str) -> None:
    """Append names to the ledger at a path; it is made if there is none."""
    ledger(names.sparkSession, path)
    names.select("name").write.mode("append").parquet(path)


def of_type(items: DataFrame, type_: str) -> DataFrame:
    """The ledger among records of all types: the filter goes to the scan."""
    return items.where(F.col("type") == type_).select("name")


def run(spark: SparkSession, found: DataFrame, path: str, steps: dict[str, Callable[[SparkSession], None]], dry: bool = False) -> list[str]:
    """Run the pending scripts' steps in order and note each in the ledger after it; the first failure ends the run. A dry run does neither."""
    names = [r["name"] for r in in_order(pending(found.select("name"), ledger(spark, path))).collect()]  # a run's own scripts: a few
    for name in [] if dry else names:
        steps[name](spark)
        spark.createDataFrame([(name,)], "name string").coalesce(1).write.mode("append").parquet(path)
    return names

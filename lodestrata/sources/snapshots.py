"""Snapshots of catalogs as partitioned Parquet: env=<id>/kind=<kind>/."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.canonical import canonical_values

ENTITY = "id string, ord long, owner string, attributes map<string,string>, relationships map<string,string>, meta map<string,string>, env string, kind string"


def save(entities: DataFrame, path: str, env: str) -> None:
    """Write a snapshot of one environment with its values in canonical JSON; what it had is replaced, other environments stay."""
    spark = entities.sparkSession
    entities = entities.withColumns({c: canonical_values(F.col(c)) for c in ("attributes", "relationships", "meta")})
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        entities.withColumn("env", F.lit(env)).write.mode("overwrite").partitionBy("env", "kind").parquet(path)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)


def load(spark: SparkSession, path: str, env: str, *kinds: str) -> DataFrame:
    """One environment's entities, of some kinds or all; partitions that aren't asked for aren't read."""
    rows = spark.read.schema(ENTITY).parquet(path).where(F.col("env") == env)
    return (rows.where(F.col("kind").isin(*kinds)) if kinds else rows).drop("env")


def fork(spark: SparkSession, path: str, env: str, new_env: str) -> None:
    """Copy an environment under another name."""
    save(load(spark, path, env), path, new_env)


def _folder(spark: SparkSession, path: str, env: str | None = None):
    """The file system of a path, and the path of all snapshots or of one."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path if env is None else f"{path}/env={env}")
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def listed(spark: SparkSession, path: str) -> list[str]:
    """The names of all environments."""
    store, where = _folder(spark, path)
    return sorted(f.getPath().getName().removeprefix("env=") for f in store.listStatus(where) if f.getPath().getName().startswith("env="))


def rename(spark: SparkSession, path: str, env: str, new_env: str) -> None:
    """Give an environment another name, which none may have yet."""
    store, old = _folder(spark, path, env)
    new = _folder(spark, path, new_env)[1]
    if store.exists(new) or not store.rename(old, new):
        raise ValueError(f"{env} can't be renamed to {new_env}")


def destroy(spark: SparkSession, path: str, env: str) -> None:
    """Delete an environment."""
    store, where = _folder(spark, path, env)
    store.delete(where, True)


def split(included: DataFrame, kind: str) -> DataFrame:
    """The rows of one kind of a mixed table."""
    return included.where(F.col("kind") == kind)


def shared(filters: DataFrame) -> DataFrame:
    """Filters that are shared."""
    return filters.where(F.try_element_at("attributes", F.lit("shared")) == "true")


def environments(spec: str, primary: str) -> tuple[str, str]:
    """The new and the old environment of ``new[:old]``; the old one is the primary unless given."""
    new, _, old = spec.partition(":")
    return new, old or primary

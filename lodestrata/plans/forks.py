"""Plans between environments of one store: only buckets that may differ are read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources import environments
from .diff import States, change_plan


def changes(spark: SparkSession, path: str, old: str, new: str, *kinds: str) -> States:
    """Both states of the entities in buckets that differ: all that has changed is among them."""
    buckets = environments.differing(spark, path, old, new)
    side = lambda env: environments.load(spark, path, env, *kinds, buckets=buckets)
    return States.of(side(old), side(new), canonical=True)


def plan(spark: SparkSession, path: str, old: str, new: str, references: DataFrame) -> DataFrame:
    """The plan of all phases; a model with its fields is in one bucket, and menus, the site and roles are always read."""
    buckets = environments.needed(environments.differing(spark, path, old, new), spark, path, old, new)
    side = lambda env: environments.load(spark, path, env, buckets=buckets)
    return change_plan(side(old), side(new), references, old, new, canonical=True)

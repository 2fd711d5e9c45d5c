"""Ranking and positions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.names import fuzzy_score, letters, sure_score
from ..sources.folders import shared_folder


def top(rows: DataFrame, score: Column, k: int | None, *ties: str) -> DataFrame:
    """Rows with a score over 0, best first, ties in the given order: at most k of them."""
    ranked = rows.withColumn("score", score).where("score > 0").orderBy(F.desc("score"), *ties)
    return ranked if k is None else ranked.limit(k)


def top_fuzzy(rows: DataFrame, query: str, columns: list[Column], k: int, *ties: str, signatures: list[Column] | None = None) -> DataFrame:
    """The k best rows by the greatest fuzzy score of some columns, as ``top`` gives them, with as few walks through letters as it takes.

    A query of n letters that a column has in order, but not in one piece, scores 3 n - 2 at most. If k rows score more than that by
    equality, prefix or part alone, they are the best, and no other row is scored. Else only columns are that have all the
    query's letters, by ``signatures`` (``letters`` of the columns, which can be stored beside them) where they are given.
    """
    q = F.lit(query)
    greatest = lambda cs: F.greatest(*cs) if len(cs) > 1 else cs[0]
    best = top(rows, greatest([F.coalesce(sure_score(q, c), F.lit(0)) for c in columns]), k, *ties)
    found = best.agg(F.count("*").alias("n"), F.min("score").alias("least")).first()
    if found["n"] == k and found["least"] > 3 * len(query) - 2:
        return best
    return top(candidates(rows, query, columns, signatures), greatest([fuzzy_score(q, c) for c in columns]), k, *ties)


def candidates(rows: DataFrame, query: str, columns: list[Column], signatures: list[Column] | None = None) -> DataFrame:
    """The rows that can score: with a column that has all of the query's letters."""
    wanted = letters(F.lit(query))
    has = [s.bitwiseAND(wanted) == wanted for s in signatures or map(letters, columns)]
    return rows.where(reduce(lambda a, b: a | b, [F.coalesce(h, F.lit(False)) for h in has])) if query else rows.where("false")


def exact_else_fuzzy(rows: DataFrame, exact: Column, score: Column, k: int | None, *ties: str) -> DataFrame:
    """All exact rows if there are any, whatever k; else the best by score."""
    hits = rows.where(exact).withColumn("score", F.lit(1000))
    other = top(rows, score, k, *ties)
    some = hits.limit(1).select(F.lit(1).alias("__some"))
    return hits.unionByName(other.join(F.broadcast(some), F.lit(True), "left_anti"))


def next_position(rows: DataFrame, scope: str, position: str) -> DataFrame:
    """(scope, next_position): one more than the highest position in each scope, 0 being the least."""
    return rows.groupBy(scope).agg((F.greatest(F.max(position), F.lit(0)) + 1).alias("next_position"))


def numbered(rows: DataFrame, by: list[str], *order: str, name: str) -> DataFrame:
    """``rows`` with a running number from 1 among those with the same ``by``, in ``order``; no task has a whole group.

    Rows are sorted into ranges and numbered there. What a group has in earlier ranges is added: that is a row for each border
    between ranges at most, so it is broadcast. Rows that are equal in all these columns are in one range.
    """
    shared_folder(rows.sparkSession)
    ranges = rows.repartitionByRange(*by, *order).withColumn("__range", F.spark_partition_id()).checkpoint()
    held = ranges.groupBy("__range", *by).agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.partitionBy(*by).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1))
    earlier = held.withColumn("__before", before).where("__before > 0").select(F.col("__range").alias("__there"), *[F.col(c).alias(f"__{c}") for c in by], "__before")
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in by], F.col("__range") == F.col("__there"))
    own = F.row_number().over(Window.partitionBy("__range", *by).orderBy(*order))
    return ranges.withColumn(name, own.cast("long")).join(F.broadcast(earlier), same, "left").select(*rows.columns, (F.col(name) + F.coalesce("__before", F.lit(0))).alias(name))

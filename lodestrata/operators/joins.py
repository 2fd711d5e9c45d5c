"""Joins between two states of a catalog and between links and what they point to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def wide(rows: DataFrame) -> DataFrame:
    """``rows`` for a join in which they grow with the input: never broadcast, however small the files that they come from."""
    return rows.hint("merge")


def created(old: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    """Rows of ``new`` that ``old`` has no key for."""
    return new.join(old.select(key), key, "left_anti")


def deleted(old: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    """Rows of ``old`` that ``new`` has no key for."""
    return created(new, old, key)


def kept(old: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    """Both states of the keys that both have: the columns of ``old`` and ``new`` with these prefixes."""
    side = lambda df, name: df.select(key, *[F.col(c).alias(f"{name}_{c}") for c in df.columns if c != key])
    return side(old, "old").join(side(new, "new"), key)


def deep_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of ``left`` that no row of ``right`` equals in all columns, nulls included; repeated rows stay repeated."""
    same = F.lit(True)
    a, b = left.alias("a"), wide(right.distinct()).alias("b")
    for c in left.columns:
        same = same & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    return a.join(b, same, "left_anti")


def first_match(rows: DataFrame, key: str | list[str], *order: str | Column) -> DataFrame:
    """The first row of each key in the given order, which should have no ties."""
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("__n = 1").drop("__n")


def last_match(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """The last row of each key."""
    return first_match(rows, key, *[F.desc(c) for c in order])


def mark(rows: DataFrame, others: DataFrame, key: str, name: str) -> DataFrame:
    """``rows`` and whether ``others`` has the key; null keys have no match."""
    there = others.select(key).where(F.col(key).isNotNull()).distinct().withColumn(name, F.lit(True))
    return rows.join(there, key, "left").withColumn(name, F.coalesce(name, F.lit(False)))


def resolve(links: DataFrame, targets: DataFrame, link: str, source: str, target: str, allowed: Column | None = None) -> DataFrame:
    """``links`` and the column ``target`` of ``targets`` for its ``source`` equal to ``link``; null if there is none or it isn't allowed."""
    found = links.join(targets.withColumnRenamed(source, link), link, "left")
    return found if allowed is None else found.withColumn(target, F.when(allowed, F.col(target)))


def resolve_list(rows: DataFrame, key: str | list[str], links: str, targets: DataFrame, source: str, target: str, holes: bool = False, along: Sequence[str] = ()) -> DataFrame:
    """(key, links): each list's links replaced by their targets, in order and with repeats.

    A link without a target is left out, or stays as null where ``holes`` is set. Lists that are empty or null give empty lists.
    Columns ``along``, which have one value for each key, are taken along, so that ``rows`` need not be read again for them.
    """
    key = [key] if isinstance(key, str) else key
    each = rows.select(*key, *along, F.posexplode_outer(links).alias("__at", "__link"))
    found = each.join(targets.select(F.col(source).alias("__link"), F.col(target).alias("__to")), "__link", "left")
    there = F.col("__at").isNotNull() if holes else F.col("__to").isNotNull()
    made = found.groupBy(*key).agg(F.sort_array(F.collect_list(F.when(there, F.struct("__at", "__to")))).alias(links), *[F.max(c).alias(c) for c in along])
    return made.withColumn(links, F.transform(links, lambda x: x["__to"]))


def allowed_or_all(rows: DataFrame, key: str, names: str, targets: DataFrame, source: str, target: str) -> DataFrame:
    """(key, names): the targets of the names that there are; a list that is null or empty stands for all targets.

    What stands for all is marked, not copied into each row: names is null and unrestricted true.
    """
    free = F.coalesce(F.size(F.col(names)) <= 0, F.lit(True))
    found = resolve_list(rows, key, names, targets, source, target)
    return rows.select(key, free.alias("unrestricted")).join(found, key).withColumn(names, F.when(~F.col("unrestricted"), F.array_distinct(names)))


def strip(rows: DataFrame, key: str, items: str, gone: DataFrame, item: str) -> DataFrame:
    """(key, before, after): how many items each list has with and without those in ``gone``; only lists that get shorter."""
    each = rows.select(key, F.explode(items).alias(item))
    left = mark(each, gone, item, "__gone").groupBy(key).agg(F.count("*").alias("before"), F.count_if(~F.col("__gone")).alias("after"))
    return left.where("after < before")

"""Projections of open attribute maps (name to canonical JSON text)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .canonical import truthy


def pick(attributes: Column, *names: str) -> Column:
    return F.map_filter(attributes, lambda k, _: k.isin(*names))


def omit(attributes: Column, *names: str) -> Column:
    return F.map_filter(attributes, lambda k, _: ~k.isin(*names))


def without_nulls(relationships: Column) -> Column:
    """Relationships that point somewhere."""
    return F.map_filter(relationships, lambda _, v: v.isNotNull() & ~v.isin("null", '{"data":null}'))


def without_falsy(attributes: Column, *names: str) -> Column:
    """Truthy attributes, less ``names``."""
    return F.map_filter(attributes, lambda k, v: truthy(v) & ~k.isin(*names) if names else truthy(v))


def beyond_defaults(attributes: Column, defaults: dict[str, str], ignored: tuple[str, ...] = ()) -> Column:
    """Attributes that differ from their kind's default value; those without a default stay."""
    default = F.create_map(*[F.lit(x) for kv in defaults.items() for x in kv]) if defaults else None
    keep = (lambda k, v: ~F.coalesce(F.try_element_at(default, k) == v, F.lit(False))) if defaults else (lambda k, v: F.lit(True))
    return F.map_filter(attributes, lambda k, v: keep(k, v) & (~k.isin(*ignored) if ignored else F.lit(True)))


def overlay(old: Column, new: Column) -> Column:
    """Both maps in one; where both have a key the new value counts."""
    return F.map_concat(F.map_filter(old, lambda k, _: ~F.map_contains_key(new, k)), new)


def locale_nulls(locales: Column) -> Column:
    """The default of a localised value: null for one locale, else an object of nulls."""
    each = F.transform(locales, lambda x: F.concat(F.lit('"'), x, F.lit('":null')))
    return F.when(F.size(locales) <= 1, "null").otherwise(F.concat(F.lit("{"), F.array_join(each, ","), F.lit("}")))


def by_locale(rows: DataFrame, key: str, locale: str, *fields: str) -> DataFrame:
    """(key, fields): each field of the rows of a key as a map of locale to value."""
    return rows.groupBy(key).agg(*[F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(locale), F.col(c))))).alias(c) for c in fields])

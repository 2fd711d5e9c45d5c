"""Rewriting of texts by a map of old to new strings, and small extractions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F


def replace_first(text: Column, old: Column, new: Column) -> Column:
    """The first occurrence of ``old`` replaced; unchanged if there is none."""
    at = F.position(old, text)
    return F.when(at > 0, F.concat(F.substring(text, F.lit(1), at - 1), new, F.substring(text, at + F.length(old), F.length(text)))).otherwise(text)


def rewrite_first(text: Column, pairs: Column) -> Column:
    """The first occurrence of each old string replaced, pair by pair (array of structs old, new): a later pair sees what earlier ones made."""
    return F.aggregate(pairs, text, lambda t, p: replace_first(t, p["old"], p["new"]))


def rewrite_all(text: Column, pairs: dict[str, str]) -> Column:
    """Every occurrence of each old string replaced, whatever its case, pair by pair."""
    quoted = {"(?i)\\Q" + old + "\\E": new.replace("\\", "\\\\").replace("$", "\\$") for old, new in pairs.items()}
    return reduce(lambda t, kv: F.regexp_replace(t, kv[0], kv[1]), quoted.items(), text)


def content_md5(etag: Column) -> Column:
    """The MD5 that an entity tag holds; null if it is of another kind (it has a -)."""
    tag = F.regexp_replace(F.trim(etag), '"', "")
    return F.when(~F.contains(tag, F.lit("-")), tag)


def first_given(*values: Column) -> Column:
    """The first value that is neither null nor empty."""
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values])

"""Names for helper columns that no column of a table has, and for rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def spare(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with as many underscores in front as it takes to be new to ``df`` (whatever the case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def row_digest(id_col: str, text_col: str) -> Column:
    """128 bits that name a row by its id and text; a null text is empty."""
    id_ = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    return F.unhex(F.md5(F.concat(id_, F.lit("\0"), F.coalesce(F.col(text_col), F.lit(""))).cast("binary")))

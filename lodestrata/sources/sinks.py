"""Sinks: inserts that leave alone what is there, deletes, logs by call, and settings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.joins import created, strip

_CALL = r"^\[([^\]]+)\]"


def to_insert(rows: DataFrame, there: DataFrame, key: str, *order: str) -> DataFrame:
    """Rows whose key isn't there yet, the first of each key: appending them twice changes nothing."""
    from ..operators.joins import first_match

    return created(there, first_match(rows.where(F.col(key).isNotNull()), key, *order), key)


def insert(rows: DataFrame, path: str, key: str, *order: str) -> None:
    """Append to a Parquet table the rows that it lacks."""
    there = rows.sparkSession.read.schema(rows.schema).parquet(path)
    to_insert(rows, there, key, *order).write.mode("append").parquet(path)


def without(rows: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """What is left after ``gone`` is destroyed."""
    return rows.join(gone.select(key), key, "left_anti")


def narrowed(fields: DataFrame, key: str, allowed: str, gone: DataFrame, model: str) -> DataFrame:
    """Fields whose list of allowed models gets shorter when ``gone`` is destroyed: these have to be updated first."""
    return strip(fields, key, allowed, gone, model)


def call_of(line: Column) -> Column:
    """The call that a log line belongs to: what it has in brackets at its start."""
    return F.nullif(F.regexp_extract(line, _CALL, 1), F.lit(""))


def write_log(lines: DataFrame, path: str, by_call: bool = False) -> None:
    """Write log lines (column value) as text, in a folder for each call if asked for."""
    if by_call:
        lines.withColumn("call", F.coalesce(call_of(F.col("value")), F.lit("none"))).write.partitionBy("call").text(path)
    else:
        lines.select("value").write.text(path)


def with_setting(settings: Column, key: str, value: Column | None) -> Column:
    """A map of settings with one set, or taken out where the value is None."""
    rest = F.map_filter(settings, lambda k, _: k != key)
    return rest if value is None else F.map_concat(rest, F.create_map(F.lit(key), value))

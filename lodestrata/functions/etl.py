"""Field types, values and validators of imported content."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

# Source field type to target field type.
TYPES = {
    "Symbol": "string", "Text": "text", "Integer": "integer", "Number": "float", "Date": "date_time", "Location": "lat_lon", "Boolean": "boolean",
    "Object": "json", "RichText": "structured_text",
}
LINK_TYPES = {"Entry": "link", "Asset": "file"}
LIST_TYPES = {"Entry": "links", "Asset": "gallery"}


def _lookup(key: Column, table: dict[str, str]) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), key)


def field_type(kind: Column, link: Column, items: Column, slug: Column) -> Column:
    """The target type of a source type; ``link`` and ``items`` are what links and lists point to, ``slug`` says that the editor is one."""
    plain = F.when((kind == "Symbol") & slug, "slug").otherwise(_lookup(kind, TYPES))
    return F.coalesce(F.when(kind == "Link", _lookup(link, LINK_TYPES)).when(kind == "Array", _lookup(items, LIST_TYPES)).otherwise(plain), F.lit("string"))


def value_text(target: Column, value: Column) -> Column:
    """A source value (JSON text) as the target type stores it, in text: links wait for the second pass, lists of words are joined."""
    place = F.from_json(value, "lat double, lon double")
    words = F.array_join(F.from_json(value, "array<string>"), ", ")
    return (
        F.when(target.isin("links", "gallery"), "[]")
        .when(target.isin("link", "file", "structured_text"), None)
        .when(target == "lat_lon", F.to_json(F.struct(place["lat"].alias("latitude"), place["lon"].alias("longitude"))))
        .when((target == "string") & F.startswith(value, F.lit("[")), words)
        .otherwise(value)
    )


def bounds(low: Column, high: Column) -> Column:
    """A range validator: eq where both ends are the same, else the ends there are; zero is no bound."""
    low, high = F.nullif(low, F.lit(0)), F.nullif(high, F.lit(0))
    same = low == high
    return F.struct(F.when(same, low).alias("eq"), F.when(~F.coalesce(same, F.lit(False)), low).alias("min"), F.when(~F.coalesce(same, F.lit(False)), high).alias("max"))


def range_json(low: Column, high: Column) -> Column:
    return F.to_json(bounds(low, high))


# What a validation of a source field holds.
VALIDATIONS = "array<struct<size:struct<min:long,max:long>,unique:boolean,in:array<string>,regexp:string,range:struct<min:double,max:double>,dateRange:struct<min:string,max:string>,assetFileSize:struct<min:long,max:long>>>"


def _once(value: Column, made: Callable[[Column], Column]) -> Column:
    """``made(value)`` with the value computed once, however often it is mentioned."""
    return F.get(F.transform(F.array(value), made), F.lit(0))


def _last(validations: Column, name: str) -> Column:
    """The last validation of a kind; null if there is none."""
    have = F.filter(F.transform(validations, lambda v: v[name]), lambda x: x.isNotNull())
    return F.try_element_at(have, F.lit(-1))


def _entries(*pairs: tuple[str, Column]) -> Column:
    """A map of name to JSON text of the values that there are."""
    each = F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in pairs])
    return F.map_from_entries(F.filter(each, lambda e: e["value"].isNotNull()))


def _span(v: Column) -> Column:
    return F.when(v.isNotNull(), range_json(v["min"], v["max"]))


def string_validators(required: Column, validations: Column) -> Column:
    """Validators of a string or a slug: of several validations of a kind the last counts."""
    pattern, values = _last(validations, "regexp"), _last(validations, "in")
    return _entries(
        ("required", F.when(required, "{}")), ("length", _span(_last(validations, "size"))), ("unique", F.when(_last(validations, "unique").isNotNull(), "{}")),
        ("enum", F.when(values.isNotNull(), F.to_json(F.struct(values.alias("values"))))), ("format", F.when(pattern.isNotNull(), F.to_json(F.struct(pattern.alias("custom_pattern"))))),
    )


def number_validators(required: Column, validations: Column) -> Column:
    r = _last(validations, "range")
    ends = F.to_json(F.struct(F.nullif(r["min"], F.lit(0.0)).alias("min"), F.nullif(r["max"], F.lit(0.0)).alias("max")))
    return _entries(("required", F.when(required, "{}")), ("number_range", F.when(r.isNotNull(), ends)))


def date_validators(required: Column, validations: Column) -> Column:
    """Dates as moments of the session's zone; a missing end stays as null."""
    r = _last(validations, "dateRange")
    moment = lambda c: F.date_format(F.to_timestamp(c), "yyyy-MM-dd'T'HH:mm:ssXXX")
    ends = F.to_json(F.struct(moment(r["min"]).alias("min"), moment(r["max"]).alias("max")), {"ignoreNullFields": "false"})
    return _entries(("required", F.when(required, "{}")), ("date_time_range", F.when(r.isNotNull(), ends)))


def asset_validators(required: Column, validations: Column) -> Column:
    """File sizes in bytes."""
    r = _last(validations, "assetFileSize")
    low, high = F.nullif(r["min"], F.lit(0)), F.nullif(r["max"], F.lit(0))
    size = F.to_json(F.struct(low.alias("min_value"), F.when(low.isNotNull(), "B").alias("min_unit"), high.alias("max_value"), F.when(high.isNotNull(), "B").alias("max_unit")))
    return _entries(("required", F.when(required, "{}")), ("file_size", F.when(low.isNotNull() | high.isNotNull(), size)))


def list_validators(required: Column, validations: Column) -> Column:
    """Validators of a list: its size only; a list is never required."""
    return _entries(("size", _span(_last(validations, "size"))))


def field_validators(target: Column, required: Column, validations: Column) -> Column:
    """The validators of a field of the target type (a map of name to JSON). ``validations`` may be parsed from a text: it is, once."""
    return _once(validations, lambda v: _of_type(target, required, v))


def _of_type(target: Column, required: Column, validations: Column) -> Column:
    v = {k: f(required, validations) for k, f in (("s", string_validators), ("n", number_validators), ("d", date_validators), ("a", asset_validators), ("l", list_validators))}
    only = _entries(("required", F.when(required, "{}")))
    return (
        F.when(target.isin("string", "slug", "text"), v["s"]).when(target.isin("integer", "float"), v["n"]).when(target.isin("date", "date_time"), v["d"])
        .when(target == "file", v["a"]).when(target.isin("links", "gallery"), v["l"]).otherwise(only)
    )

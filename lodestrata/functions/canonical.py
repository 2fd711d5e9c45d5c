"""Deep equality and truthiness of JSON values, and the order in which a catalog lists its keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_ID_LENGTH = 22
_KEY_LIMIT = 2**32 - 2
# Printable ASCII that JSON strings have as it is, and values that are in canonical form already: constants, strings of
# such letters, integers, nothing in brackets, and references.
_PLAIN = r'[ !#-\[\]-~]*'
_PLAIN_TEXT = rf"\A{_PLAIN}\z"
_SETTLED = rf'\A(?:null|true|false|0|-?[1-9][0-9]{{0,17}}|\{{\}}|\[\]|"{_PLAIN}"|\{{"data":(?:null|\{{"id":"{_PLAIN}"\}})\}})\z'


def canonical(json: Column) -> Column:
    """JSON text with sorted keys and one form for each number: equal texts are deeply equal values.

    Most values are in that form as they come, which a pattern tells; only the others are parsed.
    """
    return F.when(json.rlike(_SETTLED), json).otherwise(F.to_json(F.parse_json(json)))


def canonical_values(attributes: Column) -> Column:
    """A map whose values are canonical JSON."""
    return F.transform_values(attributes, lambda _, v: canonical(v))


def truthy(json: Column) -> Column:
    """False for a missing value, null, false, zero in any form and the empty string."""
    zero = json.rlike(r"^-?0+(\.0*)?([eE][+-]?[0-9]+)?$")
    return ~F.coalesce(json.isin("null", "false", '""') | zero, F.lit(True))


def json_string(text: Column) -> Column:
    """A text as a JSON string."""
    quoted = F.to_json(F.array(text))
    return F.when(text.rlike(_PLAIN_TEXT), F.concat(F.lit('"'), text, F.lit('"'))).otherwise(F.substring(quoted, F.lit(2), F.length(quoted) - 2))


def json_object(values: Column) -> Column:
    """A map of name to JSON text as a JSON object, names in order."""
    each = F.transform(F.sort_array(F.map_entries(values)), lambda e: F.concat(json_string(e["key"]), F.lit(":"), e["value"]))
    return F.concat(F.lit("{"), F.array_join(each, ","), F.lit("}"))


def json_array(items: Column) -> Column:
    """An array of JSON texts as a JSON array."""
    return F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))


def survives(id_: Column) -> Column:
    """Whether an id of this form stays the same when its entity is made again in another environment."""
    return F.length(id_) == _ID_LENGTH


def integer_like(key: Column) -> Column:
    """Whether a key is listed by number: the digits of an integer below 2**32 - 1 without leading zeros."""
    return key.rlike("^(0|[1-9][0-9]{0,9})$") & (key.cast("long") <= _KEY_LIMIT)


def key_order(key: Column, arrival: Column) -> list[Column]:
    """Sort columns that list integer-like keys first, by number, and the others as they came."""
    number = F.when(integer_like(key), key.cast("long"))
    return [number.isNull(), number, arrival]

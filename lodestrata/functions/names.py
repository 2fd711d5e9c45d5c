"""Names and keys: casing, normalising, and the score of a fuzzy match."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Field keys that the target keeps for itself.
RESERVED = (
    "position", "is_valid", "id", "type", "updated_at", "created_at", "attributes", "fields", "item_type", "is_singleton", "seo_meta_tags",
    "parent_id", "parent", "children", "status", "meta", "eq", "neq", "all_in", "any_in", "exists",
)


def decamelize(name: Column) -> Column:
    """A _ before each capital but the first character, all in lower case."""
    return F.lower(F.regexp_replace(name, "(?<=.)(?=[A-Z])", "_"))


def model_key(name: Column) -> Column:
    """The key of a model: words in snake case without leading or trailing _ and digits after _, and _model at the end."""
    words = F.regexp_replace(decamelize(name), "[^A-Za-z0-9_]", "_")
    plain = F.regexp_replace(F.regexp_replace(words, r"(?m)^\d+", "n"), r"(?m)^_+|_+\d+|_+$", "")
    return F.regexp_replace(F.concat(plain, F.lit("_model")), "_{2,}", "_")


def field_key(name: Column) -> Column:
    """The key of a field; reserved ones get a suffix."""
    key = decamelize(name)
    return F.when(key.isin(*RESERVED), F.concat(key, F.lit("_field"))).otherwise(key)


def normalised(name: Column) -> Column:
    """Lower case without _ and -."""
    return F.regexp_replace(F.lower(name), "[_-]", "")


def upper_first(name: Column) -> Column:
    """The first letter in upper case, the others as they are."""
    return F.concat(F.upper(F.substring(name, F.lit(1), F.lit(1))), F.substring(name, F.lit(2), F.length(name)))


def camel_case(name: Column) -> Column:
    """The words of a name put together, each but the first with a capital."""
    words = F.regexp_replace(F.regexp_replace(name, "(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])|(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])", " "), "[^A-Za-z0-9]+", " ")
    each = F.transform(F.split(F.trim(F.lower(words)), " "), lambda w: upper_first(w))
    joined = F.array_join(each, "")
    return F.concat(F.lower(F.substring(joined, F.lit(1), F.lit(1))), F.substring(joined, F.lit(2), F.length(joined)))


def titleized(key: Column) -> Column:
    """A key as a label: words apart, each with a capital; an id at the end goes."""
    words = F.regexp_replace(F.regexp_replace(decamelize(key), "_id$", ""), "[_ -]+", " ")
    return F.array_join(F.transform(F.split(F.trim(words), " "), lambda w: upper_first(w)), " ")


def script_name(seconds: Column, name: Column, format_: str = "ts") -> Column:
    """The file name of a new script: the time, the name in camel case, and the format."""
    return F.concat(seconds.cast("string"), F.lit("_"), camel_case(name), F.lit(f".{format_}"))


def without_suffix(name: Column, suffix: str) -> Column:
    return F.when(F.endswith(name, F.lit(suffix)), F.substring(name, F.lit(1), F.length(name) - len(suffix))).otherwise(name)


def fuzzy_score(query: Column, target: Column) -> Column:
    """1000 if equal, 500 and more for a prefix, about 200 for a part; else the letters found in order and twice the longest run.

    0 for an empty query and where not all letters are found in order. A part far from the start can score below 0.
    """
    n = F.length(query)
    at = F.position(query, target) - 1
    start = F.struct(F.lit(0).alias("found"), F.lit(-2).alias("last"), F.lit(0).alias("run"), F.lit(0).alias("best"))

    def step(acc: Column, i: Column) -> Column:
        hit = (acc["found"] < n) & (F.substring(target, i + 1, F.lit(1)) == F.substring(query, acc["found"] + 1, F.lit(1)))
        run = F.when(acc["last"] == i - 1, acc["run"] + 1).otherwise(1)
        best = F.when(acc["last"] == i - 1, F.greatest(acc["best"], run)).otherwise(acc["best"])
        return F.when(hit, F.struct((acc["found"] + 1).alias("found"), i.alias("last"), run.alias("run"), best.alias("best"))).otherwise(acc)

    letters = F.when(F.length(target) > 0, F.sequence(F.lit(0), F.length(target) - 1)).otherwise(F.array().cast("array<int>"))
    in_order = F.aggregate(letters, start, step, lambda acc: F.when(acc["found"] < n, 0).otherwise(acc["found"] + 2 * acc["best"]))
    return F.when(n == 0, 0).when(target == query, 1000).when(at == 0, 500 + n).when(at > 0, 200 + n - at).otherwise(in_order)


def sure_score(query: Column, target: Column) -> Column:
    """The fuzzy score where it takes no walk through the letters: equal, a prefix or a part; null elsewhere."""
    n, at = F.length(query), F.position(query, target) - 1
    return F.when(n == 0, None).when(target == query, 1000).when(at == 0, 500 + n).when(at > 0, 200 + n - at)


def letters(text: Column) -> Column:
    """A bit for each of 63 classes of letters that a text has: what one has and another lacks can't be found in that one."""
    each = F.array_distinct(F.split(text, ""))
    return F.aggregate(each, F.lit(0).cast("long"), lambda a, c: a.bitwiseOR(F.when(c == "", 0).otherwise(F.call_function("shiftleft", F.lit(1).cast("long"), (F.ascii(c) % 63).cast("int")))))

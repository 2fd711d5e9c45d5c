"""Import of typed content: types become models, their fields are described, entries become records, and links come last.

Types have (type_id, name, display, fields), fields being an array of FIELD; entries have (entry_id, type_id, created_at,
first_published_at, published_version, content), content being a map of field to a map of locale to JSON. Everything is joined on keys;
a field's place is its index in its type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import etl, names
from ..functions.canonical import json_array, json_object, json_string, truthy
from ..functions.maps import overlay
from ..operators.joins import first_match, resolve_list
from ..operators.rewrite import rewrite
from ..sources.folders import new_path

FIELD = (
    "struct<id:string,name:string,type:string,link:string,localized:boolean,required:boolean,item_type:string,item_link:string,links:array<string>,item_links:array<string>,"
    "blocks:array<string>,inlines:array<string>>"
)
# What every imported model is given, and the block that holds the assets of structured texts.
MODEL = {
    "modular_block": "false", "ordering_direction": "null", "ordering_field": "null", "singleton": "false", "sortable": "false", "tree": "false", "draft_mode_active": "true",
    "all_locales_required": "false",
}
#: So many of the commonest targets of links are looked up beside the shuffle.
HOT = 256
ASSET_BLOCK, ASSET_FIELD = "structured_text_asset", "file"
LINK_TYPES = ("link", "links", "file", "gallery", "structured_text")
TITLE_EDITOR = '{"editor":"single_line","parameters":{"heading":true},"addons":[]}'


def only(rows: DataFrame, column: str, spec: str | None) -> DataFrame:
    """Rows of the types that a comma-separated list names; all if there is no list. Names aren't trimmed."""
    return rows.where(F.col(column).isin(*spec.split(","))) if spec else rows


def models(types: DataFrame) -> DataFrame:
    """(type_id, api_key, name, attributes): the model of each type; attributes are the same for all."""
    attributes = F.create_map(*[F.lit(x) for kv in MODEL.items() for x in kv])
    return types.select("type_id", names.model_key(F.col("type_id")).alias("api_key"), "name", attributes.alias("attributes"))


def block_model(there: DataFrame) -> DataFrame:
    """(id, api_key): the block for assets, from the models ``there`` (id, api_key), or a new one if there is none."""
    found = there.where(F.col("api_key") == ASSET_BLOCK).agg(F.min("id").alias("id"))
    return found.select(F.coalesce("id", F.lit(f"new:{ASSET_BLOCK}")).alias("id"), F.lit(ASSET_BLOCK).alias("api_key"), F.col("id").isNull().alias("made"))


def block_models(there: DataFrame) -> DataFrame:
    """(site, id, api_key, made): for each site of the models ``there`` (site, id, api_key) its block for assets, or a new one if it has none."""
    found = there.groupBy("site").agg(F.min(F.when(F.col("api_key") == ASSET_BLOCK, F.col("id"))).alias("id"))
    return found.select("site", F.coalesce("id", F.lit(f"new:{ASSET_BLOCK}")).alias("id"), F.lit(ASSET_BLOCK).alias("api_key"), F.col("id").isNull().alias("made"))


def fields(types: DataFrame) -> DataFrame:
    """(type_id, display, position, and the parts of FIELD): a row for each field, its position the index."""
    each = types.select("type_id", "display", F.posexplode("fields").alias("position", "field"))
    return each.select("type_id", "display", "position", F.col("field.id").alias("field_id"), *[F.col(f"field.{c}") for c in ("name", "type", "link", "localized", "required", "item_type", "item_link", "links", "item_links", "blocks", "inlines")])


def is_single_link() -> Column:
    return (F.col("type") == "Link") & F.coalesce(F.col("link") == "Entry", F.lit(False))


def is_many_links() -> Column:
    return (F.col("type") == "Array") & F.coalesce((F.col("item_type") == "Link") & (F.col("item_link") == "Entry"), F.lit(False))


def is_title() -> Column:
    return (F.col("field_id") == F.col("display")) & (F.col("type") == "Symbol")


def is_slug() -> Column:
    return F.coalesce(F.col("widget") == "slugEditor", F.lit(False))


def is_link_type(target: Column) -> Column:
    return target.isin(*LINK_TYPES)


def with_controls(rows: DataFrame, controls: DataFrame) -> DataFrame:
    """``rows`` of fields with the widget and the tracked field of their first control (type_id, ord, field_id, widget, tracking)."""
    own = first_match(controls, ["type_id", "field_id"], "ord").drop("ord")
    return rows.join(own, ["type_id", "field_id"], "left")


def linked_models(rows: DataFrame, made: DataFrame) -> DataFrame:
    """(type_id, field_id, unrestricted, item_types): the models (type_id, id) that each link field may point to.

    A list of types that is missing or empty stands for all models, which is marked, not copied; for a rich text that holds only
    where both of its lists are missing, and its models are named once. Types without a model are left out.
    """
    none, rich = F.array().cast("array<string>"), F.col("type") == "RichText"
    one, many = F.coalesce(F.col("links"), none), F.coalesce(F.col("item_links"), none)
    both = F.concat(F.coalesce(F.col("blocks"), none), F.coalesce(F.col("inlines"), none))
    listed = F.when(is_single_link(), one).when(is_many_links(), many).when(rich, both)
    free = F.when(rich, F.col("blocks").isNull() & F.col("inlines").isNull()).otherwise(F.size(listed) == 0)
    some = rows.where(is_single_link() | is_many_links() | rich).select("type_id", "field_id", listed.alias("names"), free.alias("unrestricted"), rich.alias("__rich"))
    out = resolve_list(some, ["type_id", "field_id"], "names", made.select(F.col("type_id").alias("source"), "id"), "source", "id", along=["unrestricted", "__rich"])
    listed = F.when(~F.col("unrestricted"), F.when(F.col("__rich"), F.array_distinct("names")).otherwise(F.col("names")))
    return out.select("type_id", "field_id", "unrestricted", listed.alias("item_types"))


def describe(types: DataFrame, controls: DataFrame, made: DataFrame, block: str | None = None) -> DataFrame:
    """(type_id, field_id, label, api_key, field_type, localized, position, validator, unrestricted, item_types, blocks, appearance).

    validator names the one that the models are listed under; blocks is the asset block of a rich text, appearance the heading
    editor of a title.
    """
    rows = with_controls(fields(types), controls)
    target = etl.field_type(F.col("type"), F.col("link"), F.col("item_link"), is_slug())
    name = F.when(is_single_link(), "item_item_type").when(is_many_links(), "items_item_type").when(F.col("type") == "RichText", "structured_text_links")
    inner = F.when(F.col("type") == "RichText", F.array(F.lit(block)) if block else F.array().cast("array<string>"))
    out = rows.select(
        "type_id", "field_id", F.col("name").alias("label"), names.field_key(F.col("field_id")).alias("api_key"), target.alias("field_type"), F.coalesce("localized", F.lit(False)).alias("localized"), "position",
        name.alias("validator"), inner.alias("blocks"), F.when(is_title(), TITLE_EDITOR).alias("appearance"),
    )
    return out.join(linked_models(fields(types), made), ["type_id", "field_id"], "left")


def tracked(rows: DataFrame, created: DataFrame) -> DataFrame:
    """``rows`` (type_id, tracking, ...) and title_field_id: the id of the created field (type_id, field_id, id) that a slug follows."""
    of = created.select("type_id", F.col("field_id").alias("tracking"), F.col("id").alias("title_field_id"))
    return rows.join(of, ["type_id", "tracking"], "left")


def must_have(rows: DataFrame, created: DataFrame) -> DataFrame:
    """``rows`` (type_id, field_id, ...) and the id of their created field; a field without one ends the job with an error."""
    found = rows.join(created.select("type_id", "field_id", "id"), ["type_id", "field_id"], "left")
    lost = F.raise_error(F.concat(F.lit("no field was made for "), "type_id", F.lit("."), "field_id")).cast("string")
    return found.withColumn("id", F.coalesce("id", lost))


def locales(rows: DataFrame) -> DataFrame:
    """One row (codes, default_locale) of the locales (code, is_default, ord): all codes in order, and the first default."""
    codes = F.transform(F.array_sort(F.collect_list(F.struct("ord", "code"))), lambda x: x["code"])
    return rows.agg(codes.alias("codes"), F.min_by("code", F.when(F.col("is_default"), F.col("ord"))).alias("default_locale"))


def _stored(value: Column, target: Column) -> Column:
    """A value as JSON, as its target type stores it; a falsy one is null."""
    text = etl.value_text(target, value)
    return F.when(truthy(value), F.when((target == "string") & F.startswith(value, F.lit("[")), json_string(text)).otherwise(text))


def _rewritten(rows: DataFrame, pairs: DataFrame, codes: list[str], default_locale: str) -> DataFrame:
    """``rows`` (content, fields, ...) and __texts: a map of field and locale to the JSON of each text, rewritten by ``pairs``.

    The first occurrence of each old string is replaced, in the text that the JSON stands for.
    """
    asked = lambda f: F.when(f["localized"], F.array(*map(F.lit, codes))).otherwise(F.array(F.lit(default_locale)))
    texts = F.filter("fields", lambda f: f["field_type"] == "text")
    keys = F.flatten(F.transform(texts, lambda f: F.transform(asked(f), lambda c: F.struct(f["field_id"].alias("field"), c.alias("locale")))))
    found = F.transform(keys, lambda k: F.struct(k.alias("key"), F.try_element_at(F.try_element_at("content", k["field"]), k["locale"]).alias("json")))
    found = F.filter(found, lambda x: F.startswith(x["json"], F.lit('"')))
    plain = F.transform(found, lambda x: F.get(F.from_json(F.concat(F.lit("["), x["json"], F.lit("]")), "array<string>"), F.lit(0)))
    out = rewrite(rows.withColumn("__keys", F.transform(found, lambda x: _text_key(x["key"]["field"], x["key"]["locale"]))).withColumn("__plain", plain), ["__plain"], pairs, every=False, fold=False)
    return out.withColumn("__texts", F.map_from_arrays("__keys", F.transform("__plain", json_string))).drop("__keys", "__plain")


def _text_key(field: Column, locale: Column) -> Column:
    return F.concat(field, F.lit("\0"), locale)


def records(entries: DataFrame, described: DataFrame, codes: list[str], default_locale: str, pairs: DataFrame | None = None) -> DataFrame:
    """(entry_id, type_id, created_at, first_published_at, status, has_links, attributes): a record for each entry of a type with fields.

    attributes maps keys to JSON: localised ones are objects of all locales. Links are empty until they are resolved. With
    ``pairs`` (old, new, ord), old and new addresses of uploads, the first occurrence of each old one in a text is replaced.
    """
    per_type = described.groupBy("type_id").agg(F.collect_list(F.struct("field_id", "api_key", "field_type", "localized")).alias("fields"))
    rows = entries.join(per_type, "type_id")
    value = plain = lambda f, locale: F.try_element_at(F.try_element_at("content", f["field_id"]), F.lit(locale))
    if pairs is not None:
        rows = _rewritten(rows, pairs, codes, default_locale)
        value = lambda f, locale: F.when(f["field_type"] == "text", F.coalesce(F.try_element_at("__texts", _text_key(f["field_id"], F.lit(locale))), plain(f, locale))).otherwise(plain(f, locale))
    null = lambda c: F.coalesce(c, F.lit("null"))
    every = lambda f: json_object(F.create_map(*[x for c in codes for x in (F.lit(c), null(_stored(value(f, c), f["field_type"])))]))
    one = lambda f: F.when(f["localized"], every(f)).otherwise(null(_stored(value(f, default_locale), f["field_type"])))
    attributes = F.map_from_entries(F.transform("fields", lambda f: F.struct(f["api_key"], one(f))))
    return rows.select(
        "entry_id", "type_id", "created_at", "first_published_at", F.when(F.col("published_version").isNotNull(), "published").otherwise("draft").alias("status"),
        F.exists("fields", lambda f: is_link_type(f["field_type"])).alias("has_links"), attributes.alias("attributes"),
    )


def link_values(entries: DataFrame, described: DataFrame, made: DataFrame, uploads: DataFrame, codes: list[str], default_locale: str) -> DataFrame:
    """(entry_id, attributes): the links of each entry that has any, as JSON: ids of records, or uploads.

    ``made`` has (entry_id, id, model) of the records, ``uploads`` (asset_id, id). Only link fields with content are touched. A
    link to a record needs an allowed model; links in lists that lead nowhere are left out, order and repeats stay.
    """
    wanted = described.where(is_link_type(F.col("field_type")) & (F.col("field_type") != "structured_text"))
    wanted = wanted.select("type_id", "field_id", "api_key", "field_type", "localized", "unrestricted", "item_types")
    each = entries.select("entry_id", "type_id", F.explode("content").alias("field_id", "by_locale")).join(wanted, ["type_id", "field_id"])
    asked = F.when(F.col("localized"), F.array(*map(F.lit, codes))).otherwise(F.array(F.lit(default_locale)))
    each = each.withColumn("locale", F.explode(asked)).withColumn("value", F.try_element_at("by_locale", F.col("locale")))
    many = F.col("field_type").isin("links", "gallery")
    targets = F.when(many, F.from_json("value", "array<string>")).when(F.col("value").isNotNull(), F.array(F.element_at(F.from_json(F.concat(F.lit("["), "value", F.lit("]")), "array<string>"), 1)))
    key = ["entry_id", "api_key", "locale"]
    of_asset = F.col("field_type").isin("file", "gallery")
    links = each.select(*key, "field_type", "localized", "unrestricted", "item_types", of_asset.alias("of_asset"), F.posexplode_outer(targets).alias("at", "target"))
    ids = made.select(F.lit(False).alias("of_asset"), F.col("entry_id").alias("target"), "id", "model").unionByName(uploads.select(F.lit(True).alias("of_asset"), F.col("asset_id").alias("target"), "id", F.lit(None).cast("string").alias("model")))
    found = looked_up(links, ids)
    may = F.col("of_asset") | F.coalesce(F.col("unrestricted"), F.lit(True)) | F.array_contains(F.col("item_types"), F.col("model")) | (F.col("field_type") == "links")
    upload = F.concat(F.lit('{"upload_id":'), json_string(F.col("id")), F.lit(',"alt":null,"title":null,"custom_data":{}}'))
    shown = F.when(F.col("id").isNotNull() & F.coalesce(may, F.lit(False)), F.when(F.col("of_asset"), upload).otherwise(json_string(F.col("id"))))
    made_list = F.transform(F.array_sort(F.collect_list(F.when(shown.isNotNull(), F.struct("at", shown.alias("json"))))), lambda x: x["json"])
    per_locale = found.groupBy(*key, "field_type", "localized").agg(made_list.alias("all"))
    value = F.when(F.col("field_type").isin("links", "gallery"), json_array(F.col("all"))).otherwise(F.coalesce(F.get("all", F.lit(0)), F.lit("null")))
    per_field = per_locale.withColumn("value", value).groupBy("entry_id", "api_key", "localized").agg(F.map_from_entries(F.collect_list(F.struct("locale", "value"))).alias("by"))
    whole = F.when(F.col("localized"), json_object(F.col("by"))).otherwise(F.element_at(F.map_values("by"), 1))
    return per_field.groupBy("entry_id").agg(F.map_from_entries(F.collect_list(F.struct("api_key", whole))).alias("attributes"))


def looked_up(links: DataFrame, ids: DataFrame) -> DataFrame:
    """``links`` (entry_id, of_asset, target, ...) and the id and model of their target in ``ids``; null if there is none.

    All links to one target would be in one task. Those to the commonest targets get theirs from a broadcast of HOT targets at
    most and are shuffled by entry, as those without a target are. What counts as common only says how a link is looked up.
    The links are stored once for both.
    """
    spark, path = links.sparkSession, new_path(links.sparkSession)
    links.write.parquet(path)
    links = spark.read.schema(links.schema).parquet(path)
    name = F.concat(F.when(F.col("of_asset"), "a").otherwise("r"), "target")
    top = links.where("target is not null").select(name.alias("name")).agg(F.expr(f"approx_top_k(name, {HOT})").alias("top")).first()["top"]
    top = spark.createDataFrame([(t["item"], True) for t in top], "__name string, __hot boolean")
    there = ids.withColumn("__name", name).join(F.broadcast(top), "__name").select("__name", F.col("id").alias("__id"), F.col("model").alias("__model"))
    out = links.withColumn("__name", name).join(F.broadcast(top.join(F.broadcast(there), "__name", "left")), "__name", "left")
    apart = F.coalesce("__hot", F.col("target").isNull())
    out = out.withColumns({"__apart": apart, "__to": F.when(apart, F.col("entry_id")).otherwise(F.col("target"))})
    others = ids.select("of_asset", F.lit(False).alias("__apart"), F.col("target").alias("__to"), "id", "model")
    found = out.join(others, ["of_asset", "__apart", "__to"], "left").withColumns({"id": F.coalesce("__id", "id"), "model": F.coalesce("__model", "model")})
    return found.drop("__name", "__hot", "__id", "__model", "__apart", "__to")


def updated(rows: DataFrame, links: DataFrame) -> DataFrame:
    """Records after the second pass: attributes with their links (entry_id, attributes), which count where both have a key."""
    more = links.select("entry_id", F.col("attributes").alias("__links"))
    out = rows.join(more, "entry_id", "left")
    return out.withColumn("attributes", F.when(F.col("__links").isNotNull(), overlay(F.col("attributes"), F.col("__links"))).otherwise(F.col("attributes"))).drop("__links")

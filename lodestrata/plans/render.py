"""A change plan as text: ids of re-created entities become lookups, each call a line, with comments that say what it is about."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.canonical import json_array, json_object, json_string, survives
from ..functions.names import camel_case, upper_first
from ..operators.joins import wide

# Names of references, and the kind that each points to.
REFERENCES = {
    "ordering_field": "field", "title_field": "field", "image_preview_field": "field", "excerpt_field": "field", "presentation_image_field": "field",
    "presentation_title_field": "field", "item_type": "item_type", "item_type_filter": "item_type_filter", "workflow": "workflow", "fieldset": "fieldset",
}
# Validators that list models.
MODEL_LISTS = (
    "rich_text_blocks", "single_block_blocks", "structured_text_blocks", "structured_text_inline_blocks", "structured_text_links", "item_item_type", "items_item_type",
)
# What a field type is called.
FIELD_TYPES = {
    "boolean": "Boolean", "color": "Color", "date": "Date", "date_time": "DateTime", "file": "Single asset", "float": "Floating-point number", "gallery": "Asset gallery",
    "image": "Image", "integer": "Integer number", "json": "JSON", "lat_lon": "Geolocation", "link": "Single link", "links": "Multiple links",
    "rich_text": "Modular Content (Multiple blocks)", "single_block": "Modular Content (Single block)", "seo": "SEO meta tags", "slug": "Slug", "string": "Single-line string",
    "structured_text": "Structured text", "text": "Multiple-paragraph text", "video": "External video",
}
# What can be done to each kind of entity.
CALLS = {
    k: ("create", "update", "destroy")
    for k in ("workflow", "plugin", "upload_filter", "item_type", "field", "fieldset", "item_type_filter", "menu_item", "schema_menu_item")
} | {"site": ("update",), "role": ("update",)}
_CALL = ("phase", "stage", "ord", "step", "entity_id", "call")


def lookup(kind: Column, id_: Column) -> Column:
    """Where a script finds what an entity was made into."""
    return F.concat(F.lit("new"), upper_first(camel_case(kind)), F.lit("s["), json_string(id_), F.lit("]"))


def remap(rows: DataFrame, recreated: DataFrame, kind: str, id_: str, name: str = "new_id") -> DataFrame:
    """``rows`` and ``name``: the lookup of an id that is in ``recreated`` (kind, id), else the id."""
    made = recreated.where(F.col("kind") == kind).select(F.col("id").alias(id_), F.lit(True).alias("__made"))
    return rows.join(made, id_, "left").withColumn(name, F.when(F.col("__made"), F.concat(F.lit(f"new.{kind}["), id_, F.lit("]"))).otherwise(F.col(id_))).drop("__made")


def _parsed(text: Column) -> Column:
    """A JSON object as a map of name to canonical JSON; null if it is none."""
    return F.transform_values(F.from_json(text, "map<string,variant>"), lambda _, v: F.coalesce(F.to_json(v), F.lit("null")))


def _plain(text: Column) -> Column:
    """The text of a JSON string."""
    return F.element_at(F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>"), 1)


def _id(kind: Column, id_: Column) -> Column:
    return F.struct(kind.alias("kind"), id_.alias("id"))


def _rule_lists(attributes: Column) -> Column:
    """The names of the lists of rules among a role's changes."""
    return F.filter(F.map_keys(attributes), lambda k: k.rlike(r"_item_type_permissions\.(add|remove)$"))


def mentioned(plan: DataFrame) -> Column:
    """The entities (kind, id) that a call's attributes and relationships mention, each once."""
    validators = _parsed(F.try_element_at("attributes", F.lit("validators")))
    lists = F.array(*map(F.lit, MODEL_LISTS))
    inner = lambda name: F.try_element_at(validators, name)
    models = F.flatten(F.transform(lists, lambda n: F.coalesce(F.from_json(F.get_json_object(inner(n), "$.item_types"), "array<string>"), F.array().cast("array<string>"))))
    title = F.get_json_object(inner(F.lit("slug_title_field")), "$.title_field_id")
    appearance = F.try_element_at("attributes", F.lit("appearance"))
    addons = F.from_json(F.get_json_object(appearance, "$.addons"), "array<struct<id:string>>")
    plugins = F.concat(F.array(F.get_json_object(appearance, "$.editor")), F.coalesce(F.transform(addons, lambda a: a["id"]), F.array().cast("array<string>")))
    rules = F.flatten(F.transform(_rule_lists(F.col("attributes")), lambda k: F.from_json(F.element_at("attributes", k), "array<struct<item_type:string,workflow:string>>")))
    kinds = F.create_map(*[F.lit(x) for kv in REFERENCES.items() for x in kv])
    kind = lambda e: F.when(e["key"] == "parent", F.coalesce(F.get_json_object(e["value"], "$.data.type"), F.split_part("call", F.lit("."), F.lit(1)))).otherwise(F.try_element_at(kinds, e["key"]))
    links = F.transform(F.map_entries("relationships"), lambda e: _id(kind(e), F.get_json_object(e["value"], "$.data.id")))
    of = lambda kind, ids: F.transform(ids, lambda x: _id(F.lit(kind), x))
    role_ids = F.concat(F.transform(rules, lambda r: _id(F.lit("item_type"), r["item_type"])), F.transform(rules, lambda r: _id(F.lit("workflow"), r["workflow"])))
    every = F.concat(of("item_type", models), of("field", F.array(title)), of("plugin", plugins), role_ids, links)
    return F.array_distinct(F.filter(every, lambda x: x["id"].isNotNull() & x["kind"].isNotNull()))


def remap_references(plan: DataFrame, recreated: DataFrame) -> DataFrame:
    """``plan`` with lookups in place of the ids of re-created entities, wherever a call mentions them.

    That is in relationships, in the validators that list models or name a title field, in a field's editor and addons, and in
    the models and workflows of a role's rules. One join finds all; calls that mention none stay as they are.
    """
    call = F.struct(*_CALL)
    each = plan.select(call.alias("__call"), F.explode(mentioned(plan)).alias("__what"))
    made = recreated.where(~survives(F.col("id"))).select(_id(F.col("kind"), F.col("id")).alias("__what")).distinct()
    found = each.join(made, "__what").groupBy("__call").agg(F.collect_set("__what").alias("__found"))
    rows = plan.withColumn("__call", call).join(found, "__call", "left").withColumn("__found", F.coalesce("__found", F.slice(F.array(_id(F.lit(""), F.lit(""))), 1, 0)))
    there = lambda kind, id_: F.array_contains(F.col("__found"), _id(kind, id_))
    known = lambda kind, text: F.when(there(F.lit(kind), _plain(text)), lookup(F.lit(kind), _plain(text))).otherwise(text)

    def in_validator(name: Column, text: Column) -> Column:
        inner = _parsed(text)
        models = F.transform(F.from_json(F.try_element_at(inner, F.lit("item_types")), "array<string>"), lambda x: F.when(there(F.lit("item_type"), x), lookup(F.lit("item_type"), x)).otherwise(json_string(x)))
        listed = F.transform_values(inner, lambda k, v: F.when((k == "item_types") & models.isNotNull(), json_array(models)).otherwise(v))
        titled = F.transform_values(inner, lambda k, v: F.when(k == "title_field_id", known("field", v)).otherwise(v))
        return F.when(name.isin(*MODEL_LISTS), json_object(listed)).when(name == "slug_title_field", json_object(titled)).otherwise(text)

    def in_appearance(text: Column) -> Column:
        addons = lambda v: json_array(F.transform(F.from_json(v, "array<map<string,variant>>"), lambda a: json_object(F.transform_values(a, lambda k, x: F.when(k == "id", known("plugin", F.to_json(x))).otherwise(F.to_json(x))))))
        return json_object(F.transform_values(_parsed(text), lambda k, v: F.when(k == "editor", known("plugin", v)).when(k == "addons", addons(v)).otherwise(v)))

    def in_rules(text: Column) -> Column:
        one = lambda k, x: F.when(k == "item_type", known("item_type", x)).when(k == "workflow", known("workflow", x)).otherwise(x)
        return json_array(F.transform(F.from_json(text, "array<map<string,variant>>"), lambda r: json_object(F.transform_values(r, lambda k, v: one(k, F.to_json(v))))))

    def attribute(k: Column, v: Column) -> Column:
        named = json_object(F.transform_values(_parsed(v), in_validator))
        return F.when(k == "validators", named).when(k == "appearance", in_appearance(v)).when(k.rlike(r"_item_type_permissions\.(add|remove)$"), in_rules(v)).otherwise(v)

    kinds = F.create_map(*[F.lit(x) for kv in REFERENCES.items() for x in kv])
    kind = lambda k, v: F.when(k == "parent", F.coalesce(F.get_json_object(v, "$.data.type"), F.split_part("call", F.lit("."), F.lit(1)))).otherwise(F.try_element_at(kinds, k))
    target = lambda v: F.get_json_object(v, "$.data.id")
    some = F.size("__found") > 0
    out = rows.withColumns({
        "attributes": F.when(some, F.transform_values("attributes", attribute)).otherwise(F.col("attributes")),
        "relationships": F.when(some, F.transform_values("relationships", lambda k, v: F.when(there(kind(k, v), target(v)), lookup(kind(k, v), target(v))).otherwise(v))).otherwise(F.col("relationships")),
    })
    return out.drop("__call", "__found")


def statement(plan: DataFrame) -> Column:
    """One line of text for a call: name(id, {sorted attributes}, {sorted relationships})."""
    body = lambda m: F.array_join(F.transform(F.array_sort(F.map_entries(m)), lambda e: F.concat_ws(": ", e["key"], e["value"])), ", ")
    return F.concat(F.col("call"), F.lit("("), "entity_id", F.lit(", {"), body("attributes"), F.lit("}, {"), body("relationships"), F.lit("})"))


def assigned(plan: DataFrame) -> Column:
    """A call's line; what is created under another id is noted under its old one. A call that there isn't ends the job with an error."""
    known = F.col("call").isin(*[f"{k}.{c}" for k, calls in CALLS.items() for c in calls])
    unknown = F.raise_error(F.concat(F.lit("no such call: "), "call")).cast("string")
    noted = F.endswith("call", F.lit(".create")) & ~survives(F.col("entity_id"))
    return F.concat(F.when(noted, F.concat(lookup(F.col("kind"), F.col("entity_id")), F.lit(" = "))).otherwise(""), F.when(known, statement(plan)).otherwise(unknown))


def script(plan: DataFrame) -> DataFrame:
    """(phase, stage, ord, step, line): the lines of a script, declarations of what will be noted in phase 0."""
    from .diff import recreated

    made = recreated(plan)
    declared = made.select("kind").distinct().select(F.lit(0).alias("phase"), F.lit(0).alias("stage"), F.lit(0).cast("long").alias("ord"), F.lit(0).cast("long").alias("step"), F.concat(F.lit("const new"), upper_first(camel_case(F.col("kind"))), F.lit("s = {};")).alias("line"))
    rows = remap_references(plan, made)
    return declared.unionByName(rows.select("phase", "stage", "ord", "step", assigned(rows).alias("line")))


def title(kind: Column, attributes: Column) -> Column:
    """What an entity is called in a comment."""
    text = lambda name: _plain(F.try_element_at(attributes, F.lit(name)))
    quoted = lambda before, name: F.concat(F.lit(f'{before} "'), text(name), F.lit('"'))
    types = F.create_map(*[F.lit(x) for kv in FIELD_TYPES.items() for x in kv])
    key = F.concat(F.lit(" (`"), text("api_key"), F.lit("`)"))
    block = F.coalesce(F.try_element_at(attributes, F.lit("modular_block")), F.lit("false")) == "true"
    entry = F.concat(F.when(text("kind") == "item_type", "model").otherwise("block"), quoted(" schema menu item", "label"))
    return (
        F.when(kind == "item_type", F.concat(F.when(block, "block model").otherwise("model"), quoted("", "name"), key))
        .when(kind == "field", F.concat(F.try_element_at(types, text("field_type")), quoted(" field", "label"), key))
        .when(kind == "fieldset", quoted("fieldset", "title")).when(kind == "menu_item", quoted("menu item", "label")).when(kind == "schema_menu_item", entry)
        .when(kind == "item_type_filter", quoted("filter", "name")).when(kind == "upload_filter", quoted("Media Area filter", "name")).otherwise(F.concat(kind, quoted("", "name")))
    )


def comments(plan: DataFrame, old: DataFrame, new: DataFrame) -> DataFrame:
    """``plan`` and message: what each call does, to what, and in or of which model.

    What is destroyed and its model are looked up in the old catalog, everything else in the new one. A schema menu entry that
    stands for a model is named by that.
    """
    from .diff import _linked

    sides = []
    for gone, snapshot in ((True, old), (False, new)):
        rows = snapshot.select("kind", F.col("id").alias("entity_id"), "attributes", F.coalesce("owner", _linked("item_type")).alias("model_id"))
        models = snapshot.where("kind = 'item_type'").select(F.col("id").alias("model_id"), title(F.col("kind"), F.col("attributes")).alias("model"))
        sides.append(rows.join(wide(models), "model_id", "left").select(F.lit(gone).alias("gone"), "kind", "entity_id", title(F.col("kind"), F.col("attributes")).alias("title"), "model"))
    named = sides[0].unionByName(sides[1])
    verb = F.split_part("call", F.lit("."), F.lit(2))
    rows = plan.withColumns({"gone": verb == "destroy", "verb": F.when(verb == "create", "Create ").when(verb == "destroy", "Delete ").otherwise("Update ")})
    rows = rows.join(wide(named), ["gone", "kind", "entity_id"], "left")
    entry = F.concat(F.element_at(F.split("title", " schema"), 1), F.lit(" schema menu item for "), "model")
    within = F.when(F.col("kind").isin("field", "fieldset"), F.concat(F.lit(" in "), "model")).when(F.col("kind") == "item_type_filter", F.concat(F.lit(" of "), "model"))
    what = F.when((F.col("kind") == "schema_menu_item") & F.col("model").isNotNull(), entry).otherwise(F.concat(F.col("title"), F.coalesce(within, F.lit(""))))
    return rows.withColumn("message", F.concat("verb", F.coalesce(what, "entity_id"))).select(*plan.columns, "message")


def write_script(plan: DataFrame, path: str) -> None:
    """The script's lines in order as text files; file names sort in the order of the plan."""
    script(plan).orderBy("phase", "stage", "ord", "step").select(F.col("line").alias("value")).write.text(path)

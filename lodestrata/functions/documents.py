"""Structured text as a table of nodes: what becomes of each node that points to another record or asset.

A document of any depth is rows (document, path, type, target); only the node and its parent's kind decide, so the rewriting is
one join for the targets and one CASE. Documents are taken apart as variants and put together from the texts of their nodes in
order: all of it is built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.joins import resolve

# The source's node types, and the parents whose children may be inline.
INLINE_ENTRY, BLOCK_ENTRY, ENTRY_LINK, ASSET_LINK, BLOCK_ASSET = "embedded-entry-inline", "embedded-entry-block", "entry-hyperlink", "asset-hyperlink", "embedded-asset-block"
# What plain node types and marks become.
TYPES = {
    "document": "root", "paragraph": "paragraph", "blockquote": "blockquote", "hr": "thematicBreak", "text": "span", "hyperlink": "link", "list-item": "listItem", "ordered-list": "list",
    "unordered-list": "list", ENTRY_LINK: "itemLink", ASSET_LINK: "link",
}
STYLES = {"ordered-list": "numbered", "unordered-list": "bulleted"}
MARKS = {"bold": "strong", "italic": "emphasis", "underline": "underline", "code": "code"}
INLINE_PARENTS = ("paragraph", "heading", "link", "itemLink")
BLOCK_PARENTS = ("root",)


def outcome(kind: Column, parent: Column, found: Column, allowed: Column) -> Column:
    """The new type of a node: dropped, children (the node goes, what it holds stays), span (a placeholder) or a target type.

    ``found`` says that the target exists, ``allowed`` that its model may be linked here.
    """
    inline, block = parent.isin(*INLINE_PARENTS), parent.isin(*BLOCK_PARENTS)
    return (
        F.when(kind == INLINE_ENTRY, F.when(~found | ~allowed, "dropped").when(inline, "inlineItem").otherwise("span"))
        .when(kind == BLOCK_ENTRY, F.when(~found, "span").when(~allowed, "dropped").when(inline, "inlineItem").otherwise("paragraph>inlineItem"))
        .when(kind == ENTRY_LINK, F.when(found & inline, "itemLink").otherwise("children"))
        .when(kind == ASSET_LINK, F.when(~found, "dropped").when(inline, "link").otherwise("children"))
        .when(kind == BLOCK_ASSET, F.when(~found, "span").when(block, "block").otherwise("dropped"))
        .otherwise(kind)
    )


def rewrite(nodes: DataFrame, targets: DataFrame, models: tuple[str, ...] | None = None) -> DataFrame:
    """``nodes`` (document, path, type, parent, target) with new_type and new_target, by ``targets`` (source, id, model)."""
    found = resolve(nodes, targets.select("source", "id", "model"), "target", "source", "id")
    allowed = F.lit(True) if models is None else F.coalesce(F.col("model").isin(*models), F.lit(False))
    kind = outcome(F.col("type"), F.col("parent"), F.col("id").isNotNull(), allowed)
    linked = kind.isin("inlineItem", "paragraph>inlineItem", "itemLink", "link", "block")
    return found.select("document", "path", "type", kind.alias("new_type"), F.when(linked, F.col("id")).alias("new_target"))


_STRING = lambda v, at: F.try_variant_get(v, at, "string")
_MARKS = lambda v: F.transform(F.try_variant_get(v, "$.marks", "array<struct<type:string>>"), lambda m: m["type"])


#: How many levels the first pass looks at.
FIRST_LEVELS = 8


def _content(node: Column) -> Column:
    return F.coalesce(F.try_variant_get(node, "$.content", "array<variant>"), F.array().cast("array<variant>"))


def _named(names: dict[str, str], key: Column) -> Column:
    """What ``names`` has for a key, else null."""
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in names.items() for x in pair]), key)


def _is_code(node: Column) -> Column:
    """A paragraph that is one text in code only."""
    inner = _content(node)
    first = F.get(inner, 0)
    return F.coalesce((_STRING(node, "$.nodeType") == "paragraph") & (F.size(inner) == 1) & (_STRING(first, "$.nodeType") == "text") & (_MARKS(first) == F.array(F.lit("code"))), F.lit(False))


def _below(level: Column) -> Column:
    """The nodes one level deeper, as (path, parent, node)."""

    def children(n: Column) -> Column:
        kind = _STRING(n["node"], "$.nodeType")
        own = F.when(F.startswith(kind, F.lit("heading-")), "heading").otherwise(F.coalesce(_named(TYPES, kind), kind))
        kept = own.isin("root", "paragraph", "heading", "blockquote", "list", "listItem") | n["parent"].isin(*INLINE_PARENTS) & own.isin(*INLINE_PARENTS)
        inner = F.when(_is_code(n["node"]), F.array().cast("array<variant>")).otherwise(_content(n["node"]))
        return F.transform(inner, lambda c, at: F.struct(F.concat(n["path"], F.lpad(at.cast("string"), 8, "0")).alias("path"), F.when(kept, own).otherwise(n["parent"]).alias("parent"), c.alias("node")))

    return F.flatten(F.transform(level, children))


def flatten(docs: DataFrame) -> DataFrame:
    """The nodes (document, path, type, parent, target, data) of documents (document, body JSON); a path sorts as the document reads.

    parent is the new type of the nearest kept parent, data what stays of the node. A null or empty body has no nodes. Each row is
    parsed and taken apart in one projection, as many levels as the deepest document has: that is found first, in one pass over the
    documents for the first levels and one more each time their number has to double.
    """
    root = F.array(F.struct(F.lit("").alias("path"), F.lit("").alias("parent"), F.parse_json("body").alias("node")))
    rows, depth, deepest = docs.where("body <> ''").select("document", root.alias("level0")), 0, 0
    while deepest == depth:
        for depth in range(depth + 1, 2 * depth + FIRST_LEVELS + 1):
            rows = rows.withColumn(f"level{depth}", _below(F.col(f"level{depth - 1}")))
        deepest = rows.agg(F.max(F.greatest(*[F.when(F.size(f"level{n}") > 0, n).otherwise(0) for n in range(depth + 1)]))).first()[0] or 0
    nodes = rows.select("document", F.explode(F.concat(*[f"level{n}" for n in range(deepest + 1)])).alias("n")).select("document", "n.*", _is_code(F.col("n.node")).alias("code"))
    node, kind = F.col("node"), _STRING(F.col("node"), "$.nodeType")
    marks = F.filter(F.transform(_MARKS(node), lambda m: _named(MARKS, m)), lambda m: m.isNotNull())
    plain = lambda c: F.when(~F.col("code"), c)
    data = F.struct(
        F.when(F.col("code"), _STRING(node, "$.content[0].value")).alias("code"), F.when(F.startswith(kind, F.lit("heading-")), F.right(kind, F.lit(1)).cast("int")).alias("level"),
        plain(F.when(F.size(marks) > 0, marks)).alias("marks"), plain(_named(STYLES, kind)).alias("style"), plain(_STRING(node, "$.data.uri")).alias("url"), plain(_STRING(node, "$.value")).alias("value"),
    )
    return nodes.select("document", "path", F.when(F.col("code"), "code").otherwise(kind).alias("type"), "parent", plain(_STRING(node, "$.data.target.sys.id")).alias("target"), data.alias("data"))


def _quoted(text: Column) -> Column:
    """A text as a JSON string; null stays null."""
    whole = F.to_json(F.struct(text.alias("x")))
    return F.when(text.isNotNull(), F.substr(whole, F.lit(6), F.length(whole) - 6))


def _member(name: str, value: Column) -> Column:
    return F.concat(F.lit(f'"{name}":'), value)


#: Stands before every value in a list; no JSON text has it bare.
_NEXT = "\x01"
#: Sorts behind all digits, so that a node's end comes after all that it holds.
_END = "~"


def assemble(nodes: DataFrame) -> DataFrame:
    """(document, body): the new documents, from nodes (document, path, type, new_type, target_id, url, data, missing).

    A node is a text where it begins and one where it ends, which are put in a row by path. What is within a node that shows none
    of its children is left out: that is where more such nodes have begun than ended. A document goes through one shuffle.
    """
    new, kind, data = F.col("new_type"), F.col("type"), F.col("data")
    placeholder, item, block = (new == "span") & (kind != "text"), new.isin("inlineItem", "paragraph>inlineItem"), new == "block"
    shown = F.when(F.startswith(new, F.lit("heading-")), "heading").otherwise(F.coalesce(_named(TYPES, new), new))
    leaf = shown.isin("span", "code", "thematicBreak")
    url = F.when(kind == ASSET_LINK, F.coalesce("url", F.lit(""))).otherwise(data["url"])
    marks = F.concat(F.lit("["), F.array_join(F.transform(data["marks"], lambda m: _quoted(m)), ","), F.lit("]"))
    rest = F.concat(
        F.concat_ws(
            ",", _member("code", _quoted(data["code"])), F.when(new == "itemLink", _member("item", F.coalesce(_quoted(F.col("target_id")), F.lit("null")))), _member("level", data["level"].cast("string")),
            _member("marks", marks), _member("style", _quoted(data["style"])), _member("type", _quoted(shown)), _member("url", _quoted(url)), _member("value", _quoted(data["value"])),
        ),
        F.lit("}"),
    )
    target = _quoted(F.col("target_id"))
    inline = F.concat(F.lit('{"item":'), target, F.lit(',"type":"inlineItem"}'))
    begin = (
        F.when(new.isin("dropped", "children"), "")
        .when(placeholder, F.concat(F.lit(_NEXT + '{"type":"span","value":'), _quoted(F.col("missing")), F.lit("}")))
        .when(new == "inlineItem", F.concat(F.lit(_NEXT), inline))
        .when(item, F.concat(F.lit(_NEXT + '{"children":['), inline, F.lit('],"type":"paragraph"}')))
        .when(block, F.concat(F.lit(_NEXT + '{"item":{"attributes":{"file":{"upload_id":'), target, F.lit('}},"type":"item"},"type":"block"}')))
        .when(leaf, F.concat(F.lit(_NEXT + "{"), rest))
        .otherwise(_NEXT + '{"children":[')
    )
    shut = (new == "dropped") | placeholder | item | block | leaf
    end = F.when(shut | (new == "children"), "").otherwise(F.concat(F.lit("],"), rest))
    both = F.array(F.struct(F.col("path").alias("at"), begin.alias("part"), F.lit(0).alias("own"), shut.cast("int").alias("shut")), F.struct(F.concat("path", F.lit(_END)).alias("at"), end.alias("part"), shut.cast("int").alias("own"), (-shut.cast("int")).alias("shut")))
    events = nodes.select("document", F.inline(both))
    before = F.coalesce(F.sum("shut").over(Window.partitionBy("document").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    seen = events.select("document", "at", F.when(before - F.col("own") > 0, "").otherwise(F.col("part")).alias("part"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "part"))), lambda e: e["part"]), "")
    body = F.replace(F.replace(F.concat(F.lit("["), "text"), F.lit("[" + _NEXT), F.lit("[")), F.lit(_NEXT), F.lit(","))
    return seen.groupBy("document").agg(text.alias("text")).select("document", F.concat(F.lit('{"document":'), F.substr(body, F.lit(2)), F.lit(',"schema":"dast"}')).alias("body"))


def convert(docs: DataFrame, targets: DataFrame, models: tuple[str, ...] | None = None) -> DataFrame:
    """(document, body): documents (document, body JSON) with their links to ``targets`` (source, id, model, url) rewritten.

    Where a target is missing, a span says so.
    """
    nodes = flatten(docs)
    found = resolve(nodes, targets.select("source", F.col("id").alias("target_id"), "model", "url"), "target", "source", "target_id")
    allowed = F.lit(True) if models is None else F.coalesce(F.col("model").isin(*models), F.lit(False))
    kind = outcome(F.col("type"), F.col("parent"), F.col("target_id").isNotNull(), allowed)
    missing = F.concat(F.lit("** missing or inaccessible: "), F.coalesce("target", F.lit("")), F.lit(" **"))
    return assemble(found.select("document", "path", "type", kind.alias("new_type"), "target_id", "url", "data", missing.alias("missing")))

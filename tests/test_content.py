"""Imports, scripts, plans and sources on small hand-made data."""

from __future__ import annotations

import json
import random
import shutil

import pytest
from pyspark.sql import functions as F

from lodestrata.functions import canonical, documents, names
from lodestrata.operators import graph, moves
from lodestrata.operators.order import numbered
from lodestrata.plans import content, diff, posts, render, search
from lodestrata.sources import paged, settings, sinks, snapshots

ENTITY = "kind string, id string, ord long, owner string, attributes map<string,string>, relationships map<string,string>, meta map<string,string>"


def entities(spark, *rows):
    """Rows of (kind, id, attributes, relationships, meta, owner)."""
    full = [(r[0], r[1], n, (r[5:] or [None])[0], *(list(r[2:5]) + [{}, {}, {}])[:3]) for n, r in enumerate(rows)]
    return spark.createDataFrame(full, ENTITY)


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_reordered_keys_are_no_change(spark):
    old = entities(spark, ("workflow", "1", {"stages": '{"a":1,"b":2.0}', "list": "[1,2]"}))
    new = entities(spark, ("workflow", "1", {"stages": '{ "b": 2, "a": 1 }', "list": "[2,1]"}))
    plan = diff.Simple(2, "workflow").plan(old, new).collect()
    assert [(r.call, dict(r.attributes)) for r in plan] == [("workflow.update", {"list": "[2,1]"})]


def test_snapshots_are_canonical(spark, tmp_path):
    snapshots.save(entities(spark, ("site", "1", {"x": '{"b":1,"a":[1.0]}'})), f"{tmp_path}/s", "main")
    assert dict(snapshots.load(spark, f"{tmp_path}/s", "main").first().attributes) == {"x": '{"a":[1],"b":1}'}


def test_created_plugins(spark):
    a = {"name": '"n"', "package_version": '"1"', "field_types": "[]", "plugin_type": "null", "parameter_definitions": "{}", "parameters": "{}"}
    new = entities(spark, ("plugin", "1", a | {"package_name": "null"}, {}, {"version": '"2"'}), ("plugin", "2", a | {"package_name": '"p"', "parameters": "null"}, {}, {"version": '"2"'}), ("plugin", "3", a, {}, {"version": '"1"'}))
    rows = diff.plugins(new.where("false"), new).orderBy("ord", "step").collect()
    assert [(r.entity_id, r.step, sorted(r.attributes)) for r in rows] == [
        ("1", 0, ["name", "package_name", "package_version"]), ("2", 0, ["package_name"]), ("2", 1, ["parameters"]), ("3", 0, ["field_types", "name", "package_version", "parameter_definitions", "plugin_type"]),
    ]


def test_roles_keep_their_values(spark):
    rules = [{"environment": "2024", "item_type": "123", "action": 'a"b', "n": 5, "x": {"k": [1, "2"]}}, {"environment": "main", "item_type": "123", "action": "all"}, {"environment": "main", "item_type": 123, "action": "all"}, {"environment": "2024", "item_type": "123", "action": "all", "workflow": None, "on": False, "zero": 0}]
    new = entities(spark, ("role", "r", {"positive_item_type_permissions": json.dumps(rules), "name": '"x"'}), ("role", "same", {"negative_upload_permissions": '[{"environment":"2024","a":1},{"environment":"main","a":1.0}]'}))
    rows = diff.roles(new, "main", "2024").collect()
    assert [r.entity_id for r in rows] == ["r"]
    got = {k: json.loads(v) for k, v in rows[0].attributes.items()}
    assert got == {"positive_item_type_permissions.add": [{"action": 'a"b', "item_type": "123", "n": 5, "x": {"k": [1, "2"]}}], "positive_item_type_permissions.remove": [{"action": "all", "item_type": 123}]}


def test_zero_in_any_form_is_falsy(spark):
    assert [one(spark, canonical.truthy(F.lit(x))) for x in ("0.0", "-0", "0e0", "0.5", "10")] == [False, False, False, True, True]


def slow_order(nodes, edges):
    left, out = dict(nodes), []
    live = {(s, d) for s, d in edges if s in left and d in left and s != d}
    while left:
        free = [n for n in left if not any(d == n and s in left for s, d in live)]
        if not free:
            return out + sorted(left, key=left.get)
        n = min(free, key=left.get)
        out.append(n)
        del left[n]
    return out


@pytest.mark.parametrize("seed", range(4))
def test_destroy_order_of_the_whole(spark, seed):
    """Parts put in order apart give the order of all, cycles last."""
    r = random.Random(seed)
    nodes = {f"n{k}": o for k, o in enumerate(r.sample(range(500), 60))}
    edges = [(f"n{r.randrange(60)}", f"n{r.randrange(60)}") for _ in range(30 + 12 * seed)] + [("gone", "n1")]
    keys = graph.destroy_keys(spark.createDataFrame(list(nodes.items()), "node string, ord long"), spark.createDataFrame(edges, "src string, dst string"))
    assert [row.node for row in keys.orderBy("left_over", "reach", "place").collect()] == slow_order(nodes, edges)


def test_components(spark):
    r = random.Random(3)
    edges = [(r.randrange(80), r.randrange(80)) for _ in range(60)] + [(100 + k, 101 + k) for k in range(30)] + [(7, 7)]
    parent = {n: n for e in edges for n in e}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    assert dict(map(tuple, graph.components(spark.createDataFrame(edges, "src long, dst long")).collect())) == {n: root(n) for n in parent}


def test_moves_of_separate_scopes(spark):
    old = {"a": ("", 1), "b": ("", 2), "c": ("a", 1), "d": ("a", 2), "e": ("a", 3), "f": ("b", 1)}
    new = {"a": ("", 1), "b": ("", 2), "e": ("a", 1), "c": ("a", 2), "d": ("a", 3), "f": ("b", 1)}
    side = lambda of: spark.createDataFrame([(k, s, p, n) for n, (k, (s, p)) in enumerate(of.items())], "key string, scope string, position int, ord int")
    scopes = {r.key: r.grp for r in diff._scopes(side(old), side(new)).collect()}
    assert scopes["c"] == scopes["d"] == scopes["e"] != scopes["f"] and scopes["a"] == scopes["b"]
    rows = moves.plan_groups(side(old).withColumn("grp", F.lit(1)), side(new).withColumn("grp", F.lit(1))).collect()
    assert [(r.key, r.scope, r.position, r.weight) for r in rows] == [("e", "a", 1, 2)]


def test_script(spark):
    new = entities(spark, ("workflow", "5", {"name": '"w"'}), ("workflow", "x" * 22, {"name": '"v"'}), ("item_type", "7", {"name": '"m"', "api_key": '"m"'}, {"workflow": '{"data":{"id":"5"}}'}))
    plan = diff.Simple(2, "workflow").plan(new.where("false"), new).unionByName(diff.new_models(new.where("false"), new))
    lines = [r.line for r in render.script(plan).orderBy("phase", "stage", "ord", "step", "line").collect()]
    assert lines == ["const newItemTypes = {};", "const newWorkflows = {};", 'newWorkflows["5"] = workflow.create(5, {name: "w"}, {})', f'workflow.create({"x" * 22}, {{name: "v"}}, {{}})', 'newItemTypes["7"] = item_type.create(7, {api_key: "m", name: "m"}, {workflow: newWorkflows["5"]})']
    rule = '[{"item_type":"7","workflow":"5","action":"x"}]'
    role = plan.limit(1).select(*[F.col(c) for c in plan.columns if c not in ("attributes", "kind", "call")], F.lit("role").alias("kind"), F.lit("role.update").alias("call"), F.create_map(F.lit("positive_item_type_permissions.add"), F.lit(rule)).alias("attributes")).select(*plan.columns)
    made = spark.createDataFrame([("item_type", "7"), ("workflow", "5")], "kind string, id string")
    assert render.remap_references(role, made).first().attributes == {"positive_item_type_permissions.add": '[{"action":"x","item_type":newItemTypes["7"],"workflow":newWorkflows["5"]}]'}


def test_titles_of_menu_entries(spark):
    new = entities(spark, ("item_type", "1", {"name": '"Post"', "api_key": '"post"', "modular_block": "false"}), ("schema_menu_item", "s", {"label": '"l"', "kind": '"item_type"', "position": "1"}, {"item_type": '{"data":{"id":"1"}}'}), ("schema_menu_item", "g", {"label": '"G"', "kind": '"item_type"', "position": "2"}))
    old = entities(spark, ("schema_menu_item", "s", {"label": '"k"', "kind": '"item_type"', "position": "1"}), ("plugin", "p", {"name": '"P"'}))
    plan = diff.menus(old, new, "schema_menu_item", 13).unionByName(diff.plugins(old, new))
    got = {r.entity_id: r.message for r in render.comments(plan, old, new).where("call not like '%.update' or size(attributes) > 0 and not map_contains_key(attributes, 'position')").collect()}
    assert got == {"s": 'Update model schema menu item for model "Post" (`post`)', "g": 'Create model schema menu item "G"', "p": 'Delete plugin "P"'}


def test_names(spark):
    case = {"new blog post": "newBlogPost", "Add URL_field 2": "addUrlField2", "already": "already"}
    assert {k: one(spark, names.camel_case(F.lit(k))) for k in case} == case
    assert one(spark, names.script_name(F.lit(17), F.lit("my script"), "js")) == "17_myScript.js" and one(spark, names.titleized(F.lit("featured_media"))) == "Featured Media"


def test_paged_source(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    pq.write_table(pa.table({"k": range(1037)}), f"{tmp_path}/t.parquet", row_group_size=90)
    paged.register(spark)
    for size, pages in ((100, 3), (7, 1000), (2000, 1), (90, 1)):
        df = spark.read.format("paged").option("path", f"{tmp_path}/t.parquet").option("pagesize", size).option("pages", pages).load()
        assert sorted(map(tuple, df.collect())) == [(k, k // size) for k in range(1037)]
    reader = paged.PagedReader({"path": f"{tmp_path}/t.parquet", "pages": "2"})
    assert [(p.number, p.rows, p.groups) for p in reader.partitions()][1] == (2, 200, [2, 3, 4])


def test_settings(spark, tmp_path):
    assert settings.read_settings(spark, f"{tmp_path}/none.json") is None
    (tmp_path / "good.json").write_text('{"profiles": {"default": {"logLevel": "NONE", "migrations": {"directory": "m"}}}}')
    assert settings.read_settings(spark, f"{tmp_path}/good.json").first().profiles["default"].migrations.directory == "m"
    (tmp_path / "bad.json").write_text('{"profiles": [1, 2]}')
    with pytest.raises(Exception):
        settings.read_settings(spark, f"{tmp_path}/bad.json").collect()
    (tmp_path / "api.json").write_text('[{"id": "item", "endpoints": [{"name": "find", "rawName": "rawFind", "entityIdPlaceholders": [":id"]}, {"name": "create", "rawName": "rawCreate", "requestBodyRequired": true, "entityIdPlaceholders": []}]}]')
    rows = settings.endpoints(settings.read_listing(spark, f"{tmp_path}/none.json", f"{tmp_path}/api.json")).collect()
    assert [(r.method, r.n_ids, r.needs_body) for r in rows] == [("find", 1, False), ("create", 0, True)]


def test_environments(spark, tmp_path):
    path = f"{tmp_path}/s"
    for env in ("main", "sandbox"):
        snapshots.save(entities(spark, ("site", "1", {"x": "1"}), ("plugin", "2", {"y": "2"})), path, env)
    snapshots.rename(spark, path, "sandbox", "next")
    snapshots.fork(spark, path, "next", "copy")
    snapshots.destroy(spark, path, "main")
    assert snapshots.listed(spark, path) == ["copy", "next"] and snapshots.load(spark, path, "copy").count() == 2


TYPES = [
    ("blogPost", "Blog post", "title", [
        dict(id="title", name="Title", type="Symbol", localized=True), dict(id="slug", name="Slug", type="Symbol"), dict(id="author", name="Author", type="Link", link="Entry", links=["person"]),
        dict(id="heroImage", name="Hero", type="Link", link="Asset"), dict(id="gallery", name="Gallery", type="Array", item_type="Link", item_link="Asset"), dict(id="number", name="Number", type="Number"),
        dict(id="integer", name="Integer", type="Integer"), dict(id="tags", name="Tags", type="Array", item_type="Symbol"), dict(id="location", name="Location", type="Location"),
    ]),
    ("person", "Person", "name", [dict(id="name", name="Name", type="Symbol")]),
    ("landingPage", "Landing page", "title", [dict(id="title", name="Title", type="Symbol"), dict(id="latestPosts", name="Latest", type="Array", item_type="Link", item_link="Entry"), dict(id="content", name="Content", type="RichText", blocks=[], inlines=None)]),
]
PARTS = ("id", "name", "type", "link", "localized", "required", "item_type", "item_link", "links", "item_links", "blocks", "inlines")


@pytest.fixture(scope="module")
def described(spark):
    types = spark.createDataFrame([(t, n, d, [tuple(f.get(k) for k in PARTS) for f in fields]) for t, n, d, fields in TYPES], f"type_id string, name string, display string, fields array<{content.FIELD}>")
    controls = spark.createDataFrame([("blogPost", 1, "slug", "slugEditor", "title"), ("blogPost", 2, "slug", "markdown", None)], "type_id string, ord int, field_id string, widget string, tracking string")
    made = spark.createDataFrame([("blogPost", "m1"), ("person", "m2"), ("landingPage", "m3")], "type_id string, id string")
    return types, content.describe(types, controls, made, "block").cache()


def test_described_fields(spark, described):
    types, rows = described
    assert sorted(r.api_key for r in content.models(types).collect()) == ["blog_post_model", "landing_page_model", "person_model"]
    got = {(r.type_id, r.field_id): r for r in rows.collect()}
    kinds = {k[1]: r.field_type for k, r in got.items() if k[0] == "blogPost"}
    assert kinds == {"title": "string", "slug": "slug", "author": "link", "heroImage": "file", "gallery": "gallery", "number": "float", "integer": "integer", "tags": "string", "location": "lat_lon"}
    assert got["blogPost", "author"].item_types == ["m2"] and got["blogPost", "heroImage"].api_key == "hero_image" and got["blogPost", "title"].appearance == content.TITLE_EDITOR
    assert got["landingPage", "latestPosts"].unrestricted and got["landingPage", "content"].item_types == [] and not got["landingPage", "content"].unrestricted and got["landingPage", "content"].blocks == ["block"]
    assert [r.position for r in rows.where("type_id = 'blogPost'").orderBy("position").collect()] == list(range(9))
    with pytest.raises(Exception, match="no field was made for blogPost"):
        content.must_have(rows.select("type_id", "field_id"), rows.where("type_id <> 'blogPost'").select("type_id", "field_id", F.lit("x").alias("id"))).collect()


def test_records_and_links(spark, described):
    _, rows = described
    en = lambda v: {"en-US": json.dumps(v)}
    posts_ = [
        ("hello", "blogPost", "2026-01-16T10:51:47.834Z", "2026-01-16T10:55:20.882Z", 3, {"title": {"en-US": '"Hello"', "it": '"Ciao Mondo!"'}, "slug": en("hello"), "author": en("anna"), "heroImage": en("pc"), "gallery": en(["beach", "lost"]), "number": en(1.4), "integer": en(12), "tags": en(["general", "javascript"]), "location": en({"lat": 52.52, "lon": 13.40495})}),
        ("static", "blogPost", "2026-01-16T10:50:37.536Z", None, None, {"title": en("Static sites are great"), "integer": en(0), "author": en("landing")}),
        ("landing", "landingPage", "d", "d", 1, {"latestPosts": en(["static", "none", "hello", "static"])}),
        ("anna", "person", "d", "d", 1, {"name": en("Anna")}),
    ]
    entries = spark.createDataFrame(posts_, "entry_id string, type_id string, created_at string, first_published_at string, published_version int, content map<string,map<string,string>>")
    got = {r.entry_id: r for r in content.records(entries, rows, ["en-US", "it"], "en-US").collect()}
    hello = {k: json.loads(v) for k, v in got["hello"].attributes.items()}
    assert got["hello"].status == "published" and got["static"].status == "draft" and got["hello"].has_links and not got["anna"].has_links
    assert hello["title"] == {"en-US": "Hello", "it": "Ciao Mondo!"} and hello["number"] == 1.4 and hello["integer"] == 12 and hello["tags"] == "general, javascript"
    assert hello["location"] == {"latitude": 52.52, "longitude": 13.40495} and hello["author"] is None and hello["gallery"] == []
    assert json.loads(got["static"].attributes["title"]) == {"en-US": "Static sites are great", "it": None} and got["static"].attributes["integer"] == "null"

    made = spark.createDataFrame([("hello", "r1", "m1"), ("static", "r2", "m1"), ("anna", "r3", "m2"), ("landing", "r4", "m3")], "entry_id string, id string, model string")
    uploads = spark.createDataFrame([("pc", "u1"), ("beach", "u2")], "asset_id string, id string")
    links = {r.entry_id: {k: json.loads(v) for k, v in r.attributes.items()} for r in content.link_values(entries, rows, made, uploads, ["en-US", "it"], "en-US").collect()}
    assert links["hello"]["author"] == "r3" and links["hello"]["hero_image"]["upload_id"] == "u1" and [u["upload_id"] for u in links["hello"]["gallery"]] == ["u2"]
    assert links["static"] == {"author": None} and links["landing"] == {"latest_posts": ["r2", "r1", "r2"]} and "anna" not in links


def rich(kind, *content_, value=None, marks=(), to=None, uri=None):
    data = ({"target": {"sys": {"id": to}}} if to else {}) | ({"uri": uri} if uri else {})
    return {"nodeType": kind, "data": data} | ({"value": value, "marks": [{"type": m} for m in marks]} if kind == "text" else {"content": list(content_)})


def test_structured_document(spark):
    text = lambda v, *m: rich("text", value=v, marks=m)
    body = rich(
        "document", rich("heading-1", text("Lorem Ipsum")), rich("paragraph", text("Lorem ipsum,", "bold"), text(" et dolore magna aliqua", "italic")), rich("embedded-entry-block", to="hello"),
        rich("paragraph", text('const foo = "bar";', "code")), rich("paragraph", text("Duis "), rich("entry-hyperlink", text("in"), to="anna"), text(" in voluptate")), rich("embedded-asset-block", to="pc"),
        rich("blockquote", rich("paragraph", text("Excepteur"))), rich("paragraph", rich("embedded-entry-inline", to="anna"), rich("embedded-entry-inline", to="lost")), rich("hr"),
        rich("paragraph", rich("asset-hyperlink", text("Asset hyperlink"), to="pc")), rich("ordered-list", rich("list-item", rich("paragraph", text("Sed"))), rich("list-item", rich("paragraph", text("Ut")))),
        rich("embedded-entry-block", to="lost"),
    )
    targets = spark.createDataFrame([("hello", "r1", "m1", None), ("anna", "r3", "m2", None), ("pc", "u1", None, "https://x/pc.png")], "source string, id string, model string, url string")
    docs = spark.createDataFrame([(1, json.dumps(body)), (2, None)], "document int, body string")
    out = documents.convert(docs, targets, ("m1", "m2")).collect()
    assert len(out) == 1
    root = json.loads(out[0].body)["document"]
    kinds = [n["type"] for n in root["children"]]
    assert kinds == ["heading", "paragraph", "paragraph", "code", "paragraph", "block", "blockquote", "paragraph", "thematicBreak", "paragraph", "list", "span"]
    c = root["children"]
    assert c[0] == {"type": "heading", "level": 1, "children": [{"type": "span", "value": "Lorem Ipsum"}]} and c[1]["children"][0] == {"type": "span", "marks": ["strong"], "value": "Lorem ipsum,"}
    assert c[2] == {"type": "paragraph", "children": [{"item": "r1", "type": "inlineItem"}]} and c[3] == {"code": 'const foo = "bar";', "type": "code"}
    assert c[4]["children"][1] == {"item": "r3", "type": "itemLink", "children": [{"type": "span", "value": "in"}]} and c[5]["item"]["attributes"] == {"file": {"upload_id": "u1"}}
    assert c[6]["children"][0]["type"] == "paragraph" and c[7] == {"type": "paragraph", "children": [{"item": "r3", "type": "inlineItem"}]}
    assert c[9]["children"] == [{"url": "https://x/pc.png", "type": "link", "children": [{"type": "span", "value": "Asset hyperlink"}]}]
    assert c[10]["style"] == "numbered" and [x["type"] for x in c[10]["children"]] == ["listItem", "listItem"] and c[11]["value"] == "** missing or inaccessible: lost **"


def rebuilt(node, targets, parent=""):
    """What becomes of a node, one after the other: a list of new nodes."""
    kind, data = node["nodeType"], node.get("data") or {}
    to = ((data.get("target") or {}).get("sys") or {}).get("id")
    content_ = node.get("content", [])
    if kind == "paragraph" and len(content_) == 1 and content_[0]["nodeType"] == "text" and [m["type"] for m in content_[0]["marks"]] == ["code"]:
        return [{"type": "code", "code": content_[0]["value"]}]
    own = "heading" if kind.startswith("heading-") else documents.TYPES.get(kind, kind)
    inline, found = parent in documents.INLINE_PARENTS, to in targets
    id_, model, url = targets.get(to, (None, None, None))
    kept = own in ("root", "paragraph", "heading", "blockquote", "list", "listItem") or inline and own in documents.INLINE_PARENTS
    inner = lambda: [x for c in content_ for x in rebuilt(c, targets, own if kept else parent)]
    missing, item = [{"type": "span", "value": f"** missing or inaccessible: {to or ''} **"}], {"type": "inlineItem", "item": id_}
    if kind == documents.INLINE_ENTRY:
        return [] if not found or model not in ("m1", "m2") else [item] if inline else missing
    if kind == documents.BLOCK_ENTRY:
        return missing if not found else [] if model not in ("m1", "m2") else [item] if inline else [{"type": "paragraph", "children": [item]}]
    if kind == documents.BLOCK_ASSET:
        return missing if not found else [{"type": "block", "item": {"type": "item", "attributes": {"file": {"upload_id": id_}}}}] if parent == "root" else []
    if kind == documents.ENTRY_LINK and not (found and inline) or kind == documents.ASSET_LINK and found and not inline:
        return inner()
    if kind == documents.ASSET_LINK and not found:
        return []
    out = {"type": own}
    if kind == "text":
        marks = [documents.MARKS[m["type"]] for m in node["marks"] if m["type"] in documents.MARKS]
        return [out | {"value": node["value"]} | ({"marks": marks} if marks else {})]
    if kind == "hr":
        return [out]
    more = {"level": int(kind[-1])} if own == "heading" else {"style": documents.STYLES[kind]} if kind in documents.STYLES else {}
    more |= {"item": id_} if kind == documents.ENTRY_LINK else {"url": url or ""} if kind == documents.ASSET_LINK else {"url": data["uri"]} if "uri" in data else {}
    return [out | more | {"children": inner()}]


def test_structured_documents_against_a_walk(spark):
    """Random documents, one of them 20 levels deep, with quotes, control characters and brackets in their texts; others without a body. No Python worker."""
    r = random.Random(5)
    values = ["plain", 'a "b" \\ c', "[,\x01[", "line\nbreak\ttab", "Ünïcode 😀", "", "~"]
    ids = ["t1", "t2", "t3", "t4", "lost"]
    kinds = ["paragraph", "blockquote", "heading-3", "ordered-list", "unordered-list", "list-item", "hyperlink", "table", "hr", documents.INLINE_ENTRY, documents.BLOCK_ENTRY, documents.ENTRY_LINK, documents.ASSET_LINK, documents.BLOCK_ASSET]

    def made(depth):
        if depth == 0 or r.random() < 0.3:
            return rich("text", value=r.choice(values), marks=r.sample(["bold", "code", "odd"], r.randrange(3)))
        kind = r.choice(kinds)
        return rich(kind, *[made(depth - 1) for _ in range(r.randrange(4))], to=r.choice(ids) if "-" in kind and "list" not in kind and "heading" not in kind else None, uri="https://x/?a=1&b" if kind == "hyperlink" else None)

    deep = rich("text", value="bottom")
    for n in range(19):
        deep = rich("blockquote" if n % 2 else "paragraph", rich("text", value=f"{n}"), deep)
    bodies = [rich("document", *[made(5) for _ in range(r.randrange(6))]) for _ in range(60)] + [rich("document", deep), rich("document")]
    targets = {"t1": ("r1", "m1", "https://x/1"), "t2": ("r2", "m2", None), "t3": ("r3", "m3", "https://x/3"), "t4": ('r"4', "m1", "")}
    table = spark.createDataFrame([(k, *v) for k, v in targets.items()], "source string, id string, model string, url string")
    docs = spark.createDataFrame([(n, json.dumps(b)) for n, b in enumerate(bodies)] + [(-1, None), (-2, "")], "document int, body string").repartition(3)
    out = documents.convert(docs, table, ("m1", "m2"))
    got = {row.document: json.loads(row.body) for row in out.collect()}
    assert got == {n: {"schema": "dast", "document": rebuilt(b, targets)[0]} for n, b in enumerate(bodies)}
    assert "Python" not in out._jdf.queryExecution().toString() and "Pandas" not in out._jdf.queryExecution().toString()
    assert documents.convert(docs.where("document = -1"), table).count() == 0


def test_blog(spark):
    category = [(1, "top", "top", "Some description.", 0), (2, "sub", "sub", "", 1), (3, "third", "third", "", 2), (4, "lone", "lone", "", None)]
    rows = spark.createDataFrame(category, "id long, name string, slug string, description string, parent long")
    made = spark.createDataFrame([(k, f"c{k}") for k in (1, 2, 3, 4)], "source long, id string")
    assert dict(map(tuple, posts.category_parents(rows, made).collect())) == {"c2": "c1", "c3": "c2"}
    models = spark.createDataFrame([(0, k, k.upper()) for k in posts.TARGETS], "site int, api_key string, id string")
    fields = {(r.model, r.api_key): r for r in posts.target_fields(models).collect()}
    assert len(fields) == 23 and json.loads(fields["wp_article", "tags"].validators)["items_item_type"]["item_types"] == ["WP_TAG"] and fields["wp_page", "featured_media"].label == "Main image"
    assert json.loads(fields["wp_author", "slug"].validators) == {"slug_title_field": {"title_field_id": "WP_AUTHOR.name"}} and "wysiwyg" in fields["wp_page", "content"].appearance


def test_sorts_and_details(spark):
    assert search.details("complete", ("validators",)) == {"validators"} and search.details("basic") == set() and search.details("complete") == set(search.DETAILS)
    rows = spark.createDataFrame([(1, True), (2, False)], "id int, modular_block boolean")
    assert [search.of_sort(rows, s).count() for s in ("all", "blocks_only", "models_only")] == [2, 1, 1]


def test_script_written(spark, tmp_path):
    new = entities(spark, ("workflow", "5", {"name": '"w"'}), ("workflow", "6", {"name": '"v"'}))
    path = f"{tmp_path}/out"
    render.write_script(diff.Simple(2, "workflow").plan(new.where("false"), new), path)
    assert [r.value.split("(")[0] for r in spark.read.text(path).collect()] == ["const newWorkflows = {};", 'newWorkflows["5"] = workflow.create', 'newWorkflows["6"] = workflow.create']
    shutil.rmtree(path)


def test_destroying_models(spark):
    fields = spark.createDataFrame([("f", ["a", "b"]), ("g", ["c"])], "id string, models array<string>")
    gone = spark.createDataFrame([("b",)], "model string")
    assert [tuple(r) for r in sinks.narrowed(fields, "id", "models", gone, "model").collect()] == [("f", 2, 1)]
    assert sinks.without(spark.createDataFrame([("a",), ("b",)], "model string"), gone, "model").count() == 1


def keys_of(spark, nodes, edges):
    keys = graph.destroy_keys(spark.createDataFrame(list(nodes.items()), "node string, ord long"), spark.createDataFrame(edges, "src string, dst string"))
    return [row.node for row in keys.orderBy("left_over", "reach", "place").collect()]


def test_destroy_order_of_one_connected_part(spark):
    """A dense graph without cycles, whose nodes wait for each other all the time, and a long chain against the order."""
    r = random.Random(11)
    names = [f"n{k}" for k in range(70)]
    nodes = dict(zip(names, r.sample(range(900), 70), strict=True))
    edges = [(names[a], names[b]) for a, b in (sorted(r.sample(range(70), 2)) for _ in range(160))]
    edges += [(names[k], names[k + 1]) for k in range(0, 60, 2)]
    assert keys_of(spark, nodes, edges) == slow_order(nodes, edges)
    chain = {f"c{k:03d}": 500 - k for k in range(200)}
    assert keys_of(spark, chain, list(zip(chain, list(chain)[1:], strict=False))) == list(chain)


def test_destroy_order_of_awkward_graphs(spark):
    """Ties in ord go by node; nothing at all; only a cycle with what hangs on it; repeated edges and edges to nowhere."""
    nodes = {"b": 1, "a": 1, "c": 0, "d": 2}
    assert keys_of(spark, nodes, [("d", "c"), ("d", "c"), ("x", "a"), ("a", "a")]) == ["a", "b", "d", "c"]
    assert keys_of(spark, nodes, [("a", "b"), ("b", "a"), ("b", "c"), ("c", "d"), ("a", "d")]) == ["c", "a", "b", "d"]
    empty = spark.createDataFrame([], "node string, ord long")
    assert graph.destroy_keys(empty, spark.createDataFrame([("a", "b")], "src string, dst string")).count() == 0


def test_running_numbers_over_ranges(spark):
    """One group that fills most ranges, many small ones, a null one: each counts from 1 without gaps."""
    rows = [(None if k % 7 == 0 else "hot" if k % 3 else f"g{k % 50}", k * 37 % 1000) for k in range(1000)]
    got = [tuple(x) for x in numbered(spark.createDataFrame(rows, "g string, v int").repartition(6), ["g"], "v", name="n").collect()]
    for group in {g for g, _ in rows}:
        assert [(v, n) for v, n in sorted((v, n) for g, v, n in got if g == group)] == list(zip(sorted(v for g, v in rows if g == group), range(1, 2000), strict=False))

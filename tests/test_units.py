"""Operators on small hand-made catalogs."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from lodestrata import registry
from lodestrata.functions import canonical, maps, names, text
from lodestrata.operators import graph, joins, moves, order
from lodestrata.plans import diff, ledger, render, search
from lodestrata.sources import paged, snapshots
from lodestrata.streaming import incremental

NONE = {}


def entities(spark, *rows):
    """Rows of (kind, id, ord, owner, attributes, relationships, meta)."""
    full = [(r + (None, NONE, NONE, NONE)[len(r) - 3 :]) if len(r) < 7 else r for r in rows]
    return spark.createDataFrame(full, "kind string, id string, ord long, owner string, attributes map<string,string>, relationships map<string,string>, meta map<string,string>")


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_canonical_json(spark):
    assert one(spark, canonical.canonical(F.lit('{"b": 1.0, "a": [2, 1]}'))) == one(spark, canonical.canonical(F.lit('{"a":[2,1],"b":1}')))
    assert one(spark, canonical.canonical(F.lit("[1, 2]"))) != one(spark, canonical.canonical(F.lit("[2, 1]")))
    assert [one(spark, canonical.truthy(F.lit(x))) for x in ("0", '""', "null", "false", None, "[]", '"0"')] == [False] * 5 + [True] * 2


def test_key_order(spark):
    keys = spark.createDataFrame([(k, n) for n, k in enumerate(["abc", "10", "9", "01", "x"])], "k string, n int")
    assert [r.k for r in keys.orderBy(*canonical.key_order(F.col("k"), F.col("n"))).collect()] == ["9", "10", "abc", "01", "x"]


@pytest.mark.parametrize(("query", "target", "score"), [("blog", "blog", 1000), ("bl", "blog_post", 502), ("post", "blog_post", 199), ("bgp", "blog_post", 3), ("blpo", "blog_post", 8), ("zz", "blog", 0), ("", "x", 0)])
def test_fuzzy_score(spark, query, target, score):
    assert one(spark, names.fuzzy_score(F.lit(query), F.lit(target))) == score


@pytest.mark.parametrize(("name", "key"), [("blogPost", "blog_post_model"), ("page_1", "page_model"), ("2 cool", "n_cool_model"), ("_a--b_", "a_b_model"), ("page", "page_model")])
def test_model_key(spark, name, key):
    assert one(spark, names.model_key(F.lit(name))) == key


def test_text_rewriting(spark):
    pairs = F.array(F.struct(F.lit("a").alias("old"), F.lit("bb").alias("new")), F.struct(F.lit("bb").alias("old"), F.lit("").alias("new")))
    assert one(spark, text.rewrite_first(F.lit("xaya"), pairs)) == "xya"
    assert one(spark, text.rewrite_all(F.lit("A.b a.B"), {"a.b": "$1\\"})) == "$1\\ $1\\"
    assert one(spark, text.content_md5(F.lit(' "abc" '))) == "abc" and one(spark, text.content_md5(F.lit('"a-1"'))) is None


def test_locale_nulls(spark):
    assert one(spark, maps.locale_nulls(F.array(F.lit("en")))) == "null"
    assert one(spark, maps.locale_nulls(F.array(F.lit("en"), F.lit("it")))) == '{"en":null,"it":null}'


def test_changed_keeps_missing_and_null_apart(spark):
    old, new = F.create_map(F.lit("a"), F.lit("1"), F.lit("gone"), F.lit("2")), F.create_map(F.lit("a"), F.lit("1"), F.lit("b"), F.lit("null"))
    assert one(spark, diff.changed(old, new)) == {"b": "null"}


def test_simple_plan(spark):
    old = entities(spark, ("workflow", "1", 1, None, {"name": '"a"', "x": "1"}), ("workflow", "2", 2, None, {"name": '"b"'}), ("workflow", "3", 3, None, {"name": '"c"'}))
    new = entities(spark, ("workflow", "2", 1, None, {"name": '"B"'}), ("workflow", "3", 2, None, {"name": '"c"'}), ("workflow", "x" * 22, 3, None, {"name": '"d"'}), ("workflow", "4", 4, None, {"name": '"e"'}))
    plan = diff.Simple(2, "workflow").plan(old, new)
    calls = [(r.call, r.entity_id) for r in plan.orderBy("stage", "ord").collect()]
    assert calls == [("workflow.destroy", "1"), ("workflow.create", "x" * 22), ("workflow.create", "4"), ("workflow.update", "2")]
    assert [tuple(r) for r in diff.recreated(plan).collect()] == [("workflow", "4")]
    lines = sorted(r[0] for r in plan.select(render.statement(plan)).collect())
    assert lines[-1] == 'workflow.update(2, {name: "B"}, {})'


def test_whole_plan(spark):
    ref = lambda i: f'{{"data":{{"id":"{i}"}}}}'
    model = lambda i, n, **r: ("item_type", i, n, None, {"name": f'"m{i}"', "modular_block": "false", "ordering_direction": "null"}, {k: ref(v) for k, v in r.items()}, NONE)
    field = lambda i, n, of, kind, pos, **r: ("field", i, n, of, {"field_type": f'"{kind}"', "position": str(pos), "hint": "null"}, {k: ref(v) for k, v in r.items()}, NONE)
    old = entities(spark, model("1", 1), model("2", 2), model("3", 3), field("10", 1, "1", "string", 1), field("11", 2, "1", "string", 2), field("12", 3, "1", "text", 3), field("20", 4, "2", "slug", 1))
    new = entities(
        spark, model("1", 1, ordering_field="11"), model("4", 2), field("12", 1, "1", "string", 1), field("10", 2, "1", "string", 2), field("13", 3, "1", "slug", 4), field("14", 4, "1", "string", 3),
        field("40", 5, "4", "string", 1), ("role", "r", 1, None, {"positive_item_type_permissions": '[{"environment":"new","item_type":"1"},{"environment":"old","item_type":"2"}]'}),
        ("menu_item", "m1", 1, None, {"label": '"a"', "position": "1"}), ("menu_item", "m2", 2, None, {"label": '"b"', "position": "1"}, {"parent": ref("m1")}, NONE),
    )
    edges = spark.createDataFrame([("2", "3"), ("3", "3")], "src string, dst string")
    plan = diff.change_plan(old, new, edges, "old", "new")
    rows = plan.orderBy("phase", "stage", "ord", "step").collect()
    of = lambda p: [(r.call, r.entity_id) for r in rows if r.phase == p]
    assert of(5) == [("item_type.create", "4")]
    assert {c for c in of(6)} == {("field.create", "40"), ("field.create", "14"), ("field.create", "13")} and of(6)[-1] == ("field.create", "13")
    assert of(7) == [("field.destroy", "11")]
    assert of(8)[0] == ("field.update", "12") and all(c[0] == "field.update" for c in of(8))
    assert of(9) == [("item_type.destroy", "2"), ("item_type.destroy", "3")]
    last = [r for r in rows if r.phase == 10]
    assert [(r.entity_id, sorted(r.attributes), sorted(r.relationships)) for r in last] == [("1", ["ordering_direction"], ["ordering_field"])]
    assert of(12)[:2] == [("menu_item.create", "m1"), ("menu_item.create", "m2")]
    role = [r for r in rows if r.phase == 14]
    assert len(role) == 1 and set(role[0].attributes) == {"positive_item_type_permissions.add", "positive_item_type_permissions.remove"}
    assert render.remap_references(plan, diff.recreated(plan)).count() == len(rows)


def test_deep_difference_keeps_repeats(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x"), (2, "x"), (3, "y")], "k int, v string")
    b = spark.createDataFrame([(2, "x")], "k int, v string")
    assert sorted(map(tuple, joins.deep_difference(a, b).collect()), key=str) == [(1, None), (1, None), (3, "y")]


def test_lists_of_links(spark):
    rows = spark.createDataFrame([(1, ["a", "z", "b", "a"]), (2, []), (3, None)], "id int, links array<string>")
    to = spark.createDataFrame([("a", "A"), ("b", "B")], "s string, t string")
    get = lambda holes: {r.id: r.links for r in joins.resolve_list(rows, "id", "links", to, "s", "t", holes).collect()}
    assert get(False) == {1: ["A", "B", "A"], 2: [], 3: []} and get(True) == {1: ["A", None, "B", "A"], 2: [], 3: []}
    free = {r.id: (r.unrestricted, r.links) for r in joins.allowed_or_all(rows, "id", "links", to, "s", "t").collect()}
    assert free == {1: (False, ["A", "B"]), 2: (True, None), 3: (True, None)}


def test_exact_else_fuzzy(spark):
    rows = spark.createDataFrame([(str(k), f"Blog {k}", f"b{k}.example", k) for k in range(30)], "id string, name string, domain string, ord int")
    assert [r.id for r in search.find_projects(rows, "7").collect()] == ["7"]
    assert search.find_projects(rows, "bl").count() == 20 and search.find_projects(rows, None, 5).count() == 5
    assert {r.score for r in order.top(rows, names.fuzzy_score(F.lit("Blog 1"), F.col("name")), None, "ord").limit(1).collect()} == {1000}


def test_closure_and_related(spark):
    blocks = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (4, 2)], "src int, dst int")
    start = spark.createDataFrame([(1,)], "node int")
    assert {r.node for r in graph.closure(start, blocks).collect()} == {1, 2, 3}
    links = spark.createDataFrame([(3, 9)], "src int, dst int")
    got = {r.node: r.reason for r in search.with_related(start, blocks, links, nested=True, referenced=True, embedding=True).collect()}
    assert got == {1: 0, 2: 1, 3: 1, 9: 2, 4: 3}


def test_depths_leave_cycles_out(spark):
    nodes = spark.createDataFrame([("a", None), ("b", "a"), ("c", "b"), ("d", "gone"), ("x", "y"), ("y", "x"), ("z", "y")], "id string, parent string")
    assert dict(map(tuple, graph.depths(nodes).collect())) == {"a": 0, "b": 1, "c": 2, "d": 0}


def test_destroy_order(spark):
    nodes = spark.createDataFrame([(0, n, k) for k, n in enumerate("cab")] + [(1, n, k) for k, n in enumerate("xyz")], "grp int, node string, ord int")
    edges = spark.createDataFrame([(0, "b", "c"), (0, "b", "c"), (0, "a", "a"), (1, "x", "y"), (1, "y", "x"), (1, "z", "x")], "grp int, src string, dst string")
    ranked = graph.destroy_order(nodes, edges).orderBy("grp", "rank").collect()
    assert "".join(r.node for r in ranked) == "abczxy"


def test_chain_ends(spark):
    p = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("x", "y"), ("y", "x")], "src string, dst string")
    assert dict(map(tuple, graph.chain_ends(p).collect())) == {"a": "d", "b": "d", "c": "d"}


def test_moves_arrive():
    r = random.Random(1)
    for _ in range(60):
        keys = [str(k) for k in range(r.randrange(1, 9))]

        def arranged(some):
            some = list(some)
            r.shuffle(some)
            return {k: ("", n) for n, k in enumerate(some, 1)}

        old, new = arranged(k for k in keys if r.random() < 0.8), arranged(k for k in keys if r.random() < 0.8)
        steps = moves.plan(old, new)
        assert moves.replay(old, new, steps) == new
        assert all(k in new for k, _, _ in steps)


def test_moves_of_a_tree(spark):
    old = spark.createDataFrame([(0, "a", "", 1, 1), (0, "b", "", 2, 2), (0, "c", "a", 1, 3)], "grp int, key string, scope string, position int, ord int")
    new = spark.createDataFrame([(0, "a", "", 2, 1), (0, "b", "", 1, 2), (0, "c", "b", 1, 3)], "grp int, key string, scope string, position int, ord int")
    steps = [(r.key, r.scope, r.position) for r in moves.plan_groups(old, new).orderBy("step").collect()]
    assert steps[0] == ("c", "b", 1) and len(steps) == 2


def test_ledger(spark, tmp_path):
    (tmp_path / "s").mkdir()
    for name in ("1_B.js", "10_a.ts", "9_a.js", "x.js", "3_c.md"):
        (tmp_path / "s" / name).write_text("//")
    found = ledger.scripts(spark, str(tmp_path / "s"))
    ran = []
    steps = {n: (lambda s, n=n: ran.append(n)) for n in ("1_B.js", "10_a.ts", "9_a.js")}
    path = str(tmp_path / "ledger")
    assert ledger.run(spark, found, path, steps, dry=True) == ["1_B.js", "10_a.ts", "9_a.js"] and ran == []
    steps["9_a.js"] = lambda s: 1 / 0
    with pytest.raises(ZeroDivisionError):
        ledger.run(spark, found, path, steps)
    steps["9_a.js"] = lambda s: ran.append("9")
    assert ledger.run(spark, found, path, steps) == ["9_a.js"] and ran == ["1_B.js", "10_a.ts", "9"]
    assert ledger.run(spark, found, path, steps) == []


def test_snapshots(spark, tmp_path):
    rows = entities(spark, ("field", "1", 1, "m", {"a": "1"}), ("item_type", "m", 1))
    path = str(tmp_path / "snap")
    snapshots.save(rows, path, "main")
    snapshots.fork(spark, path, "main", "copy")
    assert snapshots.load(spark, path, "copy").count() == 2 and snapshots.load(spark, path, "main", "field").first().attributes == {"a": "1"}
    assert snapshots.environments("new", "main") == ("new", "main") and snapshots.environments("a:b", "main") == ("a", "b")


def test_paged_source(spark):
    paged.register(spark)
    path = "/root/testdata/sf0.001/orders.parquet"
    df = spark.read.format("paged").option("path", path).option("pagesize", "400").load()
    pages = {r.page: r["count"] for r in df.groupBy("page").count().collect()}
    assert pages == {0: 400, 1: 400, 2: 400, 3: 300} and df.select("o_orderkey").distinct().count() == 1500


def test_incremental_load(spark, tmp_path):
    source, target, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k long, v string").write.parquet(source)
    for more in (None, [(2, "again"), (3, "c")]):
        if more:
            spark.createDataFrame(more, "k long, v string").write.mode("append").parquet(source)
        incremental.load(incremental.new_rows(spark, source, "k long, v string"), "k", target, check).awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(target).collect())) == [(1, "a"), (2, "b"), (3, "c")]


def test_registry(spark):
    rows = spark.createDataFrame([("a", 3), ("a", 5)], "s string, p int")
    assert registry.call("ORDER", "next-position", rows, "s", "p").first().next_position == 6
    assert any(name == "closure" for name, _, _ in registry.describe("graph"))
    with pytest.raises(LookupError):
        registry.call("graph", "nothing")
    with pytest.raises(TypeError):
        registry.call("graph", "closure", rows)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())

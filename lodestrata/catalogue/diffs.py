"""Diffs of two snapshots of the part catalog, and the projections and plans made from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import maps
from ..functions.canonical import canonical, key_order, survives
from ..operators import graph, joins, moves
from ..plans import diff, render
from ..session import table

_COLUMNS = ("p_name", "p_brand", "p_type", "p_size", "p_retailprice")
_OLD = "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part WHERE p_partkey % 10 <> 0"
_NEW = (
    "SELECT p_partkey, p_name, p_brand, CASE WHEN p_partkey % 11 = 0 THEN 'CHANGED' ELSE p_type END AS p_type, "
    "CASE WHEN p_partkey % 7 = 0 THEN p_size + 1 ELSE p_size END AS p_size, p_retailprice FROM part WHERE p_partkey % 10 <> 1"
)
_CTE = f"WITH o AS ({_OLD}), n AS ({_NEW})"


def _snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    part = table(spark, sf_dir, "part").select("p_partkey", *_COLUMNS)
    new = part.where("p_partkey % 10 <> 1").withColumns(
        {
            "p_size": F.when(F.col("p_partkey") % 7 == 0, F.col("p_size") + 1).otherwise(F.col("p_size")),
            "p_type": F.when(F.col("p_partkey") % 11 == 0, "CHANGED").otherwise(F.col("p_type")),
        }
    )
    return part.where("p_partkey % 10 <> 0"), new


def _entities(part: DataFrame) -> DataFrame:
    """Parts as catalog entities with open attributes."""
    attributes = F.create_map(*[x for c in _COLUMNS for x in (F.lit(c), F.to_json(F.struct(F.col(c).alias("v"))).substr(F.lit(6), F.length(F.to_json(F.struct(F.col(c).alias("v")))) - 6))])
    none = diff.nothing()
    return part.select(
        F.lit("part").alias("kind"), F.col("p_partkey").cast("string").alias("id"), F.col("p_partkey").alias("ord"), F.lit(None).cast("string").alias("owner"), attributes.alias("attributes"), none.alias("relationships"), none.alias("meta")
    )


def diff_created(spark, sf_dir):
    old, new = _snapshots(spark, sf_dir)
    return joins.created(old, new, "p_partkey")


def diff_deleted(spark, sf_dir):
    old, new = _snapshots(spark, sf_dir)
    return joins.deleted(old, new, "p_partkey")


def diff_kept(spark, sf_dir):
    old, new = _snapshots(spark, sf_dir)
    return joins.kept(old, new, "p_partkey").select("p_partkey", "old_p_size", "new_p_size", "old_p_type", "new_p_type")


def diff_attr_changes(spark, sf_dir):
    old, new = (_entities(s) for s in _snapshots(spark, sf_dir))
    both = joins.kept(old, new)
    each = both.select("id", F.explode(diff.changed(F.col("old_attributes"), F.col("new_attributes"))).alias("attribute", "new_value"), "old_attributes")
    text = lambda c: F.trim(c, F.lit('"'))
    return each.select(F.col("id").cast("long").alias("id"), "attribute", text(F.element_at("old_attributes", F.col("attribute"))).alias("old_value"), text(F.col("new_value")).alias("new_value"))


def diff_plan(spark, sf_dir):
    """Destroys, creates and updates of the part catalog as a plan: the flagship."""
    old, new = (_entities(s) for s in _snapshots(spark, sf_dir))
    plan = diff.Simple(1, "part").plan(old, new)
    return plan.select("phase", "stage", F.col("ord").alias("seq"), "call", "entity_id", F.size("attributes").alias("n_sent"))


def plan_script(spark, sf_dir):
    """The plan's calls as lines of text."""
    old, new = (_entities(s) for s in _snapshots(spark, sf_dir))
    plan = diff.Simple(1, "part").plan(old, new).where("call <> 'part.create'")
    return plan.select("stage", F.col("ord").alias("seq"), render.statement(plan).alias("line"))


def recreated_ids(spark, sf_dir):
    """Created entities whose id doesn't survive."""
    old, new = (_entities(s) for s in _snapshots(spark, sf_dir))
    return diff.recreated(diff.Simple(1, "part").plan(old, new)).select("kind", F.col("id").cast("long").alias("id"))


def diff_rows_deep(spark, sf_dir):
    """Rows of one year that no row of the next equals, both ways, repeats kept. Years are ranges, which the scan can push down."""
    line = table(spark, sf_dir, "lineitem")
    year = lambda y: line.where(f"l_shipdate >= timestamp_ntz '{y}-01-01' and l_shipdate < timestamp_ntz '{y + 1}-01-01'").select("l_returnflag", "l_linestatus", "l_quantity", "l_discount", "l_tax", "l_linenumber")
    a, b = year(1994), year(1995)
    return joins.deep_difference(a, b).withColumn("side", F.lit("remove")).unionByName(joins.deep_difference(b, a).withColumn("side", F.lit("add")))


def default_elision(spark, sf_dir):
    """Attributes of orders beyond the defaults."""
    defaults = {"status": "O", "priority": "3-MEDIUM"}
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.create_map(F.lit("status"), "o_orderstatus", F.lit("priority"), "o_orderpriority").alias("a"))
    left = maps.beyond_defaults(F.col("a"), defaults)
    return rows.select("o_orderkey", F.try_element_at(left, F.lit("status")).alias("status"), F.try_element_at(left, F.lit("priority")).alias("priority"))


def truthy_clean(spark, sf_dir):
    """The truthy attributes of events' props and a few derived ones."""
    value = F.get_json_object("props", "$.k").cast("int")
    entries = {"zero": (value % 2).cast("string"), "flag": F.when(value > 50, "true").otherwise("false"), "text": F.when(value % 3 == 0, '""').otherwise('"x"')}
    a = F.create_map(*[x for k, v in entries.items() for x in (F.lit(k), v)])
    kept = F.array_join(F.array_sort(F.map_keys(maps.without_falsy(a))), ",")
    return table(spark, sf_dir, "events").select("event_id", kept.alias("kept"))


def canonical_equality(spark, sf_dir):
    """Events whose props are deeply equal: groups by canonical JSON."""
    rows = table(spark, sf_dir, "events").select(canonical(F.concat(F.lit('{"b": 1.0, "a": '), "props", F.lit("}"))).alias("c"))
    return rows.groupBy("c").agg(F.count("*").alias("n")).select(F.get_json_object("c", "$.a.k").cast("long").alias("k"), "n")


def plan_matrix(spark, sf_dir):
    """What an update of each part would send if it were a plugin: legacy by its size, public by its brand."""
    old, new = _snapshots(spark, sf_dir)
    both = joins.kept(old, new, "p_partkey")
    legacy, public = F.col("old_p_size") % 2 == 1, F.col("old_p_brand") < "Brand#3"
    same = F.col("old_p_type") == F.col("new_p_type")
    action = F.when(legacy & public & same, "convert").when(legacy & public, "upgrade").when(~legacy & public, F.when(same, "settings").otherwise("version")).otherwise("private")
    return both.select("p_partkey", action.alias("action"))


def plugin_plan(spark, sf_dir):
    """Parts taken for plugins, through the plugin phase."""

    def as_plugin(part: DataFrame) -> DataFrame:
        q = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
        a = F.create_map(
            F.lit("name"), q("p_name"), F.lit("package_name"), F.when(F.col("p_partkey") % 3 == 0, q("p_brand")).otherwise("null"), F.lit("package_version"), q("p_type"), F.lit("parameters"), F.col("p_size").cast("string")
        )
        meta = F.create_map(F.lit("version"), F.when(F.col("p_partkey") % 2 == 0, '"1"').otherwise('"2"'))
        return part.select(F.lit("plugin").alias("kind"), F.col("p_partkey").cast("string").alias("id"), F.col("p_partkey").alias("ord"), F.lit(None).cast("string").alias("owner"), a.alias("attributes"), diff.nothing().alias("relationships"), meta.alias("meta"))

    old, new = _snapshots(spark, sf_dir)
    plan = diff.plugins(as_plugin(old), as_plugin(new))
    sent = F.array_join(F.array_sort(F.map_keys("attributes")), ",")
    return plan.select("stage", F.col("ord").alias("seq"), "step", "call", sent.alias("sent"))


def finalize_rules(spark, sf_dir):
    """Parts taken for models, through the finishing phase: a changed size stands for a changed ordering field."""

    def as_model(part: DataFrame) -> DataFrame:
        a = F.create_map(F.lit("name"), F.concat(F.lit('"'), "p_type", F.lit('"')), F.lit("ordering_direction"), F.lit('"asc"'), F.lit("modular_block"), F.when(F.col("p_partkey") % 5 == 0, "true").otherwise("false"), F.lit("tree"), F.col("p_size").cast("string"))
        r = F.create_map(F.lit("ordering_field"), F.concat(F.lit('{"data":{"id":"'), F.col("p_size").cast("string"), F.lit('"}}')))
        return part.select(F.lit("item_type").alias("kind"), F.col("p_partkey").cast("string").alias("id"), F.col("p_partkey").alias("ord"), F.lit(None).cast("string").alias("owner"), a.alias("attributes"), r.alias("relationships"), diff.nothing().alias("meta"))

    old, new = (as_model(s) for s in _snapshots(spark, sf_dir))
    plan = diff.finished_models(old, new)
    names = lambda m: F.array_join(F.array_sort(F.map_keys(m)), ",")
    return plan.select("stage", F.col("ord").alias("seq"), names("attributes").alias("sent"), names("relationships").alias("links"))


def remap_ids(spark, sf_dir):
    """Customers' nations as lookups where the nation is re-created."""
    nations = table(spark, sf_dir, "nation").where("n_nationkey % 3 = 0").select(F.lit("nation").alias("kind"), F.col("n_nationkey").cast("string").alias("id"))
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").cast("string").alias("nation"))
    return render.remap(rows, nations.where(~survives(F.col("id"))), "nation", "nation").select("c_custkey", "new_id")


def key_listing(spark, sf_dir):
    """The place of each key in a catalog's listing: integer-like keys by number, then the others as they came."""
    from pyspark.sql import Window

    rows = table(spark, sf_dir, "events").select("event_id", "user_id", F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("k"), "event_id")).otherwise(F.col("event_id").cast("string")).alias("key"))
    place = F.row_number().over(Window.partitionBy("user_id").orderBy(*key_order(F.col("key"), F.col("event_id"))))
    return rows.select("event_id", place.cast("long").alias("place"))


def move_plan(spark, sf_dir):
    """Steps that bring each order's lines from their numbers to the order of their parts."""
    from pyspark.sql import Window

    line = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("l_partkey"))
    by = lambda *c: F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*c))
    side = lambda p: line.select(F.col("l_orderkey").alias("grp"), F.concat(F.lit("field:"), "l_linenumber").alias("key"), F.lit("").alias("scope"), p.alias("position"), F.col("l_linenumber").alias("ord"))
    return moves.plan_groups(side(by("l_linenumber")), side(by("l_partkey", "l_linenumber"))).withColumnRenamed("grp", "l_orderkey").drop("weight")


def tree_moves(spark, sf_dir):
    """Steps that bring each conversation's turns from one list into pairs of a turn and its answer."""
    talk = table(spark, sf_dir, "conversations").select("conv_id", "turn").distinct()
    row = lambda scope, position: talk.select(F.col("conv_id").alias("grp"), F.col("turn").cast("string").alias("key"), scope.alias("scope"), position.cast("int").alias("position"), F.col("turn").alias("ord"))
    odd = F.col("turn") % 2 == 1
    new = row(F.when(odd, (F.col("turn") - 1).cast("string")).otherwise(""), F.when(odd, 1).otherwise(F.floor(F.col("turn") / 2) + 1))
    return moves.plan_groups(row(F.lit(""), F.col("turn") + 1), new).withColumnRenamed("grp", "conv_id").drop("weight")


def topo_destroy(spark, sf_dir):
    """An order to destroy parts in, per brand: a part refers to the one of half its number."""
    part = table(spark, sf_dir, "part").select(F.col("p_brand").alias("grp"), F.col("p_partkey").alias("node"))
    edges = part.select("grp", F.col("node").alias("src"), F.floor(F.col("node") / 2).alias("dst"))
    return graph.destroy_order(part.withColumn("ord", F.col("node")), edges)


def path_rewrite(spark, sf_dir):
    """The value at a path of each event's props replaced where it is to be re-created."""
    k = F.get_json_object("props", "$.k").cast("long")
    return table(spark, sf_dir, "events").select("event_id", F.when(k % 4 == 0, F.concat(F.lit("new.k["), k, F.lit("]"))).otherwise(k.cast("string")).alias("k"))


def path_substitution(spark, sf_dir):
    """Orders as calls that mention models, fields and plugins in all the places that can; every third of these is made anew."""
    o = F.col("o_orderkey")
    quoted = lambda c: F.concat(F.lit('"'), c.cast("string"), F.lit('"'))
    listed = F.concat(F.lit('{"item_types":['), quoted(o % 10), F.lit(","), quoted(o % 7), F.lit('],"strategy":"x"}'))
    titled = F.concat(F.lit('{"title_field_id":'), quoted(o % 5), F.lit("}"))
    validators = F.when(o % 4 == 0, F.concat(F.lit('{"items_item_type":'), listed, F.lit(',"required":{}}'))).when(o % 4 == 1, F.concat(F.lit('{"slug_title_field":'), titled, F.lit("}"))).otherwise("{}")
    appearance = F.concat(F.lit('{"addons":[{"id":'), quoted(o % 8), F.lit(',"n":1}],"editor":'), quoted(o % 6), F.lit("}"))
    a = F.create_map(F.lit("validators"), validators, F.lit("appearance"), appearance, F.lit("label"), quoted(o % 10))
    r = F.create_map(F.lit("item_type"), F.concat(F.lit('{"data":{"id":'), quoted(o % 9), F.lit("}}")), F.lit("parent"), F.lit('{"data":null}'))
    plan = table(spark, sf_dir, "orders").select(F.lit(1).alias("phase"), F.lit(0).alias("stage"), o.alias("ord"), F.lit(0).cast("long").alias("step"), F.lit("field").alias("kind"), F.lit("field.update").alias("call"), o.cast("string").alias("entity_id"), a.alias("attributes"), r.alias("relationships"))
    kinds = F.explode(F.array(*map(F.lit, ("item_type", "field", "plugin"))))
    made = table(spark, sf_dir, "orders").where("o_orderkey % 3 = 0").select(kinds.alias("kind"), o.cast("string").alias("id"))
    out = render.remap_references(plan, made)
    of = lambda c, k: F.element_at(c, F.lit(k)).alias(k)
    return out.select("ord", of("attributes", "validators"), of("attributes", "appearance"), of("attributes", "label"), of("relationships", "item_type"), of("relationships", "parent"))


def recreated_kinds(spark, sf_dir):
    """How many entities of each kind get a new id: parts as filters, of which every third survives, and as menu entries."""
    part = table(spark, sf_dir, "part")
    id_ = F.when(F.col("p_partkey") % 3 == 0, F.lpad(F.col("p_partkey").cast("string"), 22, "x")).otherwise(F.col("p_partkey").cast("string"))
    side = lambda rows, kind: rows.select(F.lit(kind).alias("kind"), id_.alias("id"), F.col("p_partkey").alias("ord"), F.lit(None).cast("string").alias("owner"), *[diff.nothing().alias(c) for c in ("attributes", "relationships", "meta")])
    none = part.where("false")
    plan = diff.Simple(4, "upload_filter").plan(side(none, "upload_filter"), side(part, "upload_filter")).unionByName(diff.Simple(2, "workflow").plan(side(none, "workflow"), side(part.where("p_size > 20"), "workflow")))
    return diff.recreated(plan).groupBy("kind").agg(F.count("*").alias("n"))


def kept_rows(spark, sf_dir):
    """Both states of every attribute of the parts that stay."""
    old, new = _snapshots(spark, sf_dir)
    return joins.kept(old, new, "p_partkey")


def snapshot_kinds(spark, sf_dir):
    """A snapshot written and read again: entities and attributes of each kind."""
    from ..sources import snapshots
    from ..sources.folders import new_path

    old, new = (_entities(s) for s in _snapshots(spark, sf_dir))
    path = new_path(spark)
    snapshots.save(old.unionByName(new.withColumn("kind", F.lit("filter"))), path, "main")
    snapshots.fork(spark, path, "main", "copy")
    rows = snapshots.load(spark, path, "copy", "part", "filter")
    return rows.groupBy("kind").agg(F.count("*").alias("n"), F.sum(F.size("attributes")).cast("long").alias("n_attributes"), F.sum(F.element_at("attributes", F.lit("p_size")).cast("long")).alias("sizes"))


def permission_diff(spark, sf_dir):
    """Customers' segments as permissions of nations, compared between two halves of the customers."""
    c = table(spark, sf_dir, "customer")
    rule = F.create_map(F.lit("environment"), F.when(F.col("c_custkey") % 2 == 0, '"new"').otherwise('"old"'), F.lit("segment"), F.concat(F.lit('"'), "c_mktsegment", F.lit('"')), F.lit("level"), (F.floor(F.col("c_acctbal") / 5000) % 4).cast("string"))
    rules = c.select(F.col("c_nationkey").alias("id"), F.lit(0).alias("ord"), F.lit("p").alias("list"), rule.alias("rule"))
    out = diff.permission_changes(rules, "old", "new")
    parsed = F.from_json("rule", "map<string,string>")
    text = lambda k: F.trim(F.try_element_at(parsed, F.lit(k)), F.lit('"'))
    return out.select(F.col("id").cast("long").alias("nation"), "side", text("segment").alias("segment"), text("level").alias("level"))


QUERIES = (
    diff_created, diff_deleted, diff_kept, diff_attr_changes, diff_plan, plan_script, recreated_ids, diff_rows_deep, default_elision, truthy_clean, canonical_equality,
    plan_matrix, plugin_plan, finalize_rules, remap_ids, key_listing, move_plan, tree_moves, topo_destroy, path_rewrite, path_substitution, recreated_kinds, kept_rows, snapshot_kinds, permission_diff,
)

_DEEP = "SELECT l_returnflag, l_linestatus, l_quantity, l_discount, l_tax, l_linenumber FROM lineitem WHERE year(l_shipdate) ="
_K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
_CHANGES = f"""{_CTE}, b AS (SELECT n.p_partkey AS id, o.p_type AS ot, n.p_type AS nt, o.p_size AS os, n.p_size AS ns FROM o JOIN n USING (p_partkey))"""
_made = lambda n, kind: f"""CASE WHEN ({n}) % 3 = 0 THEN 'new{kind}["' || {n} || '"]' ELSE '"' || {n} || '"' END"""
SQL = {
    "diff_created": f"{_CTE} SELECT * FROM n WHERE p_partkey NOT IN (SELECT p_partkey FROM o)",
    "diff_deleted": f"{_CTE} SELECT * FROM o WHERE p_partkey NOT IN (SELECT p_partkey FROM n)",
    "diff_kept": f"{_CTE} SELECT p_partkey, o.p_size AS old_p_size, n.p_size AS new_p_size, o.p_type AS old_p_type, n.p_type AS new_p_type FROM o JOIN n USING (p_partkey)",
    "diff_attr_changes": f"""{_CHANGES}
        SELECT id, 'p_type' AS attribute, ot AS old_value, nt AS new_value FROM b WHERE ot IS DISTINCT FROM nt
        UNION ALL SELECT id, 'p_size', CAST(os AS VARCHAR), CAST(ns AS VARCHAR) FROM b WHERE os IS DISTINCT FROM ns""",
    "diff_plan": f"""{_CHANGES}
        SELECT CAST(1 AS INTEGER) AS phase, CAST(0 AS INTEGER) AS stage, p_partkey AS seq, 'part.destroy' AS call, CAST(p_partkey AS VARCHAR) AS entity_id, CAST(0 AS INTEGER) AS n_sent FROM o ANTI JOIN n USING (p_partkey)
        UNION ALL SELECT 1, 1, p_partkey, 'part.create', CAST(p_partkey AS VARCHAR), 5 FROM n ANTI JOIN o USING (p_partkey)
        UNION ALL SELECT 1, 2, id, 'part.update', CAST(id AS VARCHAR), CAST(ot <> nt AS INTEGER) + CAST(os <> ns AS INTEGER) FROM b WHERE ot <> nt OR os <> ns""",
    "plan_script": f"""{_CHANGES}
        SELECT CAST(0 AS INTEGER) AS stage, p_partkey AS seq, 'part.destroy(' || p_partkey || ', {{}}, {{}})' AS line FROM o ANTI JOIN n USING (p_partkey)
        UNION ALL SELECT 2, id, 'part.update(' || id || ', {{' || concat_ws(', ', CASE WHEN os <> ns THEN 'p_size: ' || ns END, CASE WHEN ot <> nt THEN 'p_type: "' || nt || '"' END) || '}}, {{}})' FROM b WHERE ot <> nt OR os <> ns""",
    "recreated_ids": f"{_CTE} SELECT 'part' AS kind, p_partkey AS id FROM n ANTI JOIN o USING (p_partkey)",
    "diff_rows_deep": f"""WITH a AS ({_DEEP} 1994), b AS ({_DEEP} 1995)
        SELECT *, 'remove' AS side FROM a ANTI JOIN b USING (l_returnflag, l_linestatus, l_quantity, l_discount, l_tax, l_linenumber)
        UNION ALL SELECT *, 'add' FROM b ANTI JOIN a USING (l_returnflag, l_linestatus, l_quantity, l_discount, l_tax, l_linenumber)""",
    "default_elision": "SELECT o_orderkey, nullif(o_orderstatus, 'O') AS status, nullif(o_orderpriority, '3-MEDIUM') AS priority FROM orders",
    "truthy_clean": f"SELECT event_id, concat_ws(',', CASE WHEN {_K} > 50 THEN 'flag' END, CASE WHEN {_K} % 3 <> 0 THEN 'text' END, CASE WHEN {_K} % 2 <> 0 THEN 'zero' END) AS kept FROM events",
    "canonical_equality": f"SELECT {_K} AS k, count(*) AS n FROM events GROUP BY 1",
    "plan_matrix": f"""{_CTE} SELECT p_partkey, CASE WHEN o.p_size % 2 = 1 AND o.p_brand < 'Brand#3' THEN CASE WHEN o.p_type = n.p_type THEN 'convert' ELSE 'upgrade' END
        WHEN o.p_brand < 'Brand#3' THEN CASE WHEN o.p_type = n.p_type THEN 'settings' ELSE 'version' END ELSE 'private' END AS action FROM o JOIN n USING (p_partkey)""",
    "plugin_plan": f"""{_CHANGES}, f AS (SELECT id, id % 2 = 0 AS legacy, id % 3 = 0 AS public, ot <> nt AS t, os <> ns AS s FROM b)
        SELECT CAST(0 AS INTEGER) AS stage, p_partkey AS seq, CAST(0 AS BIGINT) AS step, 'plugin.destroy' AS call, '' AS sent FROM o ANTI JOIN n USING (p_partkey)
        UNION ALL SELECT 1, p_partkey, 0, 'plugin.create', CASE WHEN p_partkey % 3 = 0 THEN 'package_name' WHEN p_partkey % 2 = 0 THEN 'name,package_name,package_version' ELSE 'name' END FROM n ANTI JOIN o USING (p_partkey)
        UNION ALL SELECT 1, p_partkey, 1, 'plugin.update', 'parameters' FROM n ANTI JOIN o USING (p_partkey)
        UNION ALL SELECT 2, id, 0, 'plugin.update', 'package_version' FROM f WHERE legacy AND public AND t
        UNION ALL SELECT 2, id, 1, 'plugin.update', 'parameters' FROM f WHERE legacy AND public AND s
        UNION ALL SELECT 2, id, 0, 'plugin.update', concat_ws(',', CASE WHEN t THEN 'package_version' END, CASE WHEN s THEN 'parameters' END) FROM f WHERE NOT legacy AND public AND (t OR s)
        UNION ALL SELECT 2, id, 0, 'plugin.update', 'parameters' FROM f WHERE NOT public AND s""",
    "finalize_rules": f"""{_CHANGES}
        SELECT CAST(0 AS INTEGER) AS stage, p_partkey AS seq, 'ordering_direction' AS sent, CASE WHEN p_partkey % 5 = 0 THEN '' ELSE 'ordering_field' END AS links FROM n ANTI JOIN o USING (p_partkey)
        UNION ALL SELECT 1, id, concat_ws(',', CASE WHEN ot <> nt THEN 'name' END, CASE WHEN os <> ns THEN 'ordering_direction' END, CASE WHEN os <> ns AND id % 5 <> 0 THEN 'tree' END),
            CASE WHEN os <> ns AND id % 5 <> 0 THEN 'ordering_field' ELSE '' END FROM b WHERE ot <> nt OR os <> ns""",
    "remap_ids": "SELECT c_custkey, CASE WHEN c_nationkey % 3 = 0 THEN 'new.nation[' || c_nationkey || ']' ELSE CAST(c_nationkey AS VARCHAR) END AS new_id FROM customer",
    "key_listing": "SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id % 3 = 0, event_id) AS place FROM events",
    "topo_destroy": """WITH RECURSIVE d AS (SELECT p_partkey AS top, p_partkey AS node, p_brand FROM part UNION ALL SELECT d.top, c.p_partkey, c.p_brand FROM d JOIN part c ON c.p_partkey // 2 = d.node AND c.p_brand = d.p_brand AND c.p_partkey <> d.node)
        SELECT p_brand AS grp, top AS node, row_number() OVER (PARTITION BY p_brand ORDER BY max(node), top DESC) AS rank FROM d GROUP BY 1, 2""",
    "path_rewrite": f"SELECT event_id, CASE WHEN {_K} % 4 = 0 THEN 'new.k[' || {_K} || ']' ELSE CAST({_K} AS VARCHAR) END AS k FROM events",
    "path_substitution": f"""WITH t AS (SELECT o_orderkey AS o, CASE WHEN EXISTS (SELECT 1 FROM orders) THEN 1 END AS one FROM orders)
        SELECT o AS ord, CASE o % 4 WHEN 0 THEN '{{"items_item_type":{{"item_types":[' || {_made('o % 10', 'ItemTypes')} || ',' || {_made('o % 7', 'ItemTypes')} || '],"strategy":"x"}},"required":{{}}}}'
            WHEN 1 THEN '{{"slug_title_field":{{"title_field_id":' || {_made('o % 5', 'Fields')} || '}}}}' ELSE '{{}}' END AS validators,
            '{{"addons":[{{"id":' || {_made('o % 8', 'Plugins')} || ',"n":1}}],"editor":' || {_made('o % 6', 'Plugins')} || '}}' AS appearance, '"' || o % 10 || '"' AS label,
            CASE WHEN o % 9 % 3 = 0 THEN 'newItemTypes["' || o % 9 || '"]' ELSE '{{"data":{{"id":"' || o % 9 || '"}}}}' END AS item_type, '{{"data":null}}' AS parent FROM t""",
    "recreated_kinds": "SELECT 'upload_filter' AS kind, count(*) AS n FROM part WHERE p_partkey % 3 <> 0 UNION ALL SELECT 'workflow', count(*) FROM part WHERE p_partkey % 3 <> 0 AND p_size > 20",
    "kept_rows": f"{_CTE} SELECT n.p_partkey, o.p_name AS old_p_name, o.p_brand AS old_p_brand, o.p_type AS old_p_type, o.p_size AS old_p_size, o.p_retailprice AS old_p_retailprice, n.p_name AS new_p_name, n.p_brand AS new_p_brand, n.p_type AS new_p_type, n.p_size AS new_p_size, n.p_retailprice AS new_p_retailprice FROM o JOIN n USING (p_partkey)",
    "snapshot_kinds": f"{_CTE} SELECT 'part' AS kind, count(*) AS n, 5 * count(*) AS n_attributes, CAST(sum(p_size) AS BIGINT) AS sizes FROM o UNION ALL SELECT 'filter', count(*), 5 * count(*), CAST(sum(p_size) AS BIGINT) FROM n",
    "permission_diff": """WITH r AS (SELECT CAST(c_nationkey AS BIGINT) AS nation, c_custkey % 2 = 0 AS new, c_mktsegment AS segment, nullif(CAST(CAST(floor(c_acctbal / 5000) AS BIGINT) % 4 AS VARCHAR), '0') AS level FROM customer)
        SELECT nation, 'add' AS side, segment, level FROM r WHERE new AND NOT EXISTS (SELECT 1 FROM r q WHERE NOT q.new AND q.nation = r.nation AND q.segment = r.segment AND q.level IS NOT DISTINCT FROM r.level)
        UNION ALL SELECT nation, 'remove', segment, level FROM r WHERE NOT new AND NOT EXISTS (SELECT 1 FROM r q WHERE q.new AND q.nation = r.nation AND q.segment = r.segment AND q.level IS NOT DISTINCT FROM r.level)""",
}

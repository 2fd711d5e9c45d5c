"""Joins, lists of links, incremental runs and graphs over the input tables."""

from __future__ import annotations

from pyspark.sql import Column, Window, functions as F

from ..functions import text
from ..operators import graph, joins, order
from ..plans import ledger, search
from ..session import table
from ..sources import snapshots
from ..sources.folders import new_path


def _text(items: Column | str) -> Column:
    return F.array_join(F.transform(items, lambda x: F.coalesce(x.cast("string"), F.lit("-"))), ",")


def _order_parts(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("l"))
    return line.select("l_orderkey", F.transform("l", lambda x: x["l_partkey"]).alias("parts"))


def _live_parts(spark, sf_dir):
    return table(spark, sf_dir, "part").where("p_partkey % 5 <> 0").select("p_partkey", F.concat(F.lit("t"), "p_partkey").alias("target"))


def nest_children(spark, sf_dir):
    nations, customers = table(spark, sf_dir, "nation"), table(spark, sf_dir, "customer")
    # keys as text: a nation's list grows with the table, so only its size and ends are kept
    per = customers.groupBy("c_nationkey").agg(F.count("*").alias("n_children"), F.min("c_custkey").alias("first_child"), F.max("c_custkey").alias("last_child"))
    return nations.join(per, nations.n_nationkey == per.c_nationkey).select("n_name", "n_children", "first_child", "last_child")


def type_split(spark, sf_dir):
    """The rows of one kind of a mixed table."""
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", F.col("event_type").alias("kind"))
    return snapshots.split(rows, "click").drop("kind")


def shared_filter(spark, sf_dir):
    """Filters that are shared, events being filters."""
    shared = F.create_map(F.lit("shared"), F.when(F.col("value") > 0, "true").otherwise("false"))
    return snapshots.shared(table(spark, sf_dir, "events").select("event_id", "event_type", shared.alias("attributes"))).drop("attributes")


def owner_lookup_first(spark, sf_dir):
    return joins.first_match(table(spark, sf_dir, "supplier").select("s_nationkey", "s_suppkey", "s_name"), "s_nationkey", "s_suppkey")


def mark_join(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return joins.mark(table(spark, sf_dir, "customer").select("c_custkey"), orders, "c_custkey", "installed")


def semi_transformed_key(spark, sf_dir):
    names = table(spark, sf_dir, "nation").where("n_regionkey = 1").select(F.lower("n_name").alias("key"))
    all_ = table(spark, sf_dir, "nation").withColumn("key", F.lower("n_name"))
    return all_.join(names, "key", "left_semi").select("n_nationkey", "n_name")


def array_strip(spark, sf_dir):
    gone = table(spark, sf_dir, "part").where("p_partkey % 5 = 0").select("p_partkey")
    return joins.strip(_order_parts(spark, sf_dir), "l_orderkey", "parts", gone, "p_partkey")


def allowed_or_all(spark, sf_dir):
    names = F.when(F.col("p_size") % 4 == 0, F.array().cast("array<bigint>")).otherwise(F.array(F.col("p_partkey") % 150, F.col("p_partkey") % 90, F.lit(10**9)))
    rows = table(spark, sf_dir, "part").select("p_partkey", names.alias("names"))
    targets = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    return joins.allowed_or_all(rows, "p_partkey", "names", targets, "s_suppkey", "s_name").select("p_partkey", "unrestricted", F.coalesce(F.size("names"), F.lit(-1)).cast("long").alias("n_allowed"))


def link_single(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("link"))
    return joins.resolve(line, _live_parts(spark, sf_dir), "link", "p_partkey", "target", F.col("l_linenumber") <= 4).select("l_orderkey", "l_linenumber", "target")


def link_many(spark, sf_dir):
    out = joins.resolve_list(_order_parts(spark, sf_dir), "l_orderkey", "parts", _live_parts(spark, sf_dir), "p_partkey", "target")
    return out.select("l_orderkey", _text("parts").alias("targets"))


def link_holes(spark, sf_dir):
    out = joins.resolve_list(_order_parts(spark, sf_dir), "l_orderkey", "parts", _live_parts(spark, sf_dir), "p_partkey", "target", holes=True)
    return out.select("l_orderkey", _text("parts").alias("targets"))


def asset_lookup(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    docs = table(spark, sf_dir, "documents").where("lang = 'en'").select(F.col("doc_id").alias("page_id"), F.col("source").alias("upload_id"), F.col("n_chars").alias("size"))
    found = pages.join(docs, "page_id", "left")
    return found.select("page_id", "upload_id", F.when(F.col("upload_id").isNotNull(), F.col("url")).alias("title"), "size")


def category_parent(spark, sf_dir):
    talk = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    parents = talk.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("role").alias("parent_role"))
    return talk.where("turn <> 0").join(parents, ["conv_id", "turn"]).select("conv_id", "turn", "role", "parent_role")


def ledger_pending(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    name = F.concat(F.col("event_id").cast("string"), F.lit("_"), "event_type", F.when(F.col("event_id") % 7 == 0, ".md").otherwise(".js"))
    scripts = events.select("event_id", name.alias("name"))
    return ledger.pending(scripts.select("name"), scripts.where("event_id % 3 = 0").select("name"))


def ledger_notes(spark, sf_dir):
    """What is left to run after two runs have noted what they did in a new ledger; the rest of the records is of other types."""
    events = table(spark, sf_dir, "events").select(F.col("event_type").alias("type"), F.concat(F.col("event_id").cast("string"), F.lit("_x.ts")).alias("name"), "event_id")
    path = new_path(spark)
    for n in (0, 1):
        ledger.note(ledger.of_type(events.where(F.col("event_id") % 3 == n), "click"), path)
    return ledger.pending(ledger.of_type(events, "click"), ledger.ledger(spark, path))


def first_wins(spark, sf_dir):
    return joins.first_match(table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type"), "user_id", "ts", "event_id")


def index_last_wins(spark, sf_dir):
    return joins.last_match(table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type"), "user_id", "ts", "event_id")


def max_position(spark, sf_dir):
    return order.next_position(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber").select("l_orderkey", F.col("next_position").cast("long").alias("next_position"))


def in_degree(spark, sf_dir):
    return graph.in_degrees(table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("src"), F.col("l_suppkey").alias("dst")))


def tree_depth(spark, sf_dir):
    talk = table(spark, sf_dir, "conversations").select("conv_id", "turn").distinct()
    key = lambda t: F.concat_ws("/", "conv_id", t)
    nodes = talk.select(key(F.col("turn")).alias("id"), F.when(F.col("turn") > 0, key(F.col("turn") - 1)).alias("parent"))
    part = lambda n: F.split_part("id", F.lit("/"), F.lit(n)).cast("long")
    return graph.depths(nodes).select(part(1).alias("conv_id"), part(2).alias("turn"), F.col("depth").cast("long").alias("depth"))


def _edges(spark, sf_dir):
    """A supplier refers to one of its next neighbours: components of a few nodes each."""
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("src"))
    return s.select("src", F.when(F.col("src") % 8 == 0, F.col("src") - 7).otherwise(F.col("src") + 1).alias("dst")).where("src % 16 <> 5")


def closure_fwd(spark, sf_dir):
    start = table(spark, sf_dir, "supplier").where("s_suppkey % 16 in (1, 4, 11)").select(F.col("s_suppkey").alias("node"))
    return graph.closure(start, _edges(spark, sf_dir)).select("node")


def closure_rev(spark, sf_dir):
    start = table(spark, sf_dir, "supplier").where("s_suppkey % 16 in (1, 4, 11)").select(F.col("s_suppkey").alias("node"))
    return graph.closure(start, graph.reverse(_edges(spark, sf_dir))).select("node")


def _turns(spark, sf_dir):
    """Each turn of a conversation leads to the next one, as far as they go without a gap."""
    talk = table(spark, sf_dir, "conversations").select("conv_id", "turn").distinct()
    node = lambda t: F.struct("conv_id", t.alias("turn"))
    return talk.select(node(F.col("turn") - 1).alias("src"), node(F.col("turn")).alias("dst")).where("src.turn >= 0")


def closure_turns(spark, sf_dir):
    """Turns that the first turns lead to, and in how many steps."""
    start = table(spark, sf_dir, "conversations").where("turn = 0 and conv_id % 3 = 0").select(F.struct("conv_id", "turn").alias("node"))
    return graph.closure(start, _turns(spark, sf_dir)).select("node.conv_id", "node.turn", "stage")


def talk_ends(spark, sf_dir):
    """The last turn of each turn's conversation, by following them."""
    out = graph.chain_ends(_turns(spark, sf_dir))
    return out.select("src.conv_id", "src.turn", F.col("end.turn").alias("last"))


def _related(spark, sf_dir):
    """Parts as models: a part holds the two of twice its number as blocks, and refers to the one of a third of it."""
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("node"))
    blocks = p.where("node > 1").select(F.floor(F.col("node") / 2).alias("src"), F.col("node").alias("dst"))
    return p.where("node % 40 = 7"), blocks, p.select(F.col("node").alias("src"), F.floor(F.col("node") / 3).alias("dst"))


def related_models(spark, sf_dir):
    """Models with the blocks that they hold, those that they and these refer to, and those that hold them."""
    start, blocks, references = _related(spark, sf_dir)
    return search.with_related(start, blocks, references, nested=True, referenced=True, embedding=True)


def nested_models(spark, sf_dir):
    """Customers as models with their orders as fields and the statuses of these as fieldsets, in order."""
    models = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), "c_name")
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("owner"), (-F.col("o_orderkey")).alias("position"), F.col("o_orderkey").alias("id"), "o_orderstatus")
    sets = orders.select("owner", F.ascii("o_orderstatus").cast("long").alias("position"), F.col("o_orderstatus").alias("id")).distinct()
    out = search.nested(models, orders, sets)
    return out.select("id", "c_name", F.array_join(F.transform("fields", lambda f: F.concat_ws(":", f["id"].cast("string"), f["o_orderstatus"])), ",").alias("fields"), F.array_join(F.transform("fieldsets", lambda f: f["id"]), ",").alias("fieldsets"))


def alias_chains(spark, sf_dir):
    """Where following each customer to the one of a tenth of its number ends."""
    c = table(spark, sf_dir, "customer").where("c_custkey >= 10").select(F.col("c_custkey").alias("src"), F.floor(F.col("c_custkey") / 10).alias("dst"))
    return graph.chain_ends(c)


def two_pass_load(spark, sf_dir):
    """Orders get new ids first; then each order's link to its customer's next order is resolved."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    new_id = orders.select("o_orderkey", F.concat(F.lit("r"), F.col("o_orderkey") * 10 + 1).alias("new_id"))
    linked = orders.withColumn("link", F.lead("o_orderkey").over(Window.partitionBy("o_custkey").orderBy("o_orderkey")))
    own = linked.join(new_id, "o_orderkey")
    target = new_id.select(F.col("o_orderkey").alias("link"), F.col("new_id").alias("next_id"))
    return own.join(target, "link", "left").select("new_id", "next_id")


def etag_md5(spark, sf_dir):
    """Documents found by the hash of their content: only where exactly one has it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.md5(F.col("text").cast("binary")).alias("md5"))
    tags = docs.select("doc_id", text.content_md5(F.when(F.col("doc_id") % 9 == 0, F.concat(F.lit('"'), "md5", F.lit('-2"'))).otherwise(F.concat(F.lit(' "'), "md5", F.lit('" ')))).alias("md5"))
    unique = docs.groupBy("md5").agg(F.count("*").alias("n"), F.min("doc_id").alias("matched")).where("n = 1").drop("n")
    return tags.join(unique, "md5", "left").select("doc_id", "matched")


def class_sort_rank(spark, sf_dir):
    """Parts of each brand: plain ones first, then those whose name starts like a slug, each by size."""
    place = F.row_number().over(Window.partitionBy("p_brand").orderBy(F.col("p_type").startswith("SMALL"), "p_size", "p_partkey"))
    return table(spark, sf_dir, "part").select("p_partkey", place.cast("long").alias("place"))


def run_counters(spark, sf_dir):
    failed = F.col("event_type") == "error"
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count_if(~failed).alias("finished"), F.count_if(failed).alias("failed"))


def recreated_by_kind(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("kind")).agg(F.count("*").alias("n"))


QUERIES = (
    nest_children, type_split, shared_filter, owner_lookup_first, mark_join, semi_transformed_key, array_strip, allowed_or_all, link_single, link_many, link_holes, asset_lookup, category_parent,
    closure_turns, talk_ends, related_models, nested_models, ledger_notes, ledger_pending, first_wins, index_last_wins, max_position, in_degree, tree_depth, closure_fwd, closure_rev, alias_chains, two_pass_load, etag_md5, class_sort_rank, run_counters, recreated_by_kind,
)

_LINES = "SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_partkey % 5 <> 0 AND l_partkey IN (SELECT p_partkey FROM part) THEN 't' || l_partkey END AS target FROM lineitem"
_EDGES = "SELECT s_suppkey AS src, CASE WHEN s_suppkey % 8 = 0 THEN s_suppkey - 7 ELSE s_suppkey + 1 END AS dst FROM supplier WHERE s_suppkey % 16 <> 5"
_START = "SELECT s_suppkey AS node FROM supplier WHERE s_suppkey % 16 IN (1, 4, 11)"
SQL = {
    "nest_children": "SELECT n_name, count(*) AS n_children, min(c_custkey) AS first_child, max(c_custkey) AS last_child FROM nation JOIN customer ON n_nationkey = c_nationkey GROUP BY n_nationkey, n_name",
    "type_split": "SELECT event_id, user_id FROM events WHERE event_type = 'click'",
    "shared_filter": "SELECT event_id, event_type FROM events WHERE value > 0",
    "owner_lookup_first": "SELECT s_nationkey, s_suppkey, s_name FROM supplier QUALIFY row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) = 1",
    "mark_join": "SELECT c_custkey, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) AS installed FROM customer",
    "semi_transformed_key": "SELECT n_nationkey, n_name FROM nation WHERE lower(n_name) IN (SELECT lower(n_name) FROM nation WHERE n_regionkey = 1)",
    "array_strip": "SELECT l_orderkey, count(*) AS before, count(*) FILTER (WHERE l_partkey % 5 <> 0 OR l_partkey NOT IN (SELECT p_partkey FROM part)) AS after FROM lineitem GROUP BY 1 HAVING after < before",
    "allowed_or_all": """SELECT p_partkey, p_size % 4 = 0 AS unrestricted, CASE WHEN p_size % 4 = 0 THEN -1 ELSE (SELECT count(DISTINCT s_name) FROM supplier WHERE s_suppkey IN (p_partkey % 150, p_partkey % 90)) END AS n_allowed FROM part""",
    "link_single": f"SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber <= 4 THEN target END AS target FROM ({_LINES})",
    "link_many": f"SELECT l_orderkey, coalesce(string_agg(target, ',' ORDER BY l_linenumber, l_partkey), '') AS targets FROM ({_LINES}) GROUP BY 1",
    "link_holes": f"SELECT l_orderkey, string_agg(coalesce(target, '-'), ',' ORDER BY l_linenumber, l_partkey) AS targets FROM ({_LINES}) GROUP BY 1",
    "asset_lookup": "SELECT page_id, source AS upload_id, CASE WHEN source IS NOT NULL THEN url END AS title, n_chars AS size FROM pages LEFT JOIN (SELECT * FROM documents WHERE lang = 'en') ON doc_id = page_id",
    "category_parent": "SELECT c.conv_id, c.turn, c.role, p.role AS parent_role FROM conversations c JOIN conversations p ON p.conv_id = c.conv_id AND p.turn = c.turn - 1 WHERE c.turn <> 0",
    "ledger_notes": "SELECT event_id || '_x.ts' AS name FROM events WHERE event_type = 'click' AND event_id % 3 = 2",
    "ledger_pending": "SELECT event_id || '_' || event_type || '.js' AS name FROM events WHERE event_id % 7 <> 0 AND event_id % 3 <> 0",
    "first_wins": "SELECT user_id, ts, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1",
    "index_last_wins": "SELECT user_id, ts, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1",
    "max_position": "SELECT l_orderkey, CAST(greatest(max(l_linenumber), 0) + 1 AS BIGINT) AS next_position FROM lineitem GROUP BY 1",
    "in_degree": "SELECT l_suppkey AS node, count(DISTINCT l_partkey) AS n FROM lineitem WHERE l_partkey <> l_suppkey GROUP BY 1",
    "tree_depth": "SELECT conv_id, turn, turn AS depth FROM (SELECT DISTINCT conv_id, turn FROM conversations)",
    "closure_fwd": f"WITH RECURSIVE e AS ({_EDGES}), r AS ({_START} UNION SELECT dst FROM r JOIN e ON src = node) SELECT DISTINCT node FROM r",
    "closure_rev": f"WITH RECURSIVE e AS ({_EDGES}), r AS ({_START} UNION SELECT src FROM r JOIN e ON dst = node) SELECT DISTINCT node FROM r",
    "closure_turns": """WITH RECURSIVE t AS (SELECT DISTINCT conv_id, turn FROM conversations), r AS (SELECT conv_id, turn FROM t WHERE turn = 0 AND conv_id % 3 = 0 UNION ALL SELECT t.conv_id, t.turn FROM r JOIN t ON t.conv_id = r.conv_id AND t.turn = r.turn + 1)
        SELECT conv_id, turn, CAST(turn AS INTEGER) AS stage FROM r""",
    "talk_ends": """WITH t AS (SELECT DISTINCT conv_id, turn FROM conversations), g AS (SELECT *, turn - row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS run FROM t), e AS (SELECT *, max(turn) OVER (PARTITION BY conv_id, run) AS last FROM g)
        SELECT conv_id, turn - 1 AS turn, last FROM t JOIN e USING (conv_id, turn) WHERE turn > 0""",
    "related_models": """WITH RECURSIVE s AS (SELECT p_partkey AS node FROM part WHERE p_partkey % 40 = 7), b AS (SELECT p_partkey // 2 AS src, p_partkey AS dst FROM part WHERE p_partkey > 1),
        d AS (SELECT node FROM s UNION SELECT dst FROM d JOIN b ON src = node), u AS (SELECT node FROM s UNION SELECT src FROM u JOIN b ON dst = node),
        a AS (SELECT node, 0 AS reason FROM s UNION ALL SELECT node, 1 FROM d UNION ALL SELECT node // 3, 2 FROM d UNION ALL SELECT node, 3 FROM u) SELECT node, CAST(min(reason) AS INTEGER) AS reason FROM a GROUP BY 1""",
    "nested_models": """SELECT c_custkey AS id, c_name, coalesce(string_agg(o_orderkey || ':' || o_orderstatus, ',' ORDER BY o_orderkey DESC), '') AS fields, coalesce(string_agg(DISTINCT o_orderstatus, ',' ORDER BY o_orderstatus), '') AS fieldsets
        FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2""",
    "alias_chains": 'SELECT c_custkey AS src, CAST(substr(CAST(c_custkey AS VARCHAR), 1, 1) AS BIGINT) AS "end" FROM customer WHERE c_custkey >= 10',
    "two_pass_load": "SELECT 'r' || (o_orderkey * 10 + 1) AS new_id, 'r' || (lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) * 10 + 1) AS next_id FROM orders",
    "etag_md5": "SELECT doc_id, CASE WHEN doc_id % 9 <> 0 AND count(*) OVER (PARTITION BY md5(text)) = 1 THEN doc_id END AS matched FROM documents",
    "class_sort_rank": "SELECT p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY starts_with(p_type, 'SMALL'), p_size, p_partkey) AS place FROM part",
    "run_counters": "SELECT event_type, count(*) FILTER (WHERE event_type <> 'error') AS finished, count(*) FILTER (WHERE event_type = 'error') AS failed FROM events GROUP BY 1",
    "recreated_by_kind": "SELECT event_type AS kind, count(*) AS n FROM events GROUP BY 1",
}

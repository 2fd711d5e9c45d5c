"""Search, ranking and pages over the input tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import names, text
from ..operators import order
from ..plans import ledger, search
from ..session import table
from ..sources import paged, settings
from ..sources.folders import new_path


def fuzzy_score(spark, sf_dir):
    score = lambda q: names.fuzzy_score(F.lit(q), F.lower("p_name")).cast("long").alias(f"score_{q}")
    return table(spark, sf_dir, "part").select("p_partkey", score("pt"), score("part"), score("a2"))


def fuzzy_topk(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return order.top(rows, names.fuzzy_score(F.lit("Cst15"), F.col("c_name")), 20, "c_custkey").select("c_custkey", F.col("score").cast("long").alias("score"))


def _projects(spark, sf_dir):
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("name"), F.concat(F.lower("s_name"), F.lit(".example")).alias("domain"), F.col("s_suppkey").alias("ord"))


def exact_else_fuzzy(spark, sf_dir):
    """A query that has an exact match, one that has only fuzzy ones."""
    rows = _projects(spark, sf_dir)
    out = None
    for query in ("7", "ier#0000"):
        found = search.find_projects(rows, query).select(F.lit(query).alias("query"), "id", F.col("score").cast("long").alias("score"))
        out = found if out is None else out.unionByName(found)
    return out


def find_models(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("id"), F.lower("p_type").alias("api_key"), F.col("p_name").alias("name"), F.col("p_partkey").alias("ord"))
    return search.find_models(part, "dium").select("id", F.col("score").cast("long").alias("score"))


def workspace_filter(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    kind = F.when(F.col("c_custkey") % 3 == 0, "personal").otherwise("organization")
    rows = c.select("c_custkey", kind.alias("workspace_type"), F.col("c_nationkey").cast("string").alias("workspace_id"), F.col("c_mktsegment").alias("workspace_name"), F.concat(F.lit("u"), F.col("c_nationkey"), F.lit("@x.example")).alias("owner"))
    out = None
    for w in ("Personal", "7", "building", "U3@x.example"):
        found = search.in_workspace(rows, w).select(F.lit(w).alias("workspace"), "c_custkey")
        out = found if out is None else out.unionByName(found)
    return out


def contains_filter(spark, sf_dir):
    return table(spark, sf_dir, "part").where(search.contains("p_name", "WID")).select("p_partkey", "p_name")


def suggestions_top20(spark, sf_dir):
    """The first names in order, for whoever has mistyped one."""
    return search.suggestions(table(spark, sf_dir, "part").where(F.col("p_name") > "P"), "p_name")


def name_match(spark, sf_dir):
    """Parts of one name, however it is written."""
    return table(spark, sf_dir, "part").where(names.normalised(F.translate("p_name", " ", "_")) == "smallwidget").select("p_partkey", "p_name")


def script_order(spark, sf_dir):
    """The place of each script in the collation's order, by its type."""
    from pyspark.sql import Window

    name = F.concat(F.col("event_id").cast("string"), F.lit("_"), F.when(F.col("event_id") % 2 == 0, F.upper("event_type")).otherwise(F.col("event_type")), F.lit(".js"))
    rows = table(spark, sf_dir, "events").select("user_id", name.alias("filename"))
    place = F.row_number().over(Window.partitionBy("user_id").orderBy(F.collate("filename", "UNICODE"), "filename"))
    return rows.where(F.col("filename").rlike(ledger.SCRIPT)).select("filename", place.cast("long").alias("place"))


def paged_scan(spark, sf_dir):
    """Orders through the paged source: rows of each page of 100 and its first and last key."""
    paged.register(spark)
    rows = spark.read.format("paged").option("path", f"{sf_dir}/orders.parquet").option("pagesize", 100).load()
    return rows.groupBy(F.col("page").cast("long").alias("page")).agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first"), F.max("o_orderkey").alias("last"))


def workspace_projects(spark, sf_dir):
    """Sites of all workspaces that have a token, each once: customers are sites, suppliers workspaces, and some sites are in two."""
    workspaces = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("workspace_id"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("ord"))
    c = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select(F.explode(F.array(c % 10, (c + 3) % 7)).alias("workspace_id"), c.alias("id"), F.col("c_name").alias("name"), F.when(c % 3 == 0, F.concat(F.lower("c_name"), F.lit(".com"))).otherwise("").alias("domain"), F.when(c % 4 == 0, F.concat(F.lit("sub"), c)).alias("subdomain"), F.when(c % 5 == 0, "").otherwise("token").alias("access_token"), c.alias("ord"))
    return search.projects_of(workspaces, rows).select("id", "name", "domain", "workspace")


def workspace_sites(spark, sf_dir):
    """Workspaces with a usable site and how many they have."""
    workspaces = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("workspace_id"), F.col("s_name").alias("name"))
    c = F.col("c_custkey")
    return search.usable_workspaces(workspaces, table(spark, sf_dir, "customer").select((c % 120).alias("workspace_id"), F.when(c % 5 == 0, "").when(c % 7 > 0, "token").alias("access_token")))


def models_of_sort(spark, sf_dir):
    """Models, and blocks, of a catalog: parts by their size."""
    rows = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") % 3 == 0).alias("modular_block"))
    return search.of_sort(rows, "blocks_only").select("p_partkey", F.lit("block").alias("sort")).unionByName(search.of_sort(rows, "models_only").select("p_partkey", F.lit("model").alias("sort")))


def primary_environment(spark, sf_dir):
    """The first order that is marked as the primary one."""
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), ((F.col("o_orderstatus") == "P") & (F.col("o_orderkey") % 7 == 3)).alias("is_primary"), F.col("o_orderkey").alias("ord"))
    return search.primary(rows)


def field_details(spark, sf_dir):
    """What an inspection shows of a field at each level: parts are fields."""
    a = F.create_map(*[x for k in ("label", "position", "validators", "appearance", "appeareance", "default_value", "deep_filtering_enabled") for x in (F.lit(k), F.col("p_size").cast("string"))])
    r = F.create_map(F.lit("item_type"), F.lit("1"), F.lit("fieldset"), F.lit("2"))
    rows = table(spark, sf_dir, "part").select("p_partkey", a.alias("attributes"), r.alias("relationships"))
    keys = lambda c: F.array_join(F.array_sort(F.map_keys(c)), ",")
    out = None
    for level, wanted in (("basic", ()), ("complete", ()), ("basic", ("validators",))):
        part = search.shown(rows, search.details(level, wanted)).select("p_partkey", F.lit("-".join((level, *wanted))).alias("level"), keys("attributes").alias("attributes"), keys("relationships").alias("relationships"))
        out = part if out is None else out.unionByName(part)
    return out


def relaxed_json(spark, sf_dir):
    """Events' properties as people would write them."""
    text_ = F.concat(F.lit("{k: "), F.get_json_object("props", "$.k"), F.lit(", /* kind */ 'kind': '"), "event_type", F.lit("'}"))
    return table(spark, sf_dir, "events").select("event_id", F.inline(F.array(settings.relaxed(text_, "k long, kind string"))))


def script_names(spark, sf_dir):
    """File names of scripts: the time, and the name in camel case."""
    return table(spark, sf_dir, "part").select("p_partkey", names.script_name(F.col("p_partkey") + 1_700_000_000, F.concat(F.lit("add "), F.lower("p_type"))).alias("name"))


def domain_coalesce(spark, sf_dir):
    """A page's domain: its host unless that is a mobile one, else a name made from its id; the common suffix is cut."""
    host = F.regexp_extract("url", "://([^/?#]*)", 1)
    given = F.when(F.startswith(host, F.lit("m.")), "").otherwise(host)
    domain = text.first_given(given, F.concat(F.lit("page-"), F.col("page_id"), F.lit(".example.com")))
    return table(spark, sf_dir, "pages").select("page_id", names.without_suffix(domain, ".example.com").alias("domain"))


def fuzzy_pruned(spark, sf_dir):
    """The best names for a query that many names have as a part, and for one whose letters are apart: letters are walked through for the second only."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    name, out = F.lower("c_name"), None
    for query in ("omer#", "cst15"):
        found = order.top_fuzzy(rows, query, [name], 20, "c_custkey").select(F.lit(query).alias("query"), "c_custkey", F.col("score").cast("long").alias("score"))
        out = found if out is None else out.unionByName(found)
    return out


def paged_stream(spark, sf_dir):
    """Orders through the paged source as a stream that ends when it has read all there is: rows of each page and its first and last key."""
    paged.register(spark)
    path = new_path(spark)
    stream = spark.readStream.format("paged").option("path", f"{sf_dir}/orders.parquet").option("pagesize", 250).load()
    stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", f"{path}.offsets").trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.schema(stream.schema).parquet(path)
    return rows.groupBy(F.col("page").cast("long").alias("page")).agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first"), F.max("o_orderkey").alias("last"))


QUERIES = (paged_stream, fuzzy_pruned, fuzzy_score, fuzzy_topk, exact_else_fuzzy, find_models, workspace_filter, contains_filter, suggestions_top20, name_match, script_order, paged_scan, workspace_projects, workspace_sites, models_of_sort, primary_environment, field_details, relaxed_json, script_names, domain_coalesce)


def _score(q: str, t: str) -> str:
    """The fuzzy score in SQL."""
    n = len(q)
    step = (
        f"CASE WHEN a.f < {n} AND substr({t}, x.i, 1) = substr('{q}', a.f + 1, 1) THEN struct_pack(i := 0, f := a.f + 1, l := x.i, r := CASE WHEN a.l = x.i - 1 THEN a.r + 1 ELSE 1 END, "
        f"b := CASE WHEN a.l = x.i - 1 THEN greatest(a.b, a.r + 1) ELSE a.b END) ELSE a END"
    )
    zero = "struct_pack(i := {i}, f := 0, l := -2, r := 0, b := 0)"
    fold = f"list_reduce(list_prepend({zero.format(i='0')}, list_transform(range(1, length({t}) + 1), lambda k: {zero.format(i='CAST(k AS INTEGER)')})), lambda a, x: {step})"
    return (
        f"CAST(CASE WHEN {t} = '{q}' THEN 1000 WHEN starts_with({t}, '{q}') THEN 500 + {n} WHEN strpos({t}, '{q}') > 0 THEN 200 + {n} - strpos({t}, '{q}') + 1 "
        f"ELSE (SELECT CASE WHEN s.f < {n} THEN 0 ELSE s.f + 2 * s.b END FROM (SELECT {fold} AS s)) END AS BIGINT)"
    )


SQL = {
    "fuzzy_score": f"SELECT p_partkey, {_score('pt', 'lower(p_name)')} AS score_pt, {_score('part', 'lower(p_name)')} AS score_part, {_score('a2', 'lower(p_name)')} AS score_a2 FROM part",
    "fuzzy_pruned": " UNION ALL ".join(f"(SELECT '{q}' AS query, c_custkey, score FROM (SELECT c_custkey, {_score(q, 'lower(c_name)')} AS score FROM customer) WHERE score > 0 ORDER BY score DESC, c_custkey LIMIT 20)" for q in ("omer#", "cst15")),
    "fuzzy_topk": f"SELECT c_custkey, score FROM (SELECT c_custkey, {_score('Cst15', 'c_name')} AS score FROM customer) WHERE score > 0 ORDER BY score DESC, c_custkey LIMIT 20",
    "exact_else_fuzzy": f"""SELECT '7' AS query, CAST(s_suppkey AS VARCHAR) AS id, CAST(1000 AS BIGINT) AS score FROM supplier WHERE s_suppkey = 7
        UNION ALL (SELECT 'ier#0000', CAST(s_suppkey AS VARCHAR), score FROM (SELECT s_suppkey, greatest({_score('ier#0000', 'lower(s_name)')}, {_score('ier#0000', "(lower(s_name) || '.example')")}) AS score FROM supplier)
        WHERE score > 0 ORDER BY score DESC, s_suppkey LIMIT 20)""",
    "find_models": f"SELECT CAST(p_partkey AS VARCHAR) AS id, score FROM (SELECT p_partkey, greatest({_score('dium', 'lower(p_type)')}, {_score('dium', 'lower(p_name)')}) AS score FROM part) WHERE score > 0",
    "workspace_filter": """WITH r AS (SELECT c_custkey, c_custkey % 3 = 0 AS personal, c_nationkey, c_mktsegment FROM customer)
        SELECT 'Personal' AS workspace, c_custkey FROM r WHERE personal UNION ALL SELECT '7', c_custkey FROM r WHERE NOT personal AND c_nationkey = 7
        UNION ALL SELECT 'building', c_custkey FROM r WHERE NOT personal AND c_mktsegment = 'BUILDING' UNION ALL SELECT 'U3@x.example', c_custkey FROM r WHERE personal AND c_nationkey = 3""",
    "contains_filter": "SELECT p_partkey, p_name FROM part WHERE contains(lower(p_name), 'wid')",
    "suggestions_top20": "SELECT DISTINCT p_name FROM part WHERE p_name > 'P' ORDER BY p_name LIMIT 20",
    "name_match": "SELECT p_partkey, p_name FROM part WHERE lower(replace(p_name, ' ', '')) = 'smallwidget'",
    "paged_stream": "SELECT o_orderkey // 250 AS page, count(*) AS n, min(o_orderkey) AS first, max(o_orderkey) AS last FROM orders GROUP BY 1",
    "paged_scan": "SELECT o_orderkey // 100 AS page, count(*) AS n, min(o_orderkey) AS first, max(o_orderkey) AS last FROM orders GROUP BY 1",
    "script_order": """SELECT filename, row_number() OVER (PARTITION BY user_id ORDER BY replace(filename, '_', ' ')) AS place FROM (SELECT user_id, event_id || '_' || CASE WHEN event_id % 2 = 0 THEN upper(event_type) ELSE event_type END || '.js' AS filename FROM events)""",
    "workspace_projects": f"""WITH r AS (SELECT c_custkey AS c, c_name, least(CASE WHEN c_custkey % 10 IN (SELECT s_suppkey FROM supplier) THEN c_custkey % 10 ELSE 99 END, CASE WHEN (c_custkey + 3) % 7 IN (SELECT s_suppkey FROM supplier) THEN (c_custkey + 3) % 7 ELSE 99 END) AS w FROM customer WHERE c_custkey % 5 <> 0)
        SELECT c AS id, c_name AS name, CASE WHEN c % 3 = 0 THEN lower(c_name) || '.com' WHEN c % 4 = 0 THEN 'sub' || c || '{search.SUFFIX}' ELSE c || '{search.SUFFIX}' END AS domain, s_name AS workspace FROM r JOIN supplier ON s_suppkey = w""",
    "workspace_sites": "SELECT s_suppkey AS workspace_id, s_name AS name, count(*) AS n_sites FROM supplier JOIN customer ON c_custkey % 120 = s_suppkey WHERE c_custkey % 5 <> 0 AND c_custkey % 7 > 0 GROUP BY 1, 2",
    "models_of_sort": "SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'block' ELSE 'model' END AS sort FROM part",
    "primary_environment": "SELECT o_orderkey AS id, true AS is_primary, o_orderkey AS ord FROM orders WHERE o_orderstatus = 'P' AND o_orderkey % 7 = 3 ORDER BY 1 LIMIT 1",
    "field_details": """SELECT p_partkey, level, attributes, relationships FROM part, (VALUES ('basic', 'label', ''), ('complete', 'appearance,default_value,label,position,validators', 'fieldset'), ('basic-validators', 'label,validators', '')) v(level, attributes, relationships)""",
    "relaxed_json": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_type AS kind FROM events",
    "script_names": "SELECT p_partkey, (p_partkey + 1700000000) || '_add' || string_agg(upper(w[1]) || w[2:], '' ORDER BY i) || '.ts' AS name FROM (SELECT p_partkey, unnest(string_split(lower(p_type), ' ')) AS w, generate_subscripts(string_split(lower(p_type), ' '), 1) AS i FROM part) GROUP BY 1",
    "domain_coalesce": """WITH d AS (SELECT page_id, regexp_extract(url, '://([^/?#]*)', 1) AS host FROM pages), e AS (SELECT page_id, CASE WHEN host = '' OR starts_with(host, 'm.') THEN 'page-' || page_id || '.example.com' ELSE host END AS d FROM d)
        SELECT page_id, CASE WHEN ends_with(d, '.example.com') THEN substr(d, 1, length(d) - 12) ELSE d END AS domain FROM e""",
}

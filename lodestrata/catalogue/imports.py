"""Types, keys, values, validators and text rewriting of an import, over the input tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import documents, etl, maps, names, text
from ..sources import sinks
from ..session import table

_PAIRS = {"the": "TH-E", "en": "", "de": "d$1e"}
_SIZES = {"thumb": (150, 150), "medium": (300, 200), "large": (1024, 768)}


def api_key_model(spark, sf_dir):
    name = F.concat(F.col("p_type"), F.lit(" "), "p_partkey")
    return table(spark, sf_dir, "part").select("p_partkey", names.model_key(F.initcap(name)).alias("key"))


def api_key_field(spark, sf_dir):
    name = F.concat(F.lower("event_type"), F.when(F.col("event_id") % 2 == 0, "EventId").otherwise("")).alias("name")
    rows = table(spark, sf_dir, "events").select("event_id", name, F.when(F.col("event_id") % 5 == 0, "itemType").otherwise(name).alias("field"))
    return rows.select("event_id", names.field_key(F.col("field")).alias("key"))


def type_map(spark, sf_dir):
    kinds = F.array(*map(F.lit, ("Symbol", "Text", "Integer", "Number", "Date", "Location", "Boolean", "Object", "RichText", "Link", "Array", "Other")))
    targets = F.array(F.lit("Entry"), F.lit("Asset"), F.lit("Symbol"))
    rows = table(spark, sf_dir, "events").select("event_id", F.element_at(kinds, (F.col("event_id") % 12 + 1).cast("int")).alias("kind"), F.element_at(targets, (F.col("event_id") % 5 % 3 + 1).cast("int")).alias("to"))
    return rows.select("event_id", "kind", "to", etl.field_type(F.col("kind"), F.col("to"), F.col("to"), F.col("event_id") % 7 == 0).alias("mapped"))


def value_convert(spark, sf_dir):
    """Events' values as each target type stores them."""
    targets = F.array(*map(F.lit, ("string", "links", "file", "integer", "lat_lon")))
    k = F.get_json_object("props", "$.k")
    target = F.element_at(targets, (F.col("event_id") % 5 + 1).cast("int"))
    value = F.when(target == "string", F.concat(F.lit('["a","b'), k, F.lit('"]'))).when(target == "lat_lon", F.concat(F.lit('{"lat":1.5,"lon":'), k, F.lit(".5}"))).otherwise(k)
    return table(spark, sf_dir, "events").select("event_id", etl.value_text(target, value).alias("value"))


def validators(spark, sf_dir):
    low, high = F.col("p_size") % 10, F.col("p_size") % 15
    b = etl.bounds(low, high)
    return table(spark, sf_dir, "part").select("p_partkey", *[b[k].cast("long").alias(k) for k in ("eq", "min", "max")], etl.range_json(low, high).alias("json"))


def rewrite_first(spark, sf_dir):
    pairs = F.array(*[F.struct(F.lit(a).alias("old"), F.lit(b).alias("new")) for a, b in _PAIRS.items()])
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(text.rewrite_first(F.col("text"), pairs).cast("binary")).alias("md5"))


def rewrite_all_ci(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(text.rewrite_all(F.col("text"), _PAIRS).cast("binary")).alias("md5"))


def thumb_explode(spark, sf_dir):
    sizes = F.array(*[F.struct(F.lit(k).alias("size"), F.lit(f"?w={w}&h={h}&fit=crop").alias("query")) for k, (w, h) in _SIZES.items()])
    return table(spark, sf_dir, "pages").select("page_id", F.inline(sizes), "url").select("page_id", "size", F.concat("url", "query").alias("derived"))


def locale_pivot(spark, sf_dir):
    """Documents of each source by language."""
    rows = table(spark, sf_dir, "documents").groupBy("source").pivot("lang", ["de", "en", "es", "fr"]).agg(F.count("doc_id"))
    return rows.na.fill(0)


def locale_defaults(spark, sf_dir):
    """The default of a localised value for the languages of each source."""
    langs = table(spark, sf_dir, "documents").groupBy("source").agg(F.array_sort(F.collect_set("lang")).alias("langs"))
    return langs.select("source", maps.locale_nulls(F.col("langs")).alias("default"))


def validator_overlay(spark, sf_dir):
    """Validators added to those there are: the new ones count."""
    old = F.create_map(F.lit("required"), F.lit("{}"), F.lit("size"), F.col("p_size").cast("string"))
    new = F.create_map(F.lit("size"), (F.col("p_size") + 1).cast("string"), F.lit("unique"), F.lit("{}"))
    both = maps.overlay(old, F.when(F.col("p_partkey") % 2 == 0, new).otherwise(F.create_map().cast("map<string,string>")))
    body = F.array_join(F.transform(F.array_sort(F.map_entries(both)), lambda e: F.concat_ws("=", e["key"], e["value"])), ",")
    return table(spark, sf_dir, "part").select("p_partkey", body.alias("validators"))


def dotted_projection(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("props_k"), F.year("ts").cast("long").alias("ts_year"))


def detail_levels(spark, sf_dir):
    """Parts with the details that a level asks for; the rest is null."""
    full = F.col("p_partkey") % 2 == 0
    return table(spark, sf_dir, "part").select("p_partkey", "p_name", F.when(full, F.col("p_type")).alias("p_type"), F.when(full & (F.col("p_size") > 10), F.col("p_size")).alias("p_size"))


def html_titles(spark, sf_dir):
    """Pages as target rows: title out of the markup, slug out of the address, and whether there is a description."""
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    slug = F.regexp_replace(F.lower(F.regexp_extract("url", "://[^/?#]*([^?#]*)", 1)), "[^a-z0-9]+", "-")
    return table(spark, sf_dir, "pages").select("page_id", title.alias("title"), slug.alias("slug"), F.contains("html", F.lit("<p")).alias("has_text"))


def structured_nodes(spark, sf_dir):
    """Turns of conversations as document nodes that point to documents, rewritten for the target."""
    kinds = F.array(*map(F.lit, (documents.INLINE_ENTRY, documents.BLOCK_ENTRY, documents.ENTRY_LINK, documents.ASSET_LINK, documents.BLOCK_ASSET, "paragraph")))
    parents = F.array(F.lit("root"), F.lit("paragraph"), F.lit("listItem"))
    talk = table(spark, sf_dir, "conversations").select("conv_id", "turn").distinct()
    at = F.col("conv_id") * 7 + F.col("turn")
    nodes = talk.select(F.col("conv_id").alias("document"), F.col("turn").alias("path"), F.element_at(kinds, (at % 6 + 1).cast("int")).alias("type"), F.element_at(parents, (at % 5 % 3 + 1).cast("int")).alias("parent"), (at % 400).alias("target"))
    targets = table(spark, sf_dir, "documents").where("lang <> 'de'").select(F.col("doc_id").alias("source"), F.concat(F.lit("i"), "doc_id").alias("id"), F.col("lang").alias("model"))
    return documents.rewrite(nodes, targets, ("en", "fr"))


def structured_documents(spark, sf_dir):
    """Conversations as documents, whose turns are paragraphs, headings with links, embedded entries and rules, made into new documents."""
    talk = table(spark, sf_dir, "conversations").select("conv_id", "turn").distinct()
    at = F.col("conv_id") * 7 + F.col("turn")
    data = F.concat(F.lit('"data":{"target":{"sys":{"id":"e'), at % 230, F.lit('"}}}'))
    text_ = F.concat(F.lit('{"nodeType":"text","value":"T'), "turn", F.lit('","marks":[{"type":"bold"}]}'))
    link = F.concat(F.lit('{"nodeType":"entry-hyperlink",'), data, F.lit(',"content":[{"nodeType":"text","value":"go","marks":[]}]}'))
    node = (
        F.when(at % 4 == 0, F.concat(F.lit('{"nodeType":"paragraph","content":['), text_, F.lit("]}"))).when(at % 4 == 1, F.concat(F.lit('{"nodeType":"embedded-entry-block",'), data, F.lit(',"content":[]}')))
        .when(at % 4 == 2, F.concat(F.lit('{"nodeType":"heading-2","content":['), text_, F.lit(","), link, F.lit("]}"))).otherwise('{"nodeType":"hr","content":[]}')
    )
    rows = talk.select("conv_id", F.struct("turn", node.alias("node")).alias("n")).groupBy(F.col("conv_id").alias("document")).agg(F.array_join(F.transform(F.array_sort(F.collect_list("n")), lambda x: x["node"]), ",").alias("inner"))
    docs = rows.select("document", F.concat(F.lit('{"nodeType":"document","content":['), "inner", F.lit("]}")).alias("body"))
    targets = table(spark, sf_dir, "documents").where("lang <> 'de'").select(F.concat(F.lit("e"), "doc_id").alias("source"), F.concat(F.lit("i"), "doc_id").alias("id"), F.col("lang").alias("model"), F.lit(None).cast("string").alias("url"))
    return documents.convert(docs, targets, ("en", "fr"))


def asset_metadata(spark, sf_dir):
    """Texts of assets by field and language: documents of a source are an asset's versions."""
    first = table(spark, sf_dir, "documents").groupBy((F.col("doc_id") % 50).alias("asset"), "lang").agg(F.min("doc_id").alias("n"))
    rows = first.select("asset", F.col("lang").alias("locale"), F.concat(F.lit("title "), "n").alias("title"), F.when(F.col("n") % 2 == 0, F.concat(F.lit("alt "), "n")).alias("alt"))
    out = maps.by_locale(rows, "asset", "locale", "title", "alt")
    text_ = lambda c: F.array_join(F.transform(F.array_sort(F.map_entries(c)), lambda e: F.concat_ws("=", e["key"], F.coalesce(e["value"], F.lit("-")))), ",").alias(c)
    return out.select("asset", text_("title"), text_("alt"))


def field_validators(spark, sf_dir):
    """Validators of parts taken for fields of several types."""
    targets = F.array(*map(F.lit, ("string", "integer", "file", "links", "json")))
    size = F.col("p_size").cast("string")
    body = F.concat(F.lit('[{"size":{"min":'), size, F.lit(',"max":30},"unique":true,"in":["a","b"],"range":{"min":0,"max":'), size, F.lit('.0},"assetFileSize":{"max":'), size, F.lit("}}]"))
    target = F.element_at(targets, (F.col("p_partkey") % 5 + 1).cast("int"))
    made = etl.field_validators(target, F.col("p_partkey") % 2 == 0, F.from_json(body, etl.VALIDATIONS))
    text_ = F.array_join(F.transform(F.array_sort(F.map_entries(made)), lambda e: F.concat_ws("=", e["key"], e["value"])), ";")
    return table(spark, sf_dir, "part").select("p_partkey", text_.alias("validators"))


def more_validators(spark, sf_dir):
    """Validators of dates, slugs and galleries, with one end missing in some."""
    target = F.element_at(F.array(*map(F.lit, ("date_time", "slug", "gallery"))), (F.col("p_partkey") % 3 + 1).cast("int"))
    day = F.concat(F.lit("2026-06-"), F.lpad((F.col("p_size") % 28 + 1).cast("string"), 2, "0"), F.lit("T01:00:00Z"))
    dates = F.concat(F.lit('{"min":"'), day, F.lit('"'), F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit(',"max":"'), day, F.lit('"'))).otherwise(""), F.lit("}"))
    body = F.concat(F.lit('[{"dateRange":'), dates, F.lit('},{"regexp":"^a"},{"regexp":"^b"},{"size":{"min":1,"max":3}}]'))
    made = etl.field_validators(target, F.col("p_partkey") % 2 == 0, F.from_json(body, etl.VALIDATIONS))
    text_ = F.array_join(F.transform(F.array_sort(F.map_entries(made)), lambda e: F.concat_ws("=", e["key"], e["value"])), ";")
    return table(spark, sf_dir, "part").select("p_partkey", text_.alias("validators"))


def asset_insert(spark, sf_dir):
    """Documents to upload: the first of each content that the target doesn't have."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.md5(F.col("text").cast("binary")).alias("md5"))
    return sinks.to_insert(docs, docs.where("doc_id % 4 = 0").select("md5"), "md5", "doc_id")


def call_log(spark, sf_dir):
    """Log lines of events by the call that they belong to."""
    line = F.concat(F.when(F.col("event_id") % 3 > 0, F.concat(F.lit("["), "user_id", F.lit("] "))).otherwise(""), "event_type")
    return table(spark, sf_dir, "events").groupBy(F.coalesce(sinks.call_of(line), F.lit("none")).alias("call")).agg(F.count("*").alias("n"))


def settings_upsert(spark, sf_dir):
    """One setting of each nation set, or taken out for every third."""
    base = F.create_map(F.lit("name"), F.col("n_name"), F.lit("region"), F.col("n_regionkey").cast("string"))
    out = F.when(F.col("n_nationkey") % 3 == 0, sinks.with_setting(base, "region", None)).otherwise(sinks.with_setting(base, "region", F.lit("x")))
    return table(spark, sf_dir, "nation").select("n_nationkey", F.try_element_at(out, F.lit("name")).alias("name"), F.try_element_at(out, F.lit("region")).alias("region"))


QUERIES = (
    api_key_model, api_key_field, type_map, value_convert, validators, rewrite_first, rewrite_all_ci, thumb_explode, locale_pivot, locale_defaults, validator_overlay, dotted_projection, detail_levels, html_titles, structured_nodes,
    structured_documents, asset_metadata, more_validators, field_validators, asset_insert, call_log, settings_upsert,
)

_K = "json_extract_string(props, '$.k')"
_FIRST = "text"
for _old, _new in _PAIRS.items():
    _FIRST = f"(SELECT CASE WHEN strpos(t, '{_old}') > 0 THEN substr(t, 1, strpos(t, '{_old}') - 1) || '{_new}' || substr(t, strpos(t, '{_old}') + {len(_old)}) ELSE t END FROM (SELECT {_FIRST} AS t))"
_ALL = "text"
for _old, _new in _PAIRS.items():
    _ALL = f"regexp_replace({_ALL}, '{_old}', '{_new}', 'gi')"
SQL = {
    "api_key_model": "SELECT p_partkey, replace(lower(p_type), ' ', '_') || '_model' AS key FROM part",
    "api_key_field": """SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'item_type_field' ELSE lower(event_type) || CASE WHEN event_id % 2 = 0 THEN '_event_id' ELSE '' END END AS key FROM events""",
    "type_map": """WITH r AS (SELECT event_id, (['Symbol','Text','Integer','Number','Date','Location','Boolean','Object','RichText','Link','Array','Other'])[event_id % 12 + 1] AS kind, (['Entry','Asset','Symbol'])[event_id % 5 % 3 + 1] AS "to" FROM events)
        SELECT event_id, kind, "to", CASE kind WHEN 'Symbol' THEN CASE WHEN event_id % 7 = 0 THEN 'slug' ELSE 'string' END WHEN 'Text' THEN 'text' WHEN 'Integer' THEN 'integer' WHEN 'Number' THEN 'float' WHEN 'Date' THEN 'date_time'
        WHEN 'Location' THEN 'lat_lon' WHEN 'Boolean' THEN 'boolean' WHEN 'Object' THEN 'json' WHEN 'RichText' THEN 'structured_text'
        WHEN 'Link' THEN CASE "to" WHEN 'Entry' THEN 'link' WHEN 'Asset' THEN 'file' ELSE 'string' END WHEN 'Array' THEN CASE "to" WHEN 'Asset' THEN 'gallery' WHEN 'Entry' THEN 'links' ELSE 'string' END ELSE 'string' END AS mapped FROM r""",
    "value_convert": f"""SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'a, b' || {_K} WHEN 1 THEN '[]' WHEN 2 THEN NULL WHEN 3 THEN {_K} ELSE '{{"latitude":1.5,"longitude":' || {_K} || '.5}}' END AS value FROM events""",
    "validators": """WITH r AS (SELECT p_partkey, CAST(nullif(p_size % 10, 0) AS BIGINT) AS lo, CAST(nullif(p_size % 15, 0) AS BIGINT) AS hi FROM part), v AS (SELECT p_partkey, CASE WHEN lo = hi THEN lo END AS eq, CASE WHEN lo IS DISTINCT FROM hi THEN lo END AS min,
        CASE WHEN lo IS DISTINCT FROM hi THEN hi END AS max FROM r) SELECT *, '{' || concat_ws(',', '"eq":' || eq, '"min":' || min, '"max":' || max) || '}' AS json FROM v""",
    "rewrite_first": f"SELECT doc_id, md5({_FIRST}) AS md5 FROM documents",
    "rewrite_all_ci": f"SELECT doc_id, md5({_ALL}) AS md5 FROM documents",
    "thumb_explode": "SELECT page_id, size, url || query AS derived FROM pages, (VALUES ('thumb', '?w=150&h=150&fit=crop'), ('medium', '?w=300&h=200&fit=crop'), ('large', '?w=1024&h=768&fit=crop')) s(size, query)",
    "locale_pivot": "SELECT source, count(*) FILTER (WHERE lang = 'de') AS de, count(*) FILTER (WHERE lang = 'en') AS en, count(*) FILTER (WHERE lang = 'es') AS es, count(*) FILTER (WHERE lang = 'fr') AS fr FROM documents GROUP BY 1",
    "locale_defaults": """SELECT source, CASE WHEN count(DISTINCT lang) = 1 THEN 'null' ELSE '{' || string_agg(DISTINCT '"' || lang || '":null', ',' ORDER BY '"' || lang || '":null') || '}' END AS "default" FROM documents GROUP BY 1""",
    "validator_overlay": "SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'required={},size=' || (p_size + 1) || ',unique={}' ELSE 'required={},size=' || p_size END AS validators FROM part",
    "dotted_projection": f"SELECT event_id, CAST({_K} AS BIGINT) AS props_k, year(ts) AS ts_year FROM events",
    "detail_levels": "SELECT p_partkey, p_name, CASE WHEN p_partkey % 2 = 0 THEN p_type END AS p_type, CASE WHEN p_partkey % 2 = 0 AND p_size > 10 THEN p_size END AS p_size FROM part",
    "html_titles": """SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, regexp_replace(lower(regexp_extract(url, '://[^/?#]*([^?#]*)', 1)), '[^a-z0-9]+', '-', 'g') AS slug, contains(html, '<p') AS has_text FROM pages""",
    "structured_nodes": """WITH n AS (SELECT DISTINCT conv_id AS document, turn AS path, conv_id * 7 + turn AS pos FROM conversations),
        m AS (SELECT document, path, (['embedded-entry-inline','embedded-entry-block','entry-hyperlink','asset-hyperlink','embedded-asset-block','paragraph'])[pos % 6 + 1] AS type, pos % 5 % 3 = 1 AS inl, pos % 5 % 3 = 0 AS blk, pos % 400 AS target FROM n),
        r AS (SELECT m.*, d.doc_id, d.lang IN ('en', 'fr') AS ok FROM m LEFT JOIN (SELECT * FROM documents WHERE lang <> 'de') d ON doc_id = target),
        o AS (SELECT *, CASE type WHEN 'embedded-entry-inline' THEN CASE WHEN doc_id IS NULL OR NOT ok THEN 'dropped' WHEN inl THEN 'inlineItem' ELSE 'span' END
            WHEN 'embedded-entry-block' THEN CASE WHEN doc_id IS NULL THEN 'span' WHEN NOT ok THEN 'dropped' WHEN inl THEN 'inlineItem' ELSE 'paragraph>inlineItem' END
            WHEN 'entry-hyperlink' THEN CASE WHEN doc_id IS NOT NULL AND inl THEN 'itemLink' ELSE 'children' END
            WHEN 'asset-hyperlink' THEN CASE WHEN doc_id IS NULL THEN 'dropped' WHEN inl THEN 'link' ELSE 'children' END
            WHEN 'embedded-asset-block' THEN CASE WHEN doc_id IS NULL THEN 'span' WHEN blk THEN 'block' ELSE 'dropped' END ELSE type END AS new_type FROM r)
        SELECT document, path, type, new_type, CASE WHEN new_type IN ('inlineItem', 'paragraph>inlineItem', 'itemLink', 'link', 'block') THEN 'i' || doc_id END AS new_target FROM o""",
    "structured_documents": """WITH n AS (SELECT DISTINCT conv_id, turn, conv_id * 7 + turn AS pos FROM conversations), m AS (SELECT n.*, d.doc_id, d.lang IN ('en', 'fr') AS ok FROM n LEFT JOIN (SELECT * FROM documents WHERE lang <> 'de') d ON d.doc_id = pos % 230),
        j AS (SELECT conv_id, turn, '{"marks":["strong"],"type":"span","value":"T' || turn || '"}' AS span, pos % 4 AS kind, doc_id, ok, pos % 230 AS t FROM m),
        o AS (SELECT *, CASE kind WHEN 0 THEN '{"children":[' || span || '],"type":"paragraph"}'
            WHEN 1 THEN CASE WHEN doc_id IS NULL THEN '{"type":"span","value":"** missing or inaccessible: e' || t || ' **"}' WHEN ok THEN '{"children":[{"item":"i' || doc_id || '","type":"inlineItem"}],"type":"paragraph"}' END
            WHEN 2 THEN '{"children":[' || span || ',' || CASE WHEN doc_id IS NULL THEN '{"type":"span","value":"go"}' ELSE '{"children":[{"type":"span","value":"go"}],"item":"i' || doc_id || '","type":"itemLink"}' END || '],"level":2,"type":"heading"}'
            ELSE '{"type":"thematicBreak"}' END AS part FROM j)
        SELECT conv_id AS document, '{"document":{"children":[' || coalesce(string_agg(part, ',' ORDER BY turn), '') || '],"type":"root"},"schema":"dast"}' AS body FROM o GROUP BY 1""",
    "asset_metadata": """WITH f AS (SELECT doc_id % 50 AS asset, lang, min(doc_id) AS n FROM documents GROUP BY 1, 2) SELECT asset, string_agg(lang || '=title ' || n, ',' ORDER BY lang) AS title, string_agg(lang || '=' || CASE WHEN n % 2 = 0 THEN 'alt ' || n ELSE '-' END, ',' ORDER BY lang) AS alt FROM f GROUP BY 1""",
    "more_validators": """WITH r AS (SELECT p_partkey, '2026-06-' || lpad(CAST(p_size % 28 + 1 AS VARCHAR), 2, '0') || 'T01:00:00Z' AS d, CASE WHEN p_partkey % 2 = 0 THEN 'required={}' END AS req FROM part)
        SELECT p_partkey, coalesce(CASE p_partkey % 3 WHEN 0 THEN concat_ws(';', 'date_time_range={"min":"' || d || '","max":' || CASE WHEN p_partkey % 2 = 0 THEN '"' || d || '"' ELSE 'null' END || '}', req)
            WHEN 1 THEN concat_ws(';', 'format={"custom_pattern":"^b"}', 'length={"min":1,"max":3}', req) ELSE 'size={"min":1,"max":3}' END, '') AS validators FROM r""",
    "field_validators": """WITH r AS (SELECT p_partkey, p_partkey % 5 AS t, CASE WHEN p_partkey % 2 = 0 THEN 'required={}' END AS req, nullif(p_size, 0) AS s FROM part)
        SELECT p_partkey, coalesce(CASE t WHEN 0 THEN concat_ws(';', 'enum={"values":["a","b"]}', 'length=' || CASE WHEN s = 30 THEN '{"eq":30}' ELSE '{' || concat_ws(',', '"min":' || s, '"max":30') || '}' END, req, 'unique={}')
            WHEN 1 THEN concat_ws(';', 'number_range={' || coalesce('"max":' || s || '.0', '') || '}', req) WHEN 2 THEN concat_ws(';', 'file_size={"max_value":' || s || ',"max_unit":"B"}', req)
            WHEN 3 THEN 'size=' || CASE WHEN s = 30 THEN '{"eq":30}' ELSE '{' || concat_ws(',', '"min":' || s, '"max":30') || '}' END ELSE req END, '') AS validators FROM r""",
    "asset_insert": "SELECT md5(text) AS md5, min(doc_id) AS doc_id FROM documents WHERE md5(text) NOT IN (SELECT md5(text) FROM documents WHERE doc_id % 4 = 0) GROUP BY 1",
    "call_log": "SELECT CASE WHEN event_id % 3 > 0 THEN CAST(user_id AS VARCHAR) ELSE 'none' END AS call, count(*) AS n FROM events GROUP BY 1",
    "settings_upsert": "SELECT n_nationkey, n_name AS name, CASE WHEN n_nationkey % 3 <> 0 THEN 'x' END AS region FROM nation",
}

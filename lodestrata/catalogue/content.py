"""Imports of typed content and of blogs over the input tables: orders are types, events entries, documents posts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.canonical import json_string
from ..plans import content, posts
from ..session import table
from ..sources import target
from ..sources.folders import new_path

_KINDS = ("Symbol", "Text", "Link", "Array", "RichText", "Link", "Integer")


def _t(key: Column | str) -> Column:
    return F.concat(F.lit("t"), (F.col(key) if isinstance(key, str) else key).cast("string"))


def _types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as types, their lines as fields. Lines are dealt by order once, which serves both groupings and every reading."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").repartition("l_orderkey")
    line = rows.groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("p"), F.min("l_suppkey").alias("s"))
    lines = F.sort_array(F.collect_list(F.struct("l_linenumber", "p", "s")))
    fields = F.transform("lines", lambda x: _field(F.col("l_orderkey"), x["l_linenumber"], x["p"], x["s"]).cast(content.FIELD))
    return line.groupBy("l_orderkey").agg(lines.alias("lines")).select(_t("l_orderkey").alias("type_id"), F.concat(F.lit("Order "), "l_orderkey").alias("name"), F.lit("f1").alias("display"), fields.alias("fields"))


def _field(k: Column, n: Column, p: Column, s: Column) -> Column:
    """A line as a field, by the numbers of its order, itself, its part and its supplier."""
    null = F.lit(None).cast("array<string>")
    kind = F.element_at(F.array(*map(F.lit, _KINDS)), (p % 7 + 1).cast("int"))
    two = F.array(_t(k + 1), _t(k * 2))
    links = F.when(s % 3 == 0, null).when(s % 3 == 1, F.array().cast("array<string>")).otherwise(two)
    one = F.when(kind == "Link", F.when(p % 7 == 2, "Entry").otherwise("Asset"))
    return F.struct(
        F.concat(F.lit("f"), n).alias("id"), F.concat(F.lit("N"), n).alias("name"), kind.alias("type"), one.alias("link"), (p % 2 == 0).alias("localized"), (p % 3 == 0).alias("required"),
        F.when(kind == "Array", "Link").alias("item_type"), F.when(kind == "Array", "Entry").alias("item_link"), F.when(kind == "Link", links).alias("links"), F.when(kind == "Array", links).alias("item_links"),
        F.when(s % 4 == 1, F.array().cast("array<string>")).when(s % 4 > 1, F.array(_t(k))).alias("blocks"), F.when(s % 2 == 1, F.array(_t(k), _t(k + 1))).alias("inlines"),
    )


def _controls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two controls for each second field, of which the first counts."""
    line = table(spark, sf_dir, "lineitem").where("l_linenumber % 2 = 1").select("l_orderkey", "l_linenumber").distinct()
    each = line.select("l_orderkey", "l_linenumber", F.explode(F.array(F.lit(0), F.lit(1))).alias("ord"))
    slug = (F.col("l_orderkey") + F.col("ord")) % 2 == 0
    return each.select(_t("l_orderkey").alias("type_id"), F.concat(F.lit("f"), "l_linenumber").alias("field_id"), "ord", F.when(slug, "slugEditor").otherwise("markdown").alias("widget"), F.when(slug, "f1").otherwise("f2").alias("tracking"))


def _made(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").where("o_orderkey % 5 <> 0").select(_t("o_orderkey").alias("type_id"), F.concat(F.lit("m"), "o_orderkey").alias("id"))


def import_models(spark, sf_dir):
    """The models of some types, all alike but for key and name."""
    types = content.only(_types(spark, sf_dir), "type_id", "t1,t2, t3,t5")
    out = content.models(types)
    return out.select("type_id", "api_key", "name", F.size("attributes").alias("n"), F.element_at("attributes", F.lit("draft_mode_active")).alias("draft"))


def import_fields(spark, sf_dir):
    """Every field as it is to be made."""
    out = content.describe(_types(spark, sf_dir), _controls(spark, sf_dir), _made(spark, sf_dir), "block")
    return out.withColumns({"item_types": F.array_join("item_types", ","), "blocks": F.array_join("blocks", ",")})


def slug_tracking(spark, sf_dir):
    """Fields with a control, and the field that it tracks among those that were made; all have been made."""
    rows = content.with_controls(content.fields(_types(spark, sf_dir)), _controls(spark, sf_dir)).where("widget is not null").select("type_id", "field_id", "widget", "tracking")
    created = content.fields(_types(spark, sf_dir)).select("type_id", "field_id", F.concat_ws(".", "type_id", "field_id").alias("id"))
    return content.must_have(content.tracked(rows, created), created)


def import_block(spark, sf_dir):
    """The asset block among the models, of which there is none with that key."""
    return content.block_model(table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("id"), F.lower("o_orderpriority").alias("api_key")))


def import_blocks(spark, sf_dir):
    """The asset block of each site: some have one, or several, of which the first counts; the others get a new one."""
    key = F.col("p_partkey")
    models = table(spark, sf_dir, "part").select((key % 97).alias("site"), key.cast("string").alias("id"), F.when(key % 40 == 3, content.ASSET_BLOCK).otherwise(F.lower("p_type")).alias("api_key"))
    return content.block_models(models)


def import_locales(spark, sf_dir):
    """The languages of documents in the order of their first document, and the first of those whose first document is odd."""
    rows = table(spark, sf_dir, "documents").groupBy(F.col("lang").alias("code")).agg(F.min("doc_id").alias("ord"))
    return content.locales(rows.withColumn("is_default", F.col("ord") % 2 == 1)).select(F.array_join("codes", ",").alias("codes"), "default_locale")


def _entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as entries of their users' types."""
    e, k = F.col("event_id"), F.get_json_object("props", "$.k")
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    ref = lambda n: F.concat(F.lit("e"), (e + n).cast("string"))
    asset = quoted(F.concat(F.lit("a"), k))
    en = lambda v: F.create_map(F.lit("en"), v)
    values = F.create_map(
        F.lit("word"), en(F.when(e % 4 == 0, '""').otherwise(quoted(F.col("event_type")))), F.lit("count"), F.create_map(F.lit("en"), k, F.lit("it"), (k.cast("int") % 2).cast("string")), F.lit("one"), en(quoted(ref(1))),
        F.lit("many"), F.create_map(F.lit("en"), F.concat(F.lit('["'), ref(1), F.lit('","'), ref(5), F.lit('","'), ref(1), F.lit('"]'))), F.lit("pic"), en(asset), F.lit("pics"), en(F.concat(F.lit("["), asset, F.lit(',"a1"]'))),
    )
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("e"), e.cast("string")).alias("entry_id"), F.concat(F.lit("u"), "user_id").alias("type_id"), F.col("ts").alias("created_at"), F.when(e % 3 > 0, F.col("ts")).alias("first_published_at"),
        F.when(e % 3 > 0, e).alias("published_version"), values.alias("content"),
    )


def _described(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six fields of each user's type; users of every fourth number have none."""
    users = table(spark, sf_dir, "events").where("user_id % 4 <> 3").select(F.concat(F.lit("u"), "user_id").alias("type_id")).distinct()
    rows = [("word", "string", False, None), ("count", "integer", True, None), ("one", "link", False, ["m0", "m1"]), ("many", "links", True, None), ("pic", "file", False, None), ("pics", "gallery", False, None)]
    each = F.array(*[F.struct(F.lit(k).alias("field_id"), F.lit(f"{k}_key").alias("api_key"), F.lit(t).alias("field_type"), F.lit(l).alias("localized"), F.lit(m is None).alias("unrestricted"), (F.array(*map(F.lit, m)) if m else F.lit(None).cast("array<string>")).alias("item_types")) for k, t, l, m in rows])
    return users.select("type_id", F.inline(each))


def _attribute(name: str) -> Column:
    return F.try_element_at("attributes", F.lit(name)).alias(name)


def import_records(spark, sf_dir):
    """Entries as records: falsy values are null, localised ones have all languages, links are empty."""
    out = content.records(_entries(spark, sf_dir), _described(spark, sf_dir), ["en", "it"], "en")
    return out.select("entry_id", F.col("created_at").cast("string").alias("created_at"), (F.col("first_published_at").isNotNull()).alias("dated"), "status", "has_links", *map(_attribute, ("word_key", "count_key", "one_key", "many_key")))


def imported_records(spark, sf_dir):
    """Records written to a target and published: entries without a word aren't written, but kept apart; the rest is read back."""
    path = new_path(spark)
    made = content.records(_entries(spark, sf_dir), _described(spark, sf_dir), ["en", "it"], "en")
    rows = made.select("entry_id", "status", *map(_attribute, ("word_key", "count_key")))
    rows = rows.withColumn("error", F.when(F.col("word_key") == "null", F.concat(F.lit("no word in "), "entry_id")))
    target.write(rows, path, "records", on_error=target.KEEP)
    schema = "entry_id string, status string, word_key string, count_key string"
    there = target.read(spark, path, schema)
    target.publish(there, path, "records")
    failed = target.read(spark, path, schema, failed=True).withColumn("published", F.lit(False))
    return target.with_publication(spark, path, there).withColumn("error", F.lit(None).cast("string")).unionByName(failed)


def import_updates(spark, sf_dir):
    """Every record as it is after both passes."""
    out = content.updated(content.records(_entries(spark, sf_dir), _described(spark, sf_dir), ["en", "it"], "en"), _links(spark, sf_dir))
    return out.select("entry_id", "status", *map(_attribute, ("word_key", "one_key", "many_key")))


def import_links(spark, sf_dir):
    """The second pass: links to records and assets, where they lead somewhere and may."""
    return _links(spark, sf_dir).select("entry_id", *map(_attribute, ("one_key", "many_key", "pic_key", "pics_key")))


def _links(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").where("event_id % 5 <> 0")
    made = events.select(F.concat(F.lit("e"), "event_id").alias("entry_id"), F.concat(F.lit("r"), "event_id").alias("id"), F.concat(F.lit("m"), (F.col("event_id") % 3).cast("string")).alias("model"))
    uploads = table(spark, sf_dir, "pages").select(F.concat(F.lit("a"), "page_id").alias("asset_id"), F.concat(F.lit("u"), "page_id").alias("id"))
    return content.link_values(_entries(spark, sf_dir), _described(spark, sf_dir), made, uploads, ["en", "it"], "en")


def _ids(rows: DataFrame, key: str, prefix: str, gone: int) -> DataFrame:
    return rows.where(F.col(key) % gone != 0).select(F.col(key).alias("source"), F.concat(F.lit(prefix), key).alias("id"))


def blog_fields(spark, sf_dir):
    """The fields of the five models of each site, suppliers being sites."""
    keys = F.array(*map(F.lit, posts.TARGETS))
    models = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("site"), F.explode(keys).alias("api_key")).withColumn("id", F.concat_ws("-", "site", "api_key"))
    return posts.target_fields(models).select("site", "model", "api_key", "position", "label", "field_type", "validators", F.col("appearance").isNotNull().alias("editor"))


def blog_models_gone(spark, sf_dir):
    """Of the models of a project those that an import makes."""
    names = F.element_at(F.array(*map(F.lit, ("wp_tag", "wp_page", "page", "wp_tags"))), (F.col("p_partkey") % 4 + 1).cast("int"))
    return posts.own_models(table(spark, sf_dir, "part").select("p_partkey", names.alias("api_key")))


def blog_authors(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    rows = s.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.lower("s_name").alias("slug"), F.concat(F.lit("https://x.example/"), "s_suppkey").alias("url"), F.lit("bio").alias("description"), "s_acctbal")
    return posts.authors(rows)


def blog_terms(spark, sf_dir):
    """Tags and categories."""
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.lower("p_type").alias("slug"), F.col("p_brand").alias("description"), "p_size")
    tags = posts.tags(part.where("p_size % 2 = 0")).select(F.lit("tag").alias("kind"), "*", F.lit(None).cast("string").alias("description"))
    return tags.unionByName(posts.categories(part.where("p_size % 2 = 1")).withColumn("kind", F.lit("category")))


def category_tree(spark, sf_dir):
    """New parents of categories; 0 is none."""
    part = table(spark, sf_dir, "part")
    rows = part.select(F.col("p_partkey").alias("id"), F.floor(F.col("p_partkey") / 3).alias("parent"))
    return posts.category_parents(rows, _ids(part, "p_partkey", "c", 7))


def _addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Old and new addresses of the pages' assets and of their sizes, in order."""
    sizes = F.create_map(F.lit("thumb"), F.struct(F.lit(150).alias("width"), F.lit(100).alias("height"), F.concat("url", F.lit("-t")).alias("source_url")))
    media = table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), F.col("url").alias("source_url"), sizes.alias("sizes"))
    return posts.rewritten_urls(media, _uploads(spark, sf_dir).select("source", F.concat(F.lit("https://cdn.example/"), "id").alias("url")))


def _linking(body: Column, url: Column) -> Column:
    """A text and two links to an asset: to itself, in capitals, and to a size of it."""
    return F.concat(F.coalesce(body, F.lit("")), F.lit(' <a href="'), F.coalesce(F.upper(url), F.lit("")), F.lit('">'), F.coalesce(F.concat(url, F.lit("-t")), F.lit("")), F.lit("</a>"))


def _uploads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ids(table(spark, sf_dir, "pages"), "page_id", "u", 6)


def blog_pages(spark, sf_dir):
    """Web pages as pages of a blog, which link to their assets."""
    rendered = lambda c: F.struct(c.alias("rendered"))
    p = F.col("page_id")
    rows = table(spark, sf_dir, "pages").select(
        p.alias("id"), rendered(F.col("url")).alias("title"), F.concat(F.lit("p"), p).alias("slug"), rendered(_linking(F.col("html"), F.col("url"))).alias("content"), rendered(_linking(F.substring("html", 1, 40), F.col("url"))).alias("excerpt"), (p % 13).alias("author"),
        F.when(p % 4 > 0, p % 10).otherwise(0).alias("featured_media"), F.lit("2026-01-01").alias("date"), F.when(p % 2 == 0, "publish").otherwise("draft").alias("status"),
    )
    out = posts.pages(rows, _ids(table(spark, sf_dir, "supplier"), "s_suppkey", "w", 4), _uploads(spark, sf_dir), _addresses(spark, sf_dir))
    return out.select("id", "title", "slug", F.md5("content").alias("md5"), "excerpt", "author", F.col("featured_media").isNotNull().alias("has_media"), F.col("featured_media.upload_id").alias("media"), F.col("featured_media.alt").alias("alt"), "created_at", "status")


def blog_articles(spark, sf_dir):
    """Documents as articles that link to a page's assets: categories and tags that aren't known stay as holes."""
    rendered = lambda c: F.struct(F.coalesce(c, F.lit("")).alias("rendered"))
    d = F.col("doc_id")
    docs = table(spark, sf_dir, "documents").withColumn("page", F.floor(d / 4)).join(table(spark, sf_dir, "pages").select(F.col("page_id").alias("page"), "url"), "page", "left")
    rows = docs.select(
        d.alias("id"), rendered(F.col("source")).alias("title"), F.col("lang").alias("slug"), rendered(_linking(F.col("text"), F.col("url"))).alias("content"), rendered(F.lit("the end")).alias("excerpt"), (d % 11).alias("author"),
        F.lit(0).cast("long").alias("featured_media"), F.lit("2026-01-01").alias("date"), F.lit("publish").alias("status"), F.array(d % 9, d % 14, d % 9).alias("categories"), F.array(d % 5).alias("tags"),
    )
    part = table(spark, sf_dir, "part")
    out = posts.articles(rows, _ids(table(spark, sf_dir, "supplier"), "s_suppkey", "w", 4), _ids(part, "p_partkey", "c", 7), _ids(part, "p_partkey", "g", 3), _uploads(spark, sf_dir), _addresses(spark, sf_dir))
    joined = lambda c: F.array_join(c, ",", "-").alias(c)
    return out.select("id", "title", F.md5("content").alias("md5"), "excerpt", "author", joined("categories"), joined("tags"), "status")


def blog_urls(spark, sf_dir):
    """Old and new addresses of assets and of their sizes."""
    return _addresses(spark, sf_dir).select("old", "new")


def import_texts(spark, sf_dir):
    """Conversations as records whose texts mention uploads: the first mention of each is rewritten."""
    said, page = table(spark, sf_dir, "conversations"), table(spark, sf_dir, "pages").select(F.col("page_id").alias("conv_id"), "url")
    body = F.concat_ws(" ", F.coalesce("text", F.lit("")), "url", "url", F.concat("url", F.lit("-t")))
    rows = said.join(page, "conv_id", "left").select(F.concat_ws("-", "conv_id", "turn").alias("entry_id"), "role", body.alias("body"))
    en = lambda c: F.create_map(F.lit("en"), c)
    values = F.create_map(F.lit("body"), F.create_map(F.lit("en"), json_string(F.col("body")), F.lit("it"), F.lit("7")), F.lit("note"), en(json_string(F.col("body"))))
    entries = rows.select("entry_id", F.col("role").alias("type_id"), F.lit("d").alias("created_at"), F.lit("d").alias("first_published_at"), F.lit(1).alias("published_version"), values.alias("content"))
    fields = F.array(*[F.struct(F.lit(k).alias("field_id"), F.lit(k).alias("api_key"), F.lit(t).alias("field_type"), F.lit(k == "body").alias("localized")) for k, t in (("body", "text"), ("note", "string"))])
    described = said.select(F.col("role").alias("type_id")).distinct().select("type_id", F.inline(fields))
    out = content.records(entries, described, ["en", "it"], "en", _addresses(spark, sf_dir))
    return out.select("entry_id", F.md5(F.get_json_object(F.col("attributes")["body"], "$.en")).alias("body"), F.get_json_object(F.col("attributes")["body"], "$.it").alias("it"), F.md5(F.get_json_object(F.concat(F.lit('{"v":'), F.col("attributes")["note"], F.lit("}")), "$.v")).alias("note"))


QUERIES = (
    import_models, import_fields, slug_tracking, import_block, import_blocks, import_locales, import_records, imported_records, import_links, import_updates, blog_fields, blog_models_gone, blog_authors, blog_terms, category_tree, blog_pages, blog_articles,
    blog_urls, import_texts,
)

_LINE = "(SELECT l_orderkey AS k, l_linenumber AS n, min(l_partkey) AS p, min(l_suppkey) AS s, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) - 1 AS position FROM lineitem GROUP BY 1, 2)"
_TYPE_SQL = """CASE p % 7 WHEN 0 THEN CASE WHEN n % 2 = 1 AND k % 2 = 0 THEN 'slug' ELSE 'string' END WHEN 1 THEN 'text' WHEN 2 THEN 'link' WHEN 3 THEN 'links' WHEN 4 THEN 'structured_text' WHEN 5 THEN 'file' ELSE 'integer' END"""
_NAMES = "CASE WHEN p % 7 IN (2, 3) THEN CASE WHEN s % 3 = 2 THEN [k + 1, k * 2] ELSE [] END ELSE CASE WHEN s % 4 > 1 THEN [k] ELSE [] END || CASE WHEN s % 2 = 1 THEN [k, k + 1] ELSE [] END END"
_FREE = "CASE WHEN p % 7 IN (2, 3) THEN s % 3 < 2 ELSE s % 4 = 0 END"
_PAIRS = """p AS (SELECT old, min(o) AS o, arg_max(new, o) AS new FROM (SELECT url AS old, 'https://cdn.example/u' || page_id AS new, page_id * 2 AS o FROM pages WHERE page_id % 6 <> 0
        UNION ALL SELECT url || '-t', 'https://cdn.example/u' || page_id || '?w=150&h=100&fit=crop', page_id * 2 + 1 FROM pages WHERE page_id % 6 <> 0) WHERE length(old) > 0 GROUP BY old),
        l AS (SELECT list(old || chr(1) || new ORDER BY o, old) AS l FROM p)"""
# Every pair is applied in turn: all of its occurrences whatever their case, or the first as it is written.
_REPLACED = "(SELECT list_reduce(list_prepend({}, l), lambda a, e: CASE WHEN contains(lower(a), lower(split_part(e, chr(1), 1))) THEN regexp_replace(a, regexp_escape(split_part(e, chr(1), 1)), split_part(e, chr(1), 2), 'gi') ELSE a END) FROM l)"
_FIRST = "(SELECT list_reduce(list_prepend({}, l), lambda a, e: CASE WHEN contains(a, split_part(e, chr(1), 1)) THEN substr(a, 1, strpos(a, split_part(e, chr(1), 1)) - 1) || split_part(e, chr(1), 2) || substr(a, strpos(a, split_part(e, chr(1), 1)) + length(split_part(e, chr(1), 1))) ELSE a END) FROM l)"
_LINKING = """coalesce({0}, '') || ' <a href="' || coalesce(upper({1}), '') || '">' || coalesce({1} || '-t', '') || '</a>'"""
_FIELD_ROWS = [(m, n, k, t) for m, fields in posts.TARGETS.items() for n, (k, t) in enumerate(fields.items())]
_BLOG = ", ".join(f"('{m}', {n}, '{k}', '{t}', '{posts.LABELS.get(k) or ' '.join(w.capitalize() for w in k.split('_'))}', '{posts.POINTS_TO.get(k, '')}', '{next(iter(posts.TARGETS[m]))}')" for m, n, k, t in _FIELD_ROWS)
_POINTS = """'{{"{}":{{"item_types":["' || s_suppkey || '-' || other || '"],"on_publish_with_unpublished_references_strategy":"publish_references"}}}}'"""
_E = "event_id"
_K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
_TARGET = f"CASE WHEN ({_E} + {{n}}) % 5 <> 0 AND {_E} + {{n}} <= (SELECT max({_E}) FROM events) THEN '\"r' || ({_E} + {{n}}) || '\"' END"
_UP = """'{{"upload_id":"u' || {} || '","alt":null,"title":null,"custom_data":{{}}}}'"""
_PIC = f"CASE WHEN {_K} IN (SELECT page_id FROM pages) THEN {_UP.format(_K)} END"
_AUTHOR = "CASE WHEN {0} % 4 <> 0 AND {0} IN (SELECT s_suppkey FROM supplier) THEN 'w' || {0} END"
_KNOWN = "coalesce(CASE WHEN {0} % {1} <> 0 AND {0} IN (SELECT p_partkey FROM part) THEN '{2}' || {0} END, '-')"
SQL = {
    "import_models": "SELECT DISTINCT 't' || l_orderkey AS type_id, 't' || l_orderkey || '_model' AS api_key, 'Order ' || l_orderkey AS name, CAST(8 AS INTEGER) AS n, 'true' AS draft FROM lineitem WHERE l_orderkey IN (1, 2, 5)",
    "import_fields": f"""SELECT 't' || k AS type_id, 'f' || n AS field_id, 'N' || n AS label, 'f' || n AS api_key, {_TYPE_SQL} AS field_type, p % 2 = 0 AS localized, CAST(position AS INTEGER) AS position,
        CASE p % 7 WHEN 2 THEN 'item_item_type' WHEN 3 THEN 'items_item_type' WHEN 4 THEN 'structured_text_links' END AS validator, CASE WHEN p % 7 = 4 THEN 'block' END AS blocks,
        CASE WHEN n = 1 AND p % 7 = 0 THEN '{content.TITLE_EDITOR}' END AS appearance, CASE WHEN p % 7 IN (2, 3, 4) THEN {_FREE} END AS unrestricted,
        CASE WHEN p % 7 IN (2, 3, 4) AND NOT {_FREE} THEN array_to_string(list_transform(CASE WHEN p % 7 = 4 THEN list_sort(list_distinct(list_filter(names, lambda x: x % 5 <> 0 AND x <= top))) ELSE list_filter(names, lambda x: x % 5 <> 0 AND x <= top) END, lambda x: 'm' || x), ',') END AS item_types
        FROM (SELECT *, {_NAMES} AS names, (SELECT max(o_orderkey) FROM orders) AS top FROM {_LINE})""",
    "slug_tracking": """WITH l AS (SELECT DISTINCT l_orderkey AS k, l_linenumber AS n FROM lineitem), w AS (SELECT *, CASE WHEN k % 2 = 0 THEN 1 ELSE 2 END AS t FROM l WHERE n % 2 = 1)
        SELECT 't' || k AS type_id, 'f' || n AS field_id, CASE WHEN t = 1 THEN 'slugEditor' ELSE 'markdown' END AS widget, 'f' || t AS tracking, CASE WHEN EXISTS (SELECT 1 FROM l WHERE l.k = w.k AND l.n = w.t) THEN 't' || k || '.f' || t END AS title_field_id, 't' || k || '.f' || n AS id FROM w""",
    "import_block": "SELECT 'new:structured_text_asset' AS id, 'structured_text_asset' AS api_key, count(*) >= 0 AS made FROM orders",
    "import_blocks": "SELECT p_partkey % 97 AS site, coalesce(min(CAST(p_partkey AS VARCHAR)) FILTER (WHERE p_partkey % 40 = 3), 'new:structured_text_asset') AS id, 'structured_text_asset' AS api_key, count(*) FILTER (WHERE p_partkey % 40 = 3) = 0 AS made FROM part GROUP BY 1",
    "import_locales": "WITH f AS (SELECT lang, min(doc_id) AS d FROM documents GROUP BY 1) SELECT string_agg(lang, ',' ORDER BY d) AS codes, min_by(lang, d) FILTER (WHERE d % 2 = 1) AS default_locale FROM f",
    "import_records": f"""SELECT 'e' || {_E} AS entry_id, CAST(ts AS VARCHAR) AS created_at, {_E} % 3 > 0 AS dated, CASE WHEN {_E} % 3 > 0 THEN 'published' ELSE 'draft' END AS status, true AS has_links,
        CASE WHEN {_E} % 4 = 0 THEN 'null' ELSE '"' || event_type || '"' END AS word_key, '{{"en":' || CASE WHEN {_K} = 0 THEN 'null' ELSE CAST({_K} AS VARCHAR) END || ',"it":' || CASE WHEN {_K} % 2 = 0 THEN 'null' ELSE '1' END || '}}' AS count_key,
        'null' AS one_key, '{{"en":[],"it":null}}' AS many_key FROM events WHERE user_id % 4 <> 3""",
    "imported_records": f"""SELECT 'e' || {_E} AS entry_id, CASE WHEN {_E} % 3 > 0 THEN 'published' ELSE 'draft' END AS status, CASE WHEN {_E} % 4 = 0 THEN 'null' ELSE '"' || event_type || '"' END AS word_key,
        '{{"en":' || CASE WHEN {_K} = 0 THEN 'null' ELSE CAST({_K} AS VARCHAR) END || ',"it":' || CASE WHEN {_K} % 2 = 0 THEN 'null' ELSE '1' END || '}}' AS count_key, {_E} % 3 > 0 AND {_E} % 4 > 0 AS published,
        CASE WHEN {_E} % 4 = 0 THEN 'no word in e' || {_E} END AS error FROM events WHERE user_id % 4 <> 3""",
    "import_updates": f"""SELECT 'e' || {_E} AS entry_id, CASE WHEN {_E} % 3 > 0 THEN 'published' ELSE 'draft' END AS status, CASE WHEN {_E} % 4 = 0 THEN 'null' ELSE '"' || event_type || '"' END AS word_key,
        coalesce(CASE WHEN ({_E} + 1) % 3 < 2 THEN {_TARGET.format(n=1)} END, 'null') AS one_key, '{{"en":[' || concat_ws(',', {_TARGET.format(n=1)}, {_TARGET.format(n=5)}, {_TARGET.format(n=1)}) || '],"it":[]}}' AS many_key FROM events WHERE user_id % 4 <> 3""",
    "import_links": f"""SELECT 'e' || {_E} AS entry_id, coalesce(CASE WHEN ({_E} + 1) % 3 < 2 THEN {_TARGET.format(n=1)} END, 'null') AS one_key,
        '{{"en":[' || concat_ws(',', {_TARGET.format(n=1)}, {_TARGET.format(n=5)}, {_TARGET.format(n=1)}) || '],"it":[]}}' AS many_key, coalesce({_PIC}, 'null') AS pic_key, '[' || concat_ws(',', {_PIC}, {_UP.format(1)}) || ']' AS pics_key FROM events WHERE user_id % 4 <> 3""",
    "blog_fields": f"""SELECT CAST(s_suppkey AS BIGINT) AS site, model, api_key, CAST(pos AS INTEGER) AS position, label, kind AS field_type, CASE kind WHEN 'slug' THEN '{{"slug_title_field":{{"title_field_id":"' || s_suppkey || '-' || model || '.' || first || '"}}}}'
        WHEN 'link' THEN {_POINTS.format('item_item_type')} WHEN 'links' THEN {_POINTS.format('items_item_type')} ELSE '{{}}' END AS validators, kind = 'text' AS editor FROM supplier, (VALUES {_BLOG}) v(model, pos, api_key, kind, label, other, first)""",
    "blog_models_gone": "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'wp_tag' ELSE 'wp_page' END AS api_key FROM part WHERE p_partkey % 4 < 2",
    "blog_authors": "SELECT s_suppkey AS id, s_name AS name, lower(s_name) AS slug, 'https://x.example/' || s_suppkey AS url, 'bio' AS description FROM supplier",
    "blog_terms": "SELECT CASE WHEN p_size % 2 = 0 THEN 'tag' ELSE 'category' END AS kind, p_partkey AS id, p_name AS name, lower(p_type) AS slug, CASE WHEN p_size % 2 = 1 THEN p_brand END AS description FROM part",
    "category_tree": "SELECT 'c' || p_partkey AS id, CASE WHEN p_partkey // 3 % 7 <> 0 THEN 'c' || p_partkey // 3 END AS parent_id FROM part WHERE p_partkey >= 3 AND p_partkey % 7 <> 0",
    "blog_pages": f"""WITH {_PAIRS}, m AS (SELECT *, CASE WHEN page_id % 4 > 0 THEN page_id % 10 ELSE 0 END AS media FROM pages)
        SELECT page_id AS id, url AS title, 'p' || page_id AS slug, md5({_REPLACED.format(_LINKING.format('html', 'url'))}) AS md5, {_REPLACED.format(_LINKING.format('substr(html, 1, 40)', 'url'))} AS excerpt, {_AUTHOR.format('(page_id % 13)')} AS author, media <> 0 AS has_media,
        CASE WHEN media % 6 <> 0 AND media IN (SELECT page_id FROM pages) THEN 'u' || media END AS media, CASE WHEN media <> 0 THEN url END AS alt, '2026-01-01' AS created_at, CASE WHEN page_id % 2 = 0 THEN 'published' ELSE 'draft' END AS status FROM m""",
    "blog_articles": f"""WITH {_PAIRS} SELECT doc_id AS id, source AS title, md5({_REPLACED.format(_LINKING.format('text', 'url'))}) AS md5, 'the end' AS excerpt, {_AUTHOR.format('(doc_id % 11)')} AS author,
        {_KNOWN.format('(doc_id % 9)', 7, 'c')} || ',' || {_KNOWN.format('(doc_id % 14)', 7, 'c')} || ',' || {_KNOWN.format('(doc_id % 9)', 7, 'c')} AS categories, {_KNOWN.format('(doc_id % 5)', 3, 'g')} AS tags, 'published' AS status FROM documents LEFT JOIN pages ON page_id = doc_id // 4""",
    "blog_urls": """SELECT url AS old, 'https://cdn.example/u' || page_id AS new FROM pages WHERE page_id % 6 <> 0 UNION ALL SELECT url || '-t', 'https://cdn.example/u' || page_id || '?w=150&h=100&fit=crop' FROM pages WHERE page_id % 6 <> 0""",
    "import_texts": f"""WITH {_PAIRS}, m AS (SELECT conv_id || '-' || turn AS entry_id, concat_ws(' ', coalesce(text, ''), url, url, url || '-t') AS body FROM conversations LEFT JOIN pages ON page_id = conv_id)
        SELECT entry_id, md5({_FIRST.format('body')}) AS body, '7' AS it, md5(body) AS note FROM m""",
}

"""What imports must not do as their tables grow: one task for all links to a target, one parse for each mention of a value."""

import pytest
from lodestrata.catalogue import content as catalogue
from lodestrata.functions import etl
from lodestrata.plans import content
from pyspark.sql import functions as F


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _links(spark):
    rows = [(f"e{n}", n % 2 == 0, t) for n in range(400) for t in ("1", f"{n}", None, "gone" if n % 3 else "2")]
    ids = spark.createDataFrame([(a, str(k), f"{'u' if a else 'r'}{k}", None if a else f"m{k % 3}") for a in (True, False) for k in range(300)], "of_asset boolean, target string, id string, model string")
    return spark.createDataFrame(rows, "entry_id string, of_asset boolean, target string"), ids


@pytest.mark.parametrize("hot", [1, 2, 256])
def test_common_targets_are_found_as_others(spark, monkeypatch, hot):
    monkeypatch.setattr(content, "HOT", hot)
    links, ids = _links(spark)
    text = lambda df: sorted(map(str, df.select("entry_id", "of_asset", "target", "id", "model").collect()))
    assert text(content.looked_up(links, ids)) == text(links.join(ids, ["of_asset", "target"], "left"))
    none = links.where("false")
    assert content.looked_up(none, ids).count() == 0 and content.looked_up(links, ids.where("false")).where("id is null").count() == links.count()


def test_links_to_one_target_are_in_many_tasks(spark):
    """Of a join that can't broadcast, no task has more than its share of 4,000 links to one asset."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        entries = spark.range(4000).select(F.concat(F.lit("e"), "id").alias("entry_id"), F.lit("t").alias("type_id"), F.create_map(F.lit("pic"), F.create_map(F.lit("en"), F.lit('"a1"'))).alias("content"))
        fields = spark.createDataFrame([("t", "pic", "pic", "file", False, True, None)], "type_id string, field_id string, api_key string, field_type string, localized boolean, unrestricted boolean, item_types array<string>")
        made = spark.createDataFrame([], "entry_id string, id string, model string")
        uploads = spark.createDataFrame([("a1", "u1")], "asset_id string, id string")
        seen = []
        whole = content.looked_up
        content.looked_up = lambda links, ids: seen.append(whole(links, ids)) or seen[-1]
        try:
            out = content.link_values(entries, fields, made, uploads, ["en"], "en")
        finally:
            content.looked_up = whole
        sizes = [r["count"] for r in seen[0].groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 4000 and max(sizes) < 2000
        assert {r.attributes["pic"] for r in out.collect()} == {'{"upload_id":"u1","alt":null,"title":null,"custom_data":{}}'}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_validations_are_parsed_once(spark):
    made = etl.field_validators(F.col("target"), F.lit(True), F.from_json("body", etl.VALIDATIONS))
    body = '[{"size":{"min":1,"max":3},"unique":true,"range":{"min":1.5},"dateRange":{"min":"2026-06-01T00:00:00Z"},"assetFileSize":{"max":9}}]'
    rows = spark.range(7).select(F.get(F.array(*map(F.lit, ("string", "float", "date", "file", "links", "json", "slug"))), F.col("id").cast("int")).alias("target"), F.when(F.col("id") != 6, body).alias("body"))
    out = rows.select("target", made.alias("made"))
    assert _plan(out).split("Project")[1].count("from_json") <= 1
    assert {r.target: sorted(r.made) for r in out.collect()} == {"string": ["length", "required", "unique"], "float": ["number_range", "required"], "date": ["date_time_range", "required"], "file": ["file_size", "required"], "links": ["size"], "json": ["required"], "slug": ["required"]}


def test_fields_are_read_once_for_their_models(spark):
    """The lists of models are looked up in one join, and their fields aren't read again to join what else is known of them."""
    types = spark.range(50).select(
        F.concat(F.lit("t"), "id").alias("type_id"), F.lit("f0").alias("display"),
        F.transform(F.sequence(F.lit(0), F.lit(5)), lambda n: F.struct(F.concat(F.lit("f"), n).alias("id"), F.lit("N").alias("name"), F.when(n < 4, "RichText").otherwise("Link").alias("type"), F.lit("Entry").alias("link"), F.lit(True).alias("localized"), F.lit(True).alias("required"), F.lit(None).cast("string").alias("item_type"), F.lit(None).cast("string").alias("item_link"),
            F.when(n == 5, F.array(F.lit("t1"), F.lit("t99"), F.lit("t2"), F.lit("t1"))).alias("links"), F.lit(None).cast("array<string>").alias("item_links"), F.when(n == 1, F.array().cast("array<string>")).when(n > 1, F.array(F.lit("t2"), F.lit("t1"))).alias("blocks"), F.when(n == 3, F.array(F.lit("t1"))).alias("inlines"))).cast(f"array<{content.FIELD}>").alias("fields"),
    )
    made = spark.range(50).select(F.concat(F.lit("t"), "id").alias("type_id"), F.concat(F.lit("m"), "id").alias("id"))
    out = content.linked_models(content.fields(types), made)
    assert _plan(out).count("Join") == 1
    got = {(r.field_id, r.unrestricted, None if r.item_types is None else tuple(r.item_types)) for r in out.collect()}
    assert out.count() == 300 and got == {("f0", True, None), ("f1", False, ()), ("f2", False, ("m2", "m1")), ("f3", False, ("m2", "m1")), ("f4", True, None), ("f5", False, ("m1", "m2", "m1"))}


def test_lines_are_dealt_once_for_their_types(spark):
    assert _plan(catalogue._types(spark, "/root/testdata/sf0.001")).count("Exchange") == 1

"""Environments by manifests: forks copy nothing, and a diff reads what differs."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from lodestrata.plans import diff, forks
from lodestrata.sources import environments

ENTITY = "kind string, id string, ord long, owner string, attributes map<string,string>, relationships map<string,string>, meta map<string,string>"


def catalog(spark, changed=()):
    rows = []
    for k in range(200):
        rows.append(("item_type", f"m{k}", k, None, {"name": f'"n{k}{"!" if k in changed else ""}"', "x": '{"b":1,"a":2.0}'}, {}, {}))
        rows += [("field", f"f{k}_{j}", 10 * k + j, f"m{k}", {"field_type": '"string"', "position": str(j + 1)}, {}, {}) for j in range(3)]
    rows += [("workflow", f"w{k}", k, None, {"name": f'"w{k}"'}, {}, {}) for k in range(50)]
    rows += [("site", "1", 1, None, {"locales": '["en"]'}, {}, {}), ("menu_item", "a", 1, None, {"label": '"a"', "position": "1"}, {}, {})]
    return spark.createDataFrame(rows, ENTITY)


def files(path):
    return sorted(os.path.join(d, f) for d, _, names in os.walk(f"{path}/data") for f in names if f.endswith(".parquet"))


def test_forks(spark, tmp_path):
    path = f"{tmp_path}/e"
    assert environments.listed(spark, path) == []
    first = environments.save(catalog(spark), path, "main")
    written = files(path)
    assert 50 < len(first) <= environments.BUCKETS and environments.load(spark, path, "main").count() == 852
    environments.fork(spark, path, "main", "sandbox")
    assert files(path) == written and environments.listed(spark, path) == ["main", "sandbox"]
    assert environments.differing(spark, path, "main", "sandbox") == [] and forks.changes(spark, path, "main", "sandbox").rows.count() == 0
    with pytest.raises(ValueError):
        environments.fork(spark, path, "main", "sandbox")
    with pytest.raises(ValueError):
        environments.load(spark, path, "nowhere")

    # The same entities in another order and form change nothing; ten changed rows change their buckets.
    same = catalog(spark).withColumn("attributes", F.transform_values("attributes", lambda _, v: F.replace(v, F.lit('{"b":1,"a":2.0}'), F.lit('{ "a":2, "b":1 }'))))
    assert environments.save(same.orderBy(F.rand(1)), path, "sandbox") == [] and files(path) == written
    changed = range(0, 200, 20)
    fresh = environments.save(catalog(spark, changed), path, "sandbox")
    assert 0 < len(fresh) <= 10 and environments.differing(spark, path, "main", "sandbox") == fresh
    states = forks.changes(spark, path, "main", "sandbox", "item_type")
    read = states.rows.inputFiles()
    assert len(read) < len(files(path)) / 2 and all(any(f"bucket={b}/" in f for b in fresh) for f in read)
    both = states.kept("item_type").where("old_attributes['name'] <> new_attributes['name']")
    assert sorted(r.id for r in both.collect()) == sorted(f"m{k}" for k in changed)

    # The plan of the buckets that differ is that of all.
    edges = spark.createDataFrame([], "src string, dst string")
    part = forks.plan(spark, path, "main", "sandbox", edges)
    whole = diff.change_plan(environments.load(spark, path, "main"), environments.load(spark, path, "sandbox"), edges, "main", "sandbox")
    calls = lambda df: sorted((r.call, r.entity_id, str(r.attributes)) for r in df.collect())
    assert calls(part) == calls(whole) and len(calls(part)) == 10

    environments.promote(spark, path, "sandbox", "main")
    assert environments.differing(spark, path, "main", "sandbox") == [] and environments.load(spark, path, "main", "item_type").where("attributes['name'] like '%!%'").count() == 10
    environments.destroy(spark, path, "sandbox")
    assert environments.listed(spark, path) == ["main"] and environments.delete_unused(spark, path) == len(fresh)
    assert environments.load(spark, path, "main").count() == 852 and environments.delete_unused(spark, path) == 0


def test_empty_and_differently_dealt(spark, tmp_path):
    path = f"{tmp_path}/e"
    environments.save(catalog(spark).limit(0), path, "none")
    assert environments.load(spark, path, "none").count() == 0
    environments.save(catalog(spark), path, "main")
    environments.save(catalog(spark, [3]), path, "few", buckets=4)
    assert environments.differing(spark, path, "main", "few") is None
    assert forks.changes(spark, path, "main", "few", "item_type").kept("item_type").where("old_attributes['name'] <> new_attributes['name']").count() == 1
    assert forks.changes(spark, path, "none", "main", "workflow").created("workflow").count() == 50

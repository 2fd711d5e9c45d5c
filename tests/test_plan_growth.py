"""What the plans must not do as the snapshots grow: broadcast one, derive it again and again, or parse what is settled."""

import math
import random

import pytest

from lodestrata.functions.canonical import canonical, json_string
from lodestrata.operators import moves
from lodestrata.plans import diff
from pyspark.sql import functions as F


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_permission_changes_broadcast_nothing(spark):
    rule = lambda env, action: {"environment": f'"{env}"', "action": f'"{action}"', "all": "false"}
    rows = [("a", 1, "up", rule("new", "x")), ("a", 1, "up", rule("new", "x")), ("a", 1, "up", rule("old", "y")), ("a", 1, "up", rule("new", "y")), ("a", 1, "down", rule("old", "x")), ("b", 2, "up", rule("other", "x"))]
    rules = spark.createDataFrame(rows, "id string, ord long, list string, rule map<string,string>")
    out = diff.permission_changes(rules, "old", "new")
    assert sorted(map(tuple, out.collect())) == [("a", 1, "down", '{"action":"x"}', "remove"), *[("a", 1, "up", '{"action":"x"}', "add")] * 2]
    assert "Join" not in _plan(out)


@pytest.mark.parametrize("value", ["null", "true", "0", "-0", "-17", "123456789012345678", "12345678901234567890", "1.0", "1e3", '"a b~"', '"a/b"', '"é"', r'"A"', r'"a\"b"', "{}", "[ ]", '{"data":null}', '{"data":{"id":"7"}}', '{"data":{"type":"t","id":"7"}}', '{"b":1,"a":2}', " 1", None])
def test_settled_values_are_what_the_parser_makes_of_them(spark, value):
    row = spark.createDataFrame([(value,)], "v string").select(canonical(F.col("v")).alias("quick"), F.to_json(F.parse_json("v")).alias("parsed")).first()
    assert row.quick == row.parsed


@pytest.mark.parametrize("text", ["", "a b", 'a"b', "\\", "a/b", "é", "x\n", "\x7f", "[]{}", None])
def test_plain_texts_are_quoted_as_others(spark, text):
    quoted = F.to_json(F.array("v"))
    row = spark.createDataFrame([(text,)], "v string").select(json_string(F.col("v")).alias("quick"), F.substring(quoted, F.lit(2), F.length(quoted) - 2).alias("parsed")).first()
    assert row.quick == row.parsed


def _models(spark, *rows):
    empty = diff.nothing()
    made = spark.createDataFrame(list(rows), "id string, ord long, name string")
    return made.select(F.lit("item_type").alias("kind"), "id", "ord", F.lit(None).cast("string").alias("owner"), F.create_map(F.lit("name"), "name").alias("attributes"), empty.alias("relationships"), empty.alias("meta"))


def test_phases_read_states_that_are_joined_once(spark):
    out = diff.finished_models(_models(spark, ("1", 1, '"a"'), ("2", 2, '"b"')), _models(spark, ("1", 1, '"c"'), ("2", 2, '"b"'), ("3", 3, ' "d"')))
    assert [(r.entity_id, r.attributes) for r in out.collect()] == [("1", {"name": '"c"'})]
    assert "Join" not in _plan(out)


def test_moves_take_both_sides_from_one_table(spark):
    side = lambda *keys: spark.createDataFrame([(g, k, "", n, n) for g in (1, 2) for n, k in enumerate(keys[g - 1], 1)], "grp long, key string, scope string, position long, ord long")
    out = moves.plan_groups(side("abc", "xy"), side("cab", "xy"))
    assert [tuple(r)[:5] for r in out.collect()] == [(1, 1, "c", "", 1)]
    assert "CoGroup" not in _plan(out)


def test_quality_rules_learn_from_all_labels(spark):
    from lodestrata.llm import quality_rules

    docs = spark.range(24_000).select(F.col("id").alias("doc_id"), F.lit("seldom").alias("text"))
    model = quality_rules.fit(docs, docs.select("doc_id", F.lit(1).alias("quality")))
    cut = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(quality_rules.CUT_FOLDS)) == 0).count()
    good, n = 24_000 - cut, quality_rules.BUCKETS
    assert model.weights.min() == pytest.approx(math.log((good + 1) / (good + n)) - math.log(24_001 / (24_000 + n)))


def test_threshold_as_by_trying_all_cuts(spark):
    from lodestrata.llm import quality_rules

    r = random.Random(3)
    for n in (2, 7, 300):
        rows = [(round(r.gauss(m, 1), 2), m) for m in (0, 1) for _ in range(n)]
        values = sorted({s for s, _ in rows})
        cuts = [(0, values[0] - 1), *((b - a, (a + b) / 2) for a, b in zip(values, values[1:]))]
        balance = lambda c: sum((s >= c) == bool(m) for s, m in rows)
        best = max(balance(c) for _, c in cuts)
        want = max((c for c in cuts if balance(c[1]) == best), key=lambda c: (c[0], -c[1]))[1]
        assert quality_rules._threshold(spark.createDataFrame(rows, "ratio double, mark int")) == pytest.approx(want)
    assert quality_rules._threshold(spark.createDataFrame([(1.0, 1)], "ratio double, mark int")) == -math.inf

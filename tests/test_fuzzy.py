"""Pruned fuzzy search gives what scoring every row gives."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from lodestrata.functions.names import fuzzy_score, letters
from lodestrata.operators.order import candidates, top, top_fuzzy


@pytest.fixture(scope="module")
def names(spark):
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdeé🙂_") for _ in range(r.randrange(0, 9)))
    rows = [(k, word(), r.choice([word(), None, "prefix" + word()])) for k in range(600)]
    return spark.createDataFrame(rows, "id int, name string, domain string").cache()


@pytest.mark.parametrize("query", ["a", "ab", "abc", "prefix", "é🙂", "ace", "zz", "", "abcdeabcde"])
@pytest.mark.parametrize("k", [1, 10, 700])
def test_best_rows(names, query, k):
    columns = [F.col("name"), F.col("domain")]
    want = top(names, F.greatest(*[fuzzy_score(F.lit(query), c) for c in columns]), k, "id").collect()
    for signatures in (None, [letters(c) for c in columns]):
        assert top_fuzzy(names, query, columns, k, "id", signatures=signatures).collect() == want


def test_few_rows_are_scored(names):
    """Rows without the query's letters are left out; with enough parts nothing else is scored."""
    left = candidates(names, "abcde", [F.col("name")]).collect()
    assert {r.id for r in left} == {r.id for r in names.collect() if set("abcde") <= set(r.name)} and 0 < len(left) < 100
    plan = top_fuzzy(names, "prefix", [F.col("domain")], 10, "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "aggregate(" not in plan
    assert "aggregate(" in top_fuzzy(names, "prefix", [F.col("domain")], 700, "id")._jdf.queryExecution().optimizedPlan().toString()

"""What operators store for themselves is gone when nothing reads it any more."""

from pathlib import Path

from lodestrata.llm import quality_rules, simhash
from lodestrata.sources.folders import shared_folder

SF = "/root/testdata/sf0.001"


def _tables(spark):
    return set(Path(shared_folder(spark).removeprefix("file:")).glob("*.parquet"))


def test_the_rules_leave_no_labelled_texts(spark):
    before = _tables(spark)
    quality_rules.rules(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")).count()
    assert _tables(spark) == before


def test_near_duplicates_leave_only_the_rows_that_stay(spark):
    before = _tables(spark)
    kept = simhash.keep_one(spark.read.parquet(f"{SF}/documents.parquet"))
    (left,) = _tables(spark) - before
    assert spark.read.parquet(str(left)).columns == ["of_id", "of_digest"] and kept.count() == spark.read.parquet(str(left)).count()

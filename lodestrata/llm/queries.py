"""One query for each operator of this subpackage, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import audit, compression, decontaminate, language_model, line_templates, mixing, oracle, pieces, pii, quality_rules, resample, sharding, simhash, urls

SHARDS = 40

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint, component_id, key."""
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, host, path, rule, verdict, block_odds."""
    labelled = spark.createDataFrame(urls.LABELLED, "url string, label int")
    return urls.judge(_table(spark, sf_dir, "pages"), urls.fit(labelled))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, item_id, similarity, first_word, last_word: a row for each text and item that it leaks."""
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("key")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"))
    placed = sharding.assign(docs, SHARDS)
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, the text left, n_lines, n_template_lines, dropped_lines."""
    return line_templates.deduplicate(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, counts of the base kinds, base_sha256, all spans, their scores, their number, and whether there is any."""
    found = pii.find(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("pii", lambda s: s["kind"].isin(*pii.BASE))
    count = lambda kind: F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    scores = F.array_join(F.transform("pii", lambda s: s["score"].cast("string")), ",")
    return found.select("doc_id", *map(count, pii.BASE), F.sha2(pii.digest(base), 256).alias("base_sha256"), pii.digest(F.col("pii")).alias("spans"), scores.alias("scores"), F.size("pii").cast("long").alias("n_spans"), (F.size("pii") > 0).alias("personal"))


def op7_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    return language_model.score(_table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, counts, base_failed, kept, ratio."""
    docs = quality_rules.rules(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "labels"))
    return docs.drop("text")


def op9_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    docs = _table(spark, sf_dir, "documents")
    return compression.score(docs, compression.fit(docs, _table(spark, sf_dir, "labels")))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_pieces, ids, and whether the ids decode to the text."""
    both = pieces.round_trip(_table(spark, sf_dir, "documents").select("doc_id", "text"), pieces.Pieces())
    return both.select("doc_id", F.size("ids").alias("n_pieces"), "ids", "round_trip")


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target, taken, source, spans."""
    planned = mixing.plan(_table(spark, sf_dir, "documents"))
    return planned.select("doc_id", "size", "source_size", "target", "taken", "source", "spans")


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_features, weight, score, rank."""
    weighed = resample.weigh(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return resample.draw(weighed).select("doc_id", "n_features", "weight", "score", "rank")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    return audit.audit(audit.failures(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_simhash, op2_url_filters, op3_decontamination, op4_sharding, op5_line_dedup, op6_pii, op7_language_model, op8_quality_rules, op9_compression, op10_sentencepiece, op11_mixing, op12_resampling, op13_filter_audit)}


def oracle_sql() -> dict[str, str]:
    return {"op6_pii": oracle.personal_data(), "op12_resampling": oracle.resampling(), "op13_filter_audit": oracle.filter_audit()}

"""Inputs that are wide in one place: long texts of many matches, dense clouds, benchmarks of thousands of items, clashing names."""

from __future__ import annotations

import random
import resource
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lodestrata.llm import components, decontaminate, line_templates, pieces, pii, quality_rules, sharding, simhash
from lodestrata.llm.tokens import Words


@pytest.mark.parametrize("text,n", [("word " * 200_000 + "0123456789abcdef0123456789abcdef token", 1), (" ".join(f"me{k}@x.org" for k in range(20_000)), 20_000)])
def test_personal_data_of_a_long_text(spark, text, n):
    row = spark.createDataFrame([(1, text)], "doc_id int, text string")
    began = time.monotonic()
    got = pii.find(row).select(F.size("pii"), F.element_at("pii", -1)["end"]).first()
    assert got[0] == n and got[1] == len(text) - 6 * (n == 1) and time.monotonic() - began < 120
    assert pii.redact(row).select(F.length("text")).first()[0] == len(text) - (32 - 8 if n == 1 else sum(len(f"me{k}@x.org") - 7 for k in range(n)))


def test_places_over_the_ends_of_pieces(spark):
    """Context and places are the same wherever a match lies in its text, other planes' characters included."""
    secret = "0123456789abcdef" * 2
    rows = [(k, "🙂" * k + f" token {secret}, " + "é" * (1024 - k % 7) + f" {secret} key") for k in (0, 3, 1000, 1010, 1016, 1017, 1020, 1024, 2040)]
    for r in pii.find(spark.createDataFrame(rows, "k int, text string")).collect():
        assert [(s.kind, r.text[s.start : s.end], s.score) for s in r.pii] == [("secret", secret, 0.6)] * 2


def test_added_spans_that_touch_base_spans(spark):
    r = random.Random(6)
    parts = ["4111 1111 1111 1111", "378282246310005", "+1 202 555 0143", "(202) 555-0143", "1.2.3.4", "123-45-6789", "call", "card", "x@y.org", "GB82 WEST 1234 5698 7654 32"]
    rows = [(k, "".join(r.choice(parts) + r.choice([" ", "", ", ", "-"]) for _ in range(30))) for k in range(40)]
    for x in pii.find(spark.createDataFrame(rows, "k int, text string")).collect():
        base = [s for s in x.pii if s.kind in pii.BASE]
        assert not [s for s in x.pii if s.kind not in pii.BASE and any(b.start < s.end and s.start < b.end for b in base)]


def test_redaction_drops_overlapped_spans(spark):
    rows = [(1, "a b@c.org d"), (2, None), (3, ""), (4, "nothing"), (5, "x " * 3000 + "1.2.3.4 end")]
    got = {r.k: r.text for r in pii.redact(spark.createDataFrame(rows, "k int, text string").withColumn("pieces", F.lit(1))).collect()}
    assert got == {1: "a [email] d", 2: None, 3: "", 4: "nothing", 5: "x " * 3000 + "[ip] end"}


def test_dense_cloud_of_fingerprints(spark):
    """All within three bits of one another by way of the middle: the links are millions, the components few."""
    r = random.Random(3)
    middle, other = r.getrandbits(64), r.getrandbits(64)
    cloud = {middle} | {middle ^ sum(1 << b for b in r.sample(range(64), r.randrange(1, 4))) for _ in range(20_000)} | {other, other ^ 1}
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in cloud]
    table = spark.createDataFrame(signed, "fp long").withColumn("least", F.col("fp"))
    began = time.monotonic()
    got = simhash.linked_components(table).groupBy("component").count().collect()
    assert sorted(x["count"] for x in got) == [2, len(cloud) - 2] and time.monotonic() - began < 180


@pytest.mark.parametrize("seed", range(3))
def test_components_of_leads_are_those_of_all_links(spark, seed):
    r = random.Random(seed)
    fps = {r.getrandbits(64) for _ in range(30)}
    for _ in range(400):
        fps.add(r.choice(sorted(fps)) ^ sum(1 << b for b in r.sample(range(64), r.randrange(1, 6))))
    table = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in fps], "fp long").withColumn("least", F.col("fp"))
    want = components.components(simhash.links(table), table)
    assert sorted(map(tuple, simhash.linked_components(table).collect())) == sorted(map(tuple, want.collect()))


def test_thousands_of_items():
    r = np.random.default_rng(1)
    share = 1 / np.arange(1, 30_001)
    vocabulary = np.array([f"w{k}" for k in range(30_000)])
    draw = lambda n: " ".join(vocabulary[r.choice(30_000, n, p=share / share.sum())])
    items = [draw(60) for _ in range(8000)]
    seeds = decontaminate.Seeds(list(range(8000)), items)
    text = pa.array([f"{draw(50_000)} {items[5]} {draw(50_000)}"])
    before, began = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss, time.process_time()
    found = list(decontaminate.passages(Words(text), seeds))
    assert [x[1] for x in found] == [5] and time.process_time() - began < 5 and resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 300_000


@pytest.mark.parametrize("words,similarity", [(2, 0.5), (4, 0.8), (3, 0.6), (1, 0.4), (5, 1.0)])
def test_rare_seeds_miss_no_alignment(words, similarity):
    r = random.Random(words)
    common = [f"c{k}" for k in range(6)]
    items = [" ".join(r.choice(common) if r.random() < 0.7 else f"r{r.randrange(200)}" for _ in range(r.randrange(3, 40))) for _ in range(60)]
    texts = []
    for _ in range(150):
        own = r.choice(items).split()
        for _ in range(r.randrange(0, 1 + len(own) // 3)):
            at = r.randrange(len(own))
            own[at : at + 1] = r.choice([[], ["zz"], [own[at], "yy"]])
        texts.append(" ".join([*(r.choice(common) for _ in range(r.randrange(20))), *own, *(r.choice(common) for _ in range(r.randrange(20)))]))
    seeds = decontaminate.Seeds(list(range(len(items))), items, words, similarity)
    got = set()
    for t, i, _, passage in decontaminate.passages(Words(pa.array(texts)), seeds):
        if decontaminate.score_pairs([passage], [items[i]])[0][0] >= similarity:
            got.add((t, i))
    pairs = [(t, i) for t in range(len(texts)) for i in range(len(items))]
    score = decontaminate.score_pairs([texts[t] for t, _ in pairs], [items[i] for _, i in pairs])[0]
    want = {p for p, s in zip(pairs, score, strict=True) if s >= similarity}
    assert got == want and want


def test_similarity_out_of_range():
    with pytest.raises(ValueError):
        decontaminate.Seeds([1], ["a b c"], 2, 0.0)


def test_shards_of_a_table_with_a_column_text_hash(spark):
    docs = spark.createDataFrame([(k, f"t{k % 7}", "mine") for k in range(100)], "doc_id long, text string, text_hash string").withColumns({"gone": F.lit(1), "h": F.lit(2)})
    for out in (sharding.assign(docs, 4), sharding.shard(docs, 4)):
        assert len(out.columns) == len(set(out.columns)) and out.where("text_hash = 'mine'").count() == 100
    assert sorted(sharding.shard(docs, 4).select("doc_id", "text").collect()) == sorted(docs.select("doc_id", "text").collect())


def test_lines_of_documents_without_an_id(spark):
    line = "this very line is in all of the documents"
    rows = [(None, f"{line}\nown a b c"), (2, f"{line}\nown d e f"), (1, f"{line}\nown g h i"), (1, f"{line}\nown g h i"), (3, None), (4, "")]
    got = {(r.doc_id, r.text) for r in line_templates.deduplicate(spark.createDataFrame(rows, "doc_id long, text string").withColumns({"node": F.lit(1), "key": F.lit(2)})).collect()}
    assert got == {(None, "own a b c"), (2, "own d e f"), (1, f"{line}\nown g h i"), (3, None), (4, "")}


def test_lines_of_one_token(spark):
    docs = spark.createDataFrame([(k, f"yes\nno{k}\n12\n\nbye {k}") for k in range(5)], "doc_id long, text string")
    assert all(r.text.startswith("yes\n") for r in line_templates.deduplicate(docs).collect())
    got = {r.doc_id: r.text for r in line_templates.deduplicate(docs, min_tokens=1).collect()}
    assert got[0] == "yes\nno0\n12\n\nbye 0" and all(got[k] == f"no{k}\n12\n" for k in range(1, 5))
    assert line_templates.deduplicate(spark.createDataFrame([(k, "end") for k in range(3)], "doc_id long, text string"), min_tokens=1).where("text = ''").count() == 2


def test_labels_of_a_repeated_id(spark):
    text = lambda k: " ".join(f"w{(k * 7 + j) % 90}" for j in range(40))
    docs = spark.createDataFrame([(k % 20, text(k)) for k in range(400)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(20)], "doc_id long, quality int")
    assert quality_rules.rules(docs, labels).count() == 400


def test_round_trip_of_clashing_names(spark):
    docs = spark.createDataFrame([(1, "a b", "x"), (1, "a b", "x"), (2, None, "y"), (3, "", "z")], "doc_id long, text string, ids string").withColumn("round_trip", F.lit(5))
    got = pieces.round_trip(docs, pieces.Pieces())
    assert got.columns == ["doc_id", "ids", "round_trip"] and [r.round_trip for r in got.collect()] == [True] * 4
    assert pieces.round_trip(docs.limit(0), pieces.Pieces()).count() == 0

"""The pipeline's stages one after another, each checked on what it got."""

import itertools
import random

import corpus_pipeline
from lodestrata.llm import decontaminate, simhash

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"{tmp_path}/{k}"
        stage(spark, before, SF).write.parquet(path)
        after = spark.read.parquet(path)
        assert 0 < after.count() <= before.count()
        if k < 4:
            assert after.columns == docs.columns
        if name == "line_dedup":
            assert after.count() == before.count()
        if name == "near_duplicates":
            sets = {r.doc_id: {tuple(r.text.lower().split()[k : k + 5]) for k in range(max(1, len(r.text.split()) - 4))} for r in before.collect()}
            kept = {r.doc_id for r in after.collect()}
            for gone in set(sets) - kept:  # a similar or equal text with a smaller id is there, and the first of its group stays
                assert any(i < gone and len(sets[i] & sets[gone]) >= 0.8 * len(sets[i] | sets[gone]) for i in sets)
            assert len({r.text for r in after.collect()}) == after.count()
        if name == "decontamination":
            assert decontaminate.contaminated(after, spark.read.parquet(f"{SF}/benchmark.parquet")).count() == 0
        before = after
    assert before.where("not round_trip").count() == 0 and before.count() == before.select("doc_id").distinct().count()


def _shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))}


def _first_of_groups(rows):
    """The smallest ids of the groups of texts with a Jaccard similarity of at least 0.8, by comparing all pairs."""
    sets = {}
    for i, text in sorted(rows):
        if text not in (t for t, _ in sets.values()):
            sets[i] = (text, _shingles(text))
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sets, 2):
        x, y = sets[a][1], sets[b][1]
        if len(x & y) >= 0.8 * len(x | y):
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return sorted(i for i in root if root[i] == i)


def test_every_near_copy_is_found(spark):
    """A cloud of copies edited in different places (0.82 to their source, 0.66 to each other), a chain of edits, and texts of their own."""
    rng = random.Random(5)
    prose = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    source, rows = prose(250), []
    for k in range(60):
        copy = list(source)
        for j in range(5):
            copy[4 + 48 * j + (k * 7) % 40] = f"edit{k}x{j}"
        rows.append((k if k < 20 else 100 + k, " ".join(copy)))
    rows.append((50, " ".join(source)))
    chain = prose(120)
    for k in range(12):
        chain = [*chain[6:], *prose(6)]
        rows.append((300 + k, " ".join(chain)))
    rows += [(400 + k, " ".join(prose(80))) for k in range(40)] + [(500, ""), (501, " "), (502, "one two")]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == _first_of_groups(rows)


def test_recall_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]
    assert sorted(r.doc_id for r in simhash.keep_one(docs).collect()) == _first_of_groups(rows)

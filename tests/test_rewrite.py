"""Rewriting by a table of pairs is replacing pair after pair."""

from __future__ import annotations

import random
import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lodestrata.operators.rewrite import Rewriter, changed, in_order, rewrite

ALPHABETS = ("ab", "aAbB", "abc", "aé", "aßſK")


def slow(text, pairs, every, fold):
    folded = Rewriter([], every, fold).folded
    for old, new in pairs:
        out, at = "", 0
        while True:
            hit = folded(text).find(folded(old), at)
            if hit < 0:
                break
            out, at = out + text[at:hit] + new, hit + len(old)
            if not every:
                break
        text = out + text[at:]
    return text


@pytest.mark.parametrize("seed", range(4))
def test_any_pairs(seed):
    r = random.Random(seed)
    for _ in range(4000):
        letters, every, fold = r.choice(ALPHABETS), r.random() < 0.5, r.random() < 0.5
        olds = list(dict.fromkeys("".join(r.choice(letters) for _ in range(r.randrange(1, 4))) for _ in range(r.randrange(1, 7))))
        pairs = [(old, "".join(r.choice(letters + "xyz") for _ in range(r.randrange(4)))) for old in olds]
        text = "".join(r.choice(letters + "x ") for _ in range(r.randrange(14)))
        assert Rewriter(pairs, every, fold)(text) == slow(text, pairs, every, fold), (pairs, text, every, fold)


def test_case_is_folded_as_scripts_do():
    assert Rewriter([("k", "_"), ("S", "-"), ("É", "e"), ("ß", "ss")])("KKſéß") == "_Kſess"
    assert Rewriter([("a.b", "$1\\")])("A.B axb") == "$1\\ axb"


def test_a_hundred_thousand_pairs(spark):
    n = 100_000
    pairs = spark.range(n).select(F.concat(F.lit("https://old.example/a/"), "id", F.lit(".jpg")).alias("old"), F.concat(F.lit("https://cdn.example/"), "id").alias("new"), F.col("id").alias("ord"))
    r = random.Random(1)
    rows, want = [], {}
    for k in range(50):
        some = [r.randrange(n) for _ in range(200)]
        rows.append((k, " and ".join(f"HTTPS://old.example/a/{x}.JPG" for x in some)))
        want[k] = " and ".join(f"https://cdn.example/{x}" for x in some)
    got = rewrite(spark.createDataFrame(rows, "id int, text string"), ["text"], pairs, part_bytes=4 << 20).collect()
    assert {x.id: x.text for x in got} == want


@pytest.mark.parametrize("part_bytes", [1 << 20, 40])
def test_parts_keep_the_order(spark, part_bytes):
    r = random.Random(2)
    pairs = [("".join(r.choice("abc") for _ in range(r.randrange(1, 4))), "".join(r.choice("abcd") for _ in range(r.randrange(3))), k) for k in range(40)]
    table = spark.createDataFrame([*pairs, (None, "x", 90), ("", "y", 91), ("dd", None, 92)], "old string, new string, ord int")
    texts = ["".join(r.choice("abc") for _ in range(r.randrange(30))) for _ in range(40)]
    rows = spark.createDataFrame([(k, t, [t, None, ""]) for k, t in enumerate([*texts, None, "", texts[0], "dd" * 5000])], "new int, old string, more array<string>")
    place, last = {}, {}
    for old, new, _ in [*pairs, ("dd", "", 92)]:
        place.setdefault(old, len(place))
        last[old] = new
    ordered = [(old, last[old]) for old in sorted(place, key=place.get)]
    got = rewrite(rows, ["old", "more"], table, every=False, part_bytes=part_bytes)
    assert got.schema == rows.schema
    for x in got.collect():
        text = [*texts, None, "", texts[0], "dd" * 5000][x.new]
        want = None if text is None else slow(text, ordered, False, True)
        assert (x.old, x.more) == (want, [want, None, ""])
    assert in_order(table).count() == len(ordered)
    assert [x.old for x in rewrite(rows.where("new < 2"), ["old"], table.limit(0)).orderBy("new").collect()] == texts[:2]
    assert rewrite(rows.limit(0), ["old"], table, part_bytes=part_bytes).count() == 0


def test_fixed_texts_of_imports(spark):
    """A thumbnail's address is found where the asset's is a part of it; a later pair sees what an earlier one made."""
    pairs = spark.createDataFrame([("http://x/a", "https://c/1", 1), ("http://x/a-t", "https://c/1?w=1", 2), ("https://c/1-t", "seen", 3)], "old string, new string, ord int")
    rows = spark.createDataFrame([("http://x/A http://x/a-t",)], "text string")
    assert rewrite(rows, ["text"], pairs).first().text == "https://c/1 seen"


def test_texts_of_a_batch_are_not_all_objects_at_once():
    """A batch of 32 MB is changed in pieces; a row longer than a piece, a null and lists come out as they should."""
    texts = [*[f"{k} " + "x" * 4000 for k in range(8000)], None, "x" * (4 << 20), ""]
    batch = pa.RecordBatch.from_pydict({"n": list(range(len(texts))), "text": pa.array(texts), "more": pa.array([[t and t[:3], None] if n % 2 else None for n, t in enumerate(texts)], pa.list_(pa.string()))})
    change = Rewriter([("x", "y"), ("X", "z")])
    tracemalloc.start()
    got, rows = [], 0
    for out in changed(iter([batch, batch.slice(0, 0)]), lambda t: t and t.replace("x", "y"), [1, 2]):
        assert out.schema == batch.schema
        rows += out.num_rows
        got.append(out)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16 << 20 and rows == len(texts)
    assert pa.Table.from_batches(got).to_pydict() == pa.Table.from_batches(changed(iter([batch]), change, [1, 2])).to_pydict()
    assert got[-1].column(1).to_pylist()[-1] == "" and sum(b.column(1).null_count for b in got) == 1

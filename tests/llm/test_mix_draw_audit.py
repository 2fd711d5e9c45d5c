"""Mixing, resampling and the filter audit: whole results against slow versions, and awkward rows."""

from __future__ import annotations

import collections
import hashlib
import heapq
import itertools
import math
import random
import re
import zlib
from fractions import Fraction

import pytest
from compare import both
from pyspark.sql import functions as F

from lodestrata.llm import audit, mixing, oracle, queries, resample

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", ["op12_resampling", "op13_filter_audit"])
def test_sql(spark, name):
    mine, theirs = both(spark, SF, queries.queries()[name], oracle_of(name))
    assert mine == theirs and mine[1]


def oracle_of(name):
    return {"op12_resampling": oracle.resampling, "op13_filter_audit": oracle.filter_audit}[name]()


def slow_quotas(votes, caps, seats):
    """One seat after another to the highest quotient."""
    got = [0] * len(votes)
    heap = [(-Fraction(v), k) for k, v in enumerate(votes) if v and caps[k] > 0]
    heapq.heapify(heap)
    for _ in range(seats):
        if not heap:
            break
        _, k = heapq.heappop(heap)
        got[k] += 1
        if got[k] < caps[k]:
            heapq.heappush(heap, (-Fraction(votes[k], 2 * got[k] + 1), k))
    return got


def test_apportionment_is_by_highest_quotients(spark):
    r = random.Random(5)
    cases = [([3, 3, 3, 3], [9] * 4, 6), ([100, 1, 1, 1, 1, 1], [99] * 6, 4), ([0, 5], [4, 4], 3), ([7, 7], [1, 2], 9), ([1000] + [49] * 40, [9999] * 41, 60)]
    for _ in range(12):
        n = r.randrange(1, 30)
        votes = [r.choice([0, 1, 10, r.randrange(1000), 5000]) for _ in range(n)]
        cases.append((votes, [r.choice([0, 1, 3, 10_000]) for _ in range(n)], r.randrange(0, 400)))
    rows = [(g, k, v, caps[k], seats) for g, (votes, caps, seats) in enumerate(cases) for k, v in enumerate(votes)]
    got = mixing.apportioned(spark.createDataFrame(rows, "g long, k long, votes long, cap long, seats long"), ["g"], ["k"]).collect()
    mine = {(x.g, x.k): x.quota for x in got}
    assert mine == {(g, k): q for g, case in enumerate(cases) for k, q in enumerate(slow_quotas(*case))}


def test_targets_stop_at_their_cap(spark):
    for sizes, weights in (([100, 10, 50, 0], [5, 2, 1, 5]), ([1, 1000, 1000], [5, 2, 1]), ([7], [5])):
        table = spark.createDataFrame(list(zip(sizes, weights, strict=True)), "source_size long, weight int")
        got = [r.target for r in mixing.targets(table).orderBy(F.monotonically_increasing_id()).collect()]
        full, want = set(), [0.0] * len(sizes)
        while True:
            left = 1.5 * sum(sizes) - sum(2 * sizes[k] for k in full)
            share = sum(w for k, w in enumerate(weights) if k not in full)
            want = [2.0 * s if k in full else left * weights[k] / share for k, s in enumerate(sizes)]
            over = {k for k, s in enumerate(sizes) if k not in full and want[k] >= 2 * s}
            if not over:
                break
            full |= over
            if len(full) == len(sizes):
                want = [2.0 * s for s in sizes]
                break
        assert got == pytest.approx(want)


def test_mixing_of_awkward_rows(spark):
    r = random.Random(3)
    rows = [(k, " ".join(r.choice("abcdef") * r.randrange(1, 4) for _ in range(r.randrange(400))), r.choice(["a", "b", "b", "b", "é", None])) for k in range(300)]
    rows += [(900, None, "a"), (901, "", "b"), (902, " \t ", "void"), (None, "x y z " * 50, "b"), (None, "x y z " * 50, "b"), (5, rows[5][1], rows[5][2]), (903, "long " * 40_000, "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({c: F.lit(True) for c in ("size", "key", "taken", "number", "shard", "copies", "target", "hash")})
    got = mixing.plan(docs).collect()
    assert len(got) == len(rows)
    sizes = collections.Counter()
    for _, t, s in rows:
        sizes[s] += len(WORD.findall(t or ""))
    taken, of = collections.Counter(), {}
    for x in got:
        assert x.source_size == sizes[x.source] and x.taken <= 2 * x.size and x.taken == sum((s.last - s.first) * s.times for s in x.spans)
        assert [y for s in x.spans for y in (s.first, s.last)] == sorted(y for s in x.spans for y in (s.first, s.last)) and all(0 <= s.first < s.last <= x.size for s in x.spans)
        taken[x.source] += x.taken
        of[x.source] = x.target
    assert of["void"] == 0 and all(abs(taken[s] - of[s]) <= 64 for s in of)
    assert sum(of.values()) == pytest.approx(1.5 * sum(sizes.values()))
    again = mixing.plan(docs.repartition(7)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))
    texts = mixing.mix(docs).collect()
    words = collections.Counter()
    for x in texts:
        words[x.source] += len(x.text.split()) * x.times
    assert words == +taken
    assert mixing.plan(docs.limit(0)).count() == 0 and mixing.mix(docs.limit(0)).count() == 0


def slow_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


@pytest.mark.parametrize("lengths", [1, 3])
def test_resampling_of_awkward_rows(spark, lengths, monkeypatch):
    monkeypatch.setattr(resample, "_CHARS", 64)
    r = random.Random(8)
    letters = ["Ab", "c", "É", "日本", "İx", "9z", "tail", "tail"]
    docs = [(k, "".join(r.choice(letters) + r.choice([" ", ", ", "-", "\n", "\0"]) for _ in range(r.randrange(60)))) for k in range(120)]
    docs += [(7, docs[7][1]), (None, docs[8][1]), (None, docs[8][1]), (500, None), (501, ""), (502, "tail" * 200), (503, "tail " * 30)]
    target = [("tail É c",), (None,), ("tail",)]
    features = lambda t: [" ".join(w[k : k + n]) for w in [slow_words(t)] for n in range(1, lengths + 1) for k in range(len(w) - n + 1)]
    bucket = lambda f: zlib.crc32(f.encode()) % 50
    s, t = collections.Counter(bucket(f) for _, x in docs for f in features(x)), collections.Counter(bucket(f) for (x,) in target for f in features(x))
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + 50) / ((s[b] + 1) * (t.total() + 50)))) for b in range(50)}
    want = []
    for id_, x in docs:
        f = features(x)
        h = int(hashlib.sha256(f"2024:{'' if id_ is None else id_}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[bucket(y)] for y in f) // max(1, len(f))
        want.append((id_, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), len(slow_words(x))))
    order = sorted((w for w in want if w[4] >= 20), key=lambda w: (-w[3], w[0] is None, w[0] or 0))
    ranked = [(*w[:4], k + 1 if k < len(order) * 10 // 100 else None) for k, w in enumerate(order)] + [(*w[:4], None) for w in want if w[4] < 20]
    table = spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("key", "buckets", "id", "nth")})
    got = resample.draw(resample.weigh(table, spark.createDataFrame(target, "text string"), lengths, 50)).collect()
    assert sorted(map(repr, ((x.doc_id, x.n_features, x.weight, x.score, x.rank) for x in got))) == sorted(map(repr, ranked))
    drawn = resample.resample(table, spark.createDataFrame(target, "text string"), lengths=lengths, buckets=50).collect()
    assert sorted((x.rank, x.doc_id) for x in drawn) == sorted((w[4], w[0]) for w in ranked if w[4]) and all(x.text == dict(docs)[x.doc_id] for x in drawn)
    assert resample.draw(resample.weigh(table.limit(0), spark.createDataFrame(target, "text string"))).count() == 0
    assert resample.weigh(table, spark.createDataFrame([], "text string")).count() == len(docs)


def test_words_have_offsets(monkeypatch):
    monkeypatch.setattr(resample, "_CHARS", 10)
    text = "Hello, wörld-42 — 日本 ABC " * 5
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    found = [x for part in resample.Splitter().words(text) for x in part]
    assert [w for w, _ in found] == slow_words(text) and all(low[a:b] == w for w, (a, b) in found)


def test_ranks_of_equal_rows(spark):
    table = spark.createDataFrame([(3, 1)] * 500 + [(k % 7, k) for k in range(500)], "score long, id long")
    got = resample.ranks(table, [F.col("score").desc(), F.col("id")]).collect()
    assert [(x.score, x.id) for x in sorted(got, key=lambda x: x.rank)] == sorted(((x.score, x.id) for x in got), key=lambda x: (-x[0], x[1]))
    assert sorted(x.rank for x in got) == list(range(1, 1001))


def test_shares_are_averages_over_all_orders():
    for n in (2, 3, 5):
        r = random.Random(n)
        value = [0] + [r.randrange(100) for _ in range((1 << n) - 1)]
        want = [0] * n
        for order in itertools.permutations(range(n)):
            before = 0
            for k in order:
                want[k] += value[before | 1 << k] - value[before]
                before |= 1 << k
        assert [sum(w * v for w, v in zip(row, value, strict=True)) for row in audit.shares(n)] == want


def slow_fails(text):
    w = WORD.findall(text)
    return {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text), "D": bool(re.search(r"[#$%&*|]", text))}


def test_audit_of_awkward_rows(spark):
    r = random.Random(4)
    texts = [None, "", " ".join(f"w{k}" for k in range(150)), "UP " * 200, "a#b", " ".join(f"é{k % 60}" for k in range(120)), "日" * 5]
    docs = [(k, r.choice(texts), r.choice(["en", "de", "", None])) for k in range(60)]
    docs += [(3, docs[3][1], "en"), (3, docs[3][1], "en"), (0, docs[0][1], "de"), (None, "only here", "en"), (None, "only here", "de"), (None, docs[9][1], "en")]
    labels = [(k, r.choice([0, 1, None]), r.choice([0, 1])) for k in range(0, 60, 2)] + [(4, 1, 0), (None, 1, 1), (1000, 1, 1)]
    good, toxic = {k for k, q, _ in labels if q == 1 and k is not None}, {k for k, _, x in labels if x == 1 and k is not None}
    rows = []
    for id_, text, part in docs:
        smaller = any((o or "") == (text or "") and o_id is not None and (id_ is None or o_id < id_) for o_id, o, _ in docs)
        rows.append((part or "", {k for k, v in (slow_fails(text or "") | {"E": smaller}).items() if v}, id_ in good, id_ in toxic))
    want, totals = {}, collections.Counter()
    for part in {p for p, *_ in rows}:
        for order in itertools.permutations("ABCDE"):
            for step, f in enumerate(order):
                own = [x for x in rows if x[0] == part]
                live = [x for x in own if not x[1] & set(order[:step])]
                gone = [x for x in live if f in x[1]]
                totals[part, f] += len(gone)
                want[part, "".join(order), step + 1] = (len(live) - len(gone), len(gone), sum(f in x[1] for x in own) - len(gone), sum(x[1] == {f} for x in own), sum(x[2] for x in gone), sum(x[3] for x in gone))
    table = spark.createDataFrame(docs, "doc_id long, text string, lang string").withColumns({c: F.lit(1) for c in ("id", "mask", "good", "same", "part", "quality")})
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = audit.audit(audit.failures(table, marks)).collect()
    mine = {(x.part, x.filter_order, x.step): (x.kept, x.removed, x.redundant, x.unique_fails, x.good_lost, x.toxic_lost) for x in got}
    assert len(got) == len(mine) and mine == want
    assert all(x.shapley == totals[x.part, x.filter_order[x.step - 1]] for x in got)
    assert audit.audit(audit.failures(table.limit(0), marks)).count() == 0
    with pytest.raises(ValueError):
        audit.audit(audit.failures(table, marks), "A")

"""Each operator against a brute-force version, and on awkward tables: nulls, empty and long texts, ties, repeats, clashes."""

from __future__ import annotations

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import pytest
import xxhash
from pyspark.sql import functions as F

from lodestrata.llm import compression, decontaminate, language_model, line_templates, pieces, pii, quality_rules, sharding, simhash, urls

WORDS = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua".split()


def prose(seed: int, n: int = 60) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(9)) * (r.random() < 0.1) for _ in range(n))


AWKWARD = [
    (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "one two"), (6, prose(1)), (6, prose(1)), (7, prose(1)), (8, prose(1) + " more"), (9, "é ß 日本 🙂\u00a0x"),
    (10, prose(2, 30_000)), (None, prose(3)), (11, "a\0b \r\n c"), (12, prose(4) + "\n" + prose(5)),
]


@pytest.fixture(scope="module")
def docs(spark):
    """Awkward rows, with columns named like the operators' own."""
    rows = [(i, t, "k", -1, True) for i, t in AWKWARD]
    return spark.createDataFrame(rows, "doc_id long, text string, key string, size int, kept boolean").withColumns({"id": F.lit("x"), "ids": F.lit(0), "fp": F.lit(1.5), "n": F.lit(2), "held_out": F.lit(3), "drop": F.lit("d")})


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


def slow_fingerprint(text: str | None) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def test_simhash(spark, docs, none):
    rows = [(100 + k, prose(50 + k // 4, 300) + (" x" * (k % 4))) for k in range(60)] + [(i, t) for i, t in AWKWARD if i is not None and len(t or "") < 9999]
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    fp = [(i, slow_fingerprint(t)) for i, t in rows]
    parent = list(range(len(fp)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in itertools.combinations(range(len(fp)), 2):
        if (fp[a][1] ^ fp[b][1]).bit_count() <= 3:
            parent[root(a)] = root(b)
    least = collections.defaultdict(lambda: 1 << 60)
    for k, (i, _) in enumerate(fp):
        least[root(k)] = min(least[root(k)], i)
    want = sorted((i, f"{f:016x}", least[root(k)]) for k, (i, f) in enumerate(fp))
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in got) == want
    assert len({c for _, _, c in want}) < len(want) - 20
    assert simhash.near_duplicates(docs).count() == docs.count()
    assert simhash.near_duplicates(none).count() == 0
    assert simhash.keep_one(none, rounds=1).count() == 0 and simhash.keep_one(docs.withColumns({"digest": F.lit(1), "node": F.lit(2), "first": F.lit(3)})).columns[-3:] == ["digest", "node", "first"]
    one = simhash.keep_one(docs, rounds=2)
    assert one.columns == docs.columns and sorted(r.doc_id for r in one.collect() if r.text == prose(1)) == [6]


@pytest.mark.parametrize("most", [3, 4])
def test_links_at_every_distance(spark, most):
    r = random.Random(5)
    base = [r.getrandbits(64) for _ in range(40)]
    near = [b ^ sum(1 << k for k in r.sample(range(64), d)) for b in base for d in (1, 2, 3, 4, 5, 6)]
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in {*base, *near}]
    got = {(a, b) for a, b in simhash.links(spark.createDataFrame(signed, "fp long"), most).collect()}
    want = {(a, b) for (a,), (b,) in itertools.product(signed, signed) if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= most}
    assert got == want and len(want) >= 40 * most


def test_components_of_a_chain_and_a_star(spark):
    links = [(k, k + 1) for k in range(1, 40)] + [(100, k) for k in range(101, 160)]
    nodes = spark.createDataFrame([(k, 1000 - k) for k in [*range(1, 41), *range(100, 160), 500]], "fp long, least long")
    from lodestrata.llm.components import components

    got = dict(components(spark.createDataFrame(links, "a long, b long"), nodes).collect())
    assert {got[k] for k in range(1, 41)} == {960} and {got[k] for k in range(100, 160)} == {841} and got[500] == 500


def test_urls(spark, none):
    pages = [(1, "http://A.Example.ORG/es/x?q#f"), (2, "https://x.org"), (3, "ftp://example.org/en/17"), (4, "http://b.com/fr/#/de/"), (5, "http://b.com/de/"), (6, None), (7, "no scheme"), (8, "http://notorg/"), (9, "x://www.mega-casino-win.net/slots"), (10, "x://city-library.net/history"), (10, "x://city-library.net/history")]
    model = urls.fit(spark.createDataFrame(urls.LABELLED, "url string, label int"))
    got = {r.page_id: r for r in urls.judge(spark.createDataFrame(pages, "page_id long, url string"), model).collect()}
    assert [(got[k].host, got[k].path, got[k].rule) for k in range(1, 9)] == [
        ("a.example.org", "/es/x", "example.org/es/"), ("x.org", "", None), ("example.org", "/en/17", "example.org/en/1"), ("b.com", "/fr/", "com/fr/"), ("b.com", "/de/", "com/de/"), ("", "", None), ("", "", None), ("notorg", "/", None),
    ]
    assert [got[k].verdict for k in (1, 3, 4, 5, 9, 10)] == ["block", "block", "allow", "block", "block", "allow"]
    assert urls.judge(spark.createDataFrame([], "page_id long, url string"), model).count() == 0
    lone = urls.train(__import__("pandas").DataFrame({"host": ["a"], "path": ["/"], "label": [0]}))
    assert lone.bias < 0


def test_decontamination(spark, docs, none):
    item = [prose(900 + k, 40) for k in range(5)]
    edited = item[1].split()
    edited[5], edited[17], edited[30] = "zz1", "zz2", "zz3"
    del edited[22]
    rows = [(1, prose(1, 80) + " " + item[0].upper() + " " + prose(2)), (2, prose(3, 50) + " " + " ".join(edited)), (3, prose(4, 400)), (4, item[2]), (5, " ".join(item[3].split()[:12])), (6, "tiny item"), (7, None)]
    bench = [*((k, t) for k, t in enumerate(item)), (7, "tiny item"), (8, None), (9, "")]
    got = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")).collect()}
    assert set(got) == {(1, 0), (2, 1), (4, 2), (6, 7)}
    assert got[1, 0].similarity == got[4, 2].similarity == 1.0 and (got[1, 0].first_word, got[1, 0].last_word) == (80, 119)
    assert 0.7 < got[2, 1].similarity < 1
    few = spark.createDataFrame(bench, "item_id long, text string")
    assert decontaminate.contaminated(docs, few).count() == 0 and decontaminate.contaminated(none, few).count() == 0
    assert decontaminate.contaminated(docs, few.where("false")).count() == 0
    assert decontaminate.clean(docs, few).columns == docs.columns


def test_decontamination_of_a_partial_copy_spread_widely(spark):
    """However many documents share a part of an item's seeds, they are scored: every fifth word replaced is 0.6 or more of it."""
    words = prose(950, 40).split()
    edited = " ".join("zz" if k % 5 == 4 else w for k, w in enumerate(words))
    rows = [(0, " ".join(words)), *((k, f"{prose(k, 20)} {edited} {prose(100 + k, 20)}") for k in range(1, 30))]
    got = decontaminate.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")).collect()
    assert sorted(r.doc_id for r in got) == list(range(30)) and min(r.similarity for r in got) >= 0.6


def slow_align(p: list[str], q: list[str]) -> int:
    row, best = [0] * (len(p) + 1), 0
    for y in q:
        new = [0]
        for j, x in enumerate(p):
            new.append(max(0, row[j] + (1 if x == y else -1), row[j + 1] - 1, new[-1] - 1))
        row, best = new, max(best, *new)
    return best


def test_alignment():
    r = random.Random(3)
    pairs = [([r.choice("abcde") for _ in range(r.randrange(1, 30))], [r.choice("abcde") for _ in range(r.randrange(1, 15))]) for _ in range(60)]
    score, first, last = decontaminate.score_pairs([" ".join(p) for p, _ in pairs], [" ".join(q) for _, q in pairs])
    for k, (p, q) in enumerate(pairs):
        assert score[k] == pytest.approx(slow_align(p, q) / len(q))
        assert slow_align(p[first[k] : last[k] + 1], q) == slow_align(p, q)


@pytest.mark.parametrize("shards", [1, 7, 40])
def test_sharding(spark, shards):
    rows = [(k, "hot text " * 20) for k in range(700)] + [(k, prose(k, 40 + k % 30)) for k in range(700, 1400)] + [(5000 + k, f"pair {k // 2}") for k in range(200)] + [(9001, None), (9002, "")]
    out = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string").withColumn("slot", F.lit("x")), shards).collect()
    size = collections.Counter()
    slots = collections.defaultdict(list)
    for r in out:
        assert r["size"] == len((r.text or "").encode()) + 16
        size[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    assert sorted(size) == list(range(shards)) and all(sorted(v) == list(range(len(v))) for v in slots.values())
    mean, most = sum(size.values()) / shards, max(r["size"] for r in out)
    assert max(abs(v - mean) for v in size.values()) <= 2 * (mean * sharding.TOLERANCE + most)
    of = collections.defaultdict(set)
    for r in out:
        of[r.text or ""].add(r.shard)
    assert sum(len(v) > 1 for v in of.values()) <= 1


def _near_equal(out, shards):
    size, most = collections.Counter({k: 0 for k in range(shards)}), max(r["size"] for r in out)
    for r in out:
        size[r.shard] += r["size"]
    mean = sum(size.values()) / shards
    assert max(abs(v - mean) for v in size.values()) <= 2 * (mean * sharding.TOLERANCE + most), size


def test_sharding_of_a_hot_text_with_null_ids(spark):
    rows = [(None if k % 10 == 0 else (-1) ** k * (1 << k % 63), "hot text") for k in range(300)] + [(1 << 62, "hot text"), (-(1 << 63), "hot text"), ((1 << 63) - 1, "hot text")]
    out = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string"), 7).collect()
    assert collections.Counter((r.doc_id, r.text) for r in out) == collections.Counter(rows)
    _near_equal(out, 7)


def test_sharding_of_repeated_rows(spark):
    rows = [(5, "the same " * 3)] * 300 + [(None, "")] * 100 + [(None, None)] * 100
    out = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), 8).collect()
    assert collections.Counter((r.doc_id, r.text) for r in out) == collections.Counter(rows)
    _near_equal(out, 8)
    assert all(sorted(r.slot for r in out if r.shard == k) == list(range(sum(r.shard == k for r in out))) for k in range(8))


def test_sharding_awkward(docs, none):
    out = sharding.shard(docs, 3)
    assert set(docs.columns) < set(out.columns) and out.count() == docs.count()
    assert sharding.shard(none, 3).count() == 0


def test_line_templates(spark, docs, none):
    rows = []
    for k in range(8):
        rows.append((k, "\n".join([prose(k, 20), f"Copyright {2000 + k} by the lorem press, all rights are kept", f"visit us in the city of {WORDS[k]} on any day of the week", prose(100 + k, 20), "yes"])))
    rows += [(20, "Only here is this line of text"), (21, "twice it is said and no more"), (22, "twice it is said and no more"), (23, None), (24, "")]
    out = {r.doc_id: r for r in line_templates.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (out[0].dropped_lines, out[0].n_template_lines, out[0].text) == ([], 2, rows[0][1])
    for k in range(1, 8):
        assert out[k].dropped_lines == [1, 2] and out[k].n_lines == 5 and out[k].text == "\n".join([prose(k, 20), prose(100 + k, 20), "yes"])
    assert all(out[k].dropped_lines == [] and out[k].text == dict(rows)[k] for k in (20, 21, 22, 23, 24)) and out[23].n_lines == 0
    assert line_templates.deduplicate(docs).count() == docs.count() and line_templates.deduplicate(none).count() == 0


KINDS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def slow_spans(text: str | None) -> list[str]:
    def ok(kind, body):
        d = re.sub("[^0-9]", "", body)
        if kind == "ip":
            return all(int(x) <= 255 for x in body.split("."))
        if kind == "card":
            return 16 <= len(d) <= 19 and sum(int(c) * (1 + k % 2) - 9 * (k % 2 and int(c) > 4) for k, c in enumerate(reversed(d))) % 10 == 0
        return kind != "phone" or 8 <= len(d) <= 15

    return [f"{k}:{m.start()}:{m.end()}" for k, p in KINDS for m in re.finditer(p, text or "") if ok(k, m[0])]


def test_line_templates_of_two_texts_and_two_words(spark):
    shared, other = prose(970, 50), prose(971, 49)
    rows = [(k, f"{prose(k, 12)}\n{shared}\n{other}\nRead more\n12 {k}") for k in (1, 2)]
    rows.append((4, prose(4, 12) + "\nRead more"))
    out = {r.doc_id: r for r in line_templates.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[1].dropped_lines == [] and out[2].dropped_lines == [1, 3] and out[4].dropped_lines == [1]
    assert out[1].n_template_lines == 2 and out[2].text == f"{prose(2, 12)}\n{other}\n12 2"
    copies = [(k, f"{prose(5, 12)}\n{shared}") for k in (1, 2)]  # copies of one text are one
    assert all(r.dropped_lines == [] for r in line_templates.deduplicate(spark.createDataFrame(copies, "doc_id long, text string")).collect())


def test_pii(spark, docs, none):
    r = random.Random(8)
    texts = ["".join(r.choice(["a", "é", ".", "@", "-", "_", " ", "1", "25", "4111111111111111", "+4", "(", ")", "x.y", "255"]) for _ in range(60)) for _ in range(400)]
    texts += ["9" * 20_000, "a" * 20_000 + "@b.c", "+1 (017) 555-7713, 5555 5555 5555 4444", None, "", "iban GB82 WEST 1234 5698 7654 32!", 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"', "x 04dbebab91ab85687d33eeaaf9ac699e1188f962"]
    out = pii.find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)).collect()
    for row in out:
        base = [f"{s.kind}:{s.start}:{s.end}" for s in row.pii if s.kind in pii.BASE]
        assert base == slow_spans(row.text), row.text
    kinds = {row.text: [s.kind for s in row.pii] for row in out}
    assert kinds[texts[-3]] == ["iban"] and kinds[texts[-2]] == ["secret"] and kinds[texts[-1]] == []
    assert pii.find(docs).count() == docs.count() and pii.find(none).count() == 0
    clean = pii.redact(spark.createDataFrame([("me@x.org and 1.2.3.4",)], "text string")).first().text
    assert clean == "[email] and [ip]"


def test_language_model(spark, docs, none):
    rows = [(k, prose(k % 90, 30 + k % 17) + (" rare%d" % k) * (k % 5 == 0)) for k in range(300)] + [(1000, None), (1001, "Never Seen"), (7, prose(7))]
    out = language_model.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    token = lambda t: [*(t or "").encode().lower().split(), None]
    train = [token(t) for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    c = collections.Counter(w for t in train for w in t)
    n, v = sum(c.values()), len(c)
    want = collections.Counter()
    for i, t in rows:
        want[i, len(token(t)), sum(c[w] > 0 for w in token(t)), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in token(t)), 6)] += 1
    assert collections.Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out) == want
    held = [r for r in out if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) and all(-1e9 < r.score < 0 for r in out)
    assert language_model.score(docs).count() == docs.count() and language_model.score(none).count() == 0


def test_mixture_weights():
    import numpy as np

    table = np.array([[3, 0, 40, 900], [3, language_model._NONE, 40, 100], [0, language_model._NONE, 30, 50]])
    w = language_model.learn_weights(table, 1e-6)
    assert np.allclose(w.sum(axis=1), 1) and w[3, 0] > 0.8 and w[0, 0] == 0 and (w[1:] > 0).all() and np.allclose(w[9], w[3])


def slow_counts(text: str | None) -> tuple:
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    five = collections.defaultdict(list)
    for k in range(len(words) - 4):
        five[tuple(words[k : k + 5])].append(k)
    repeat = {k + j for at in five.values() if len(at) > 1 for k in at for j in range(5)}
    return len(words), sum(map(len, words)), sum(c in quality_rules.SYMBOLS for c in text or ""), dup, len(repeat)


def test_quality_rules(spark, docs, none):
    rows = [(k, prose(k, 40)) for k in range(200)] + [(200 + k, " ".join(f"{w}!!" for w in prose(k, 40).upper().split())) for k in range(200)]
    rows += [(500, "a b c d e f a b c d e " * 3), (501, "x\nx\n\nx \n\t\nx"), (502, None), (503, "#* $%&|<> é日本")]
    labels = spark.createDataFrame([(k, int(k < 200)) for k in range(0, 400, 2)] + [(1, None), (None, 1), (3, 0), (3, 1)], "doc_id long, quality int")
    out = {r.doc_id: r for r in quality_rules.rules(spark.createDataFrame(rows, "doc_id long, text string"), labels).collect()}
    for i, t in rows:
        r, want = out[i], slow_counts(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0]) and not (r.kept and r.base_failed)
    assert sum(out[k].kept for k in range(200)) >= 195 and sum(out[k].kept for k in range(200, 400)) <= 5
    assert quality_rules.rules(docs, labels).count() == docs.count() and quality_rules.rules(none, labels).count() == 0
    assert quality_rules.rules(docs, labels.where("false")).where("kept").count() > 0


def test_compression(spark, docs, none):
    rows = [(k, prose(k, 80)) for k in range(400)] + [(400 + k, " | ".join(prose(k, 80).split())) for k in range(400)] + [(2000, None), (2001, "")]
    labels = spark.createDataFrame([(k, int(k < 400)) for k in range(800)] + [(2000, 1), (None, 0)], "doc_id long, quality int")
    table = spark.createDataFrame(rows, "doc_id long, text string")
    out = compression.score(table, compression.fit(table, labels)).collect()
    held = [r for r in out if r.held_out and r.doc_id < 800]
    assert len(held) > 100 and sum(r.predicted == (r.doc_id < 400) for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)
    blank = compression.fit(docs, labels.where("false"))
    assert {r.score for r in compression.score(docs, blank).collect()} == {0.5} and compression.score(none, blank).count() == 0


def test_pieces(spark, docs, none):
    import sentencepiece

    vocabulary = pieces.Pieces()
    plain = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    r = random.Random(4)
    texts = [t or "" for _, t in AWKWARD] + ["".join(r.choice("abc  \n▁é日🙂.,ing the") for _ in range(r.randrange(80))) for _ in range(200)] + ["x" * 3000, " " * 50, "<s> <0x0A> </s>"]
    ids, n = pieces.Encoder(vocabulary).encode(texts)
    ends = n.cumsum()
    for k, t in enumerate(texts):
        assert ids[ends[k] - n[k] : ends[k]].tolist() == plain.encode(t), t[:80]
    out = pieces.decode(pieces.encode(docs, vocabulary), vocabulary)
    assert all(row.decoded == (row.text or "") for row in out.collect()) and out.count() == docs.count()
    assert pieces.decode(pieces.encode(none, vocabulary), vocabulary).count() == 0
    two = {(r.doc_id, tuple(r.ids)) for r in pieces.encode(docs, vocabulary).collect()}
    once = pieces.round_trip(docs, vocabulary).collect()
    assert {(r.doc_id, tuple(r.ids)) for r in once} == two and all(r.round_trip for r in once) and pieces.round_trip(none, vocabulary).count() == 0


def test_pieces_of_long_runs():
    import time

    import sentencepiece

    vocabulary = pieces.Pieces()
    plain = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    r = random.Random(11)
    letters = lambda n, of="etaoinshrdlucmfwypvbgkqjxz": "".join(r.choice(of) for _ in range(n))
    texts = [letters(20_000), letters(5000, "ab"), "ab" * 4000, "x" * 9001, "-" * 5000 + "=" * 3001, " " * 4000, "adipiscing" * 500, "theinging" * 300 + letters(99), letters(40) + " " + letters(70)]
    ids, n = pieces.Encoder(vocabulary).encode(texts)
    for t, end, k in zip(texts, n.cumsum(), n, strict=True):
        assert ids[end - k : end].tolist() == plain.encode(t), t[:50]
    began = time.process_time()
    pieces.Encoder(vocabulary).encode([letters(1_000_000)])
    assert time.process_time() - began < 60


def test_digest_is_of_base_spans(spark):
    from lodestrata.llm.queries import op6_pii

    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for r in op6_pii(spark, "/root/testdata/sf0.001").collect():
        assert r.base_sha256 == hashlib.sha256(",".join(slow_spans(texts[r.doc_id])).encode()).hexdigest()


def test_spans_against_sql(spark, tmp_path):
    import sys
    from pathlib import Path

    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from compare import both

    from lodestrata.llm import queries

    mine, theirs = both(spark, "/root/testdata/sf0.001", queries.op6_pii, queries.oracle_sql()["op6_pii"])
    assert mine == theirs and len(mine[1]) == 200

"""SimHash near-duplicates: 64-bit fingerprints, linked within a Hamming distance by the pigeonring principle.

A fingerprint is cut into t + 1 segments on a ring. If two fingerprints differ in at most t bits, then there is a start
from which every chain of l consecutive segments differs in at most l * t / (t + 1) bits. With four segments and t = 3 that
is: 0 bits in the first, at most 1 in two, at most 2 in three, at most 3 in all. The first two links of the
chain are an equi-join (the second segment is probed with each of its one-bit variants), the third is checked on the joined
row, and what is left gets the full Hamming check.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .columns import spare
from .components import components
from .storage import cut, let_go, stored
from .tokens import U64, list_array, mix, slices

SHINGLE = 3
SEED = 42
DISTANCE = 3
ROUNDS = 1
HOT = 1 << 16
HOT_SHARE = 16
HOT_LEAST = 4
SKETCH_BITS = 1024
FEW = 200_000
_BLOCK = 255


def shingle_hashes(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> Iterator[np.ndarray]:
    """XXH64 of each shingle of the lower-cased words (all words, if they are fewer), repeats included, in parts."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return
    line = b" ".join(words)
    gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    starts, ends = np.concatenate(([0], gaps + 1)), np.concatenate((gaps, [len(line)]))
    n = max(1, len(words) - shingle + 1)
    ends = ends[shingle - 1 :] if len(words) >= shingle else ends[-1:]
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, 1 << 16):
        to = min(n, at + (1 << 16))
        yield np.array([digest(line[s:e], seed) for s, e in zip(starts[at:to].tolist(), ends[at:to].tolist(), strict=True)], "<u8")


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The unsigned fingerprint of one text; 0 if it has no words."""
    return _majority(shingle_hashes(text, shingle, seed))


def _majority(parts: Iterable[np.ndarray]) -> int:
    """The bits that over half of the values have set."""
    counts, n = np.zeros(64, np.int64), 0
    for h in parts:
        n += len(h)
        counts += _bit_counts(h)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def _bit_counts(h: np.ndarray) -> np.ndarray:
    """How many values have each of the 64 bits set, lowest first."""
    bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    whole = len(bits) // _BLOCK * _BLOCK
    out = bits[whole:].sum(axis=0, dtype=np.int64)
    if whole:  # sums of up to 255 bits fit in a byte
        out += bits[:whole].reshape(-1, _BLOCK, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(id, key, fp): the fingerprint of each whole text as a signed long, 0 for null and wordless texts; key is a hash of id and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                fp = np.array([fingerprint(t, shingle, seed) for t in part.column("text").to_pylist()], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("key"), pa.array(fp)], names=["id", "key", "fp"])

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(id_col, text_col).alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return source.mapInArrow(run, "id long, key long, fp long")


def _ring(distance: int) -> list[tuple[int, int]]:
    """Offset and width in bits of distance + 1 segments."""
    cuts = [64 * k // (distance + 1) for k in range(distance + 2)]
    return [(a, b - a) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _bits(x: Column | str, at: int, n: int) -> Column:
    return F.shiftrightunsigned(x, at).bitwiseAND(F.lit((1 << n) - 1).cast("long"))


def _turns(distance: int) -> list[list[tuple[int, int]]]:
    """The ring as read from each start."""
    ring = _ring(distance)
    return [ring[i:] + ring[:i] for i in range(len(ring))]


def _probes(fps: DataFrame, distance: int, *more: str) -> tuple[DataFrame, DataFrame]:
    """(start, a, key) and (start, b, key): a row for each start and variant of the second segment, and one for each start."""
    turn = _turns(distance)
    keys = [_bits("fp", *r[0]) * F.lit(1 << r[1][1]).cast("long") + _bits("fp", *r[1]) for r in turn]
    flips = F.array(*[F.array(*[F.lit(x).cast("long") for x in (0, *(1 << k for k in range(r[1][1])))]) for r in turn])
    index = fps.select(F.col("fp").alias("b"), *more, F.posexplode(F.array(*keys)).alias("start", "key"))
    probe = index.select("start", F.col("b").alias("a"), *more, "key", F.explode(F.get(flips, F.col("start"))).alias("flip"))
    return probe.select("start", "a", *more, F.col("key").bitwiseXOR(F.col("flip")).alias("key")), index


def _checked(joined: DataFrame, distance: int) -> DataFrame:
    """(a, b), a < b: the pairs of ``joined`` (start, a, b) that pass longer chains and the full check."""
    turn, differ = _turns(distance), F.expr("a ^ b")
    for n in range(3, distance + 1):
        chain = F.coalesce(*[F.when(F.col("start") == i, sum(F.bit_count(_bits(differ, *r[k])) for k in range(n))) for i, r in enumerate(turn)])
        joined = joined.where(chain <= n * distance // len(turn))
    return joined.where(F.bit_count(differ) <= distance).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def links(fps: DataFrame, distance: int = DISTANCE, leads: bool = False) -> DataFrame:
    """(a, b), a < b: the pairs of *different* fingerprints in column fp that differ in at most ``distance`` bits.

    The probe side has a row for each start and each variant of the second segment. Copies share one fingerprint. With
    ``leads`` only one fingerprint of each bucket is probed, so that a dense cloud has as many pairs as members: no longer all.
    """
    probe, index = _probes(fps, distance)
    if leads:
        index = index.groupBy("start", "key").agg(F.min("b").alias("b"))
    return _checked(probe.join(index, ["start", "key"]).where("a <> b" if leads else "a < b"), distance)


def links_between(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(a, b), a < b: the links of ``fps`` (fp, component) between different components.

    Components that meet in a bucket are paired first, so that a bucket of one component costs its rows, however dense it is.
    """
    probe, index = _probes(fps, distance, "component")
    probe, index = probe.withColumnRenamed("component", "c"), cut(index.withColumnRenamed("component", "d"))
    # Most probes find no bucket, or one of their own component only: they go before anything is stored.
    others = index.groupBy("start", "key").agg(F.min("d").alias("low"), F.max("d").alias("high"))
    probe = cut(probe.join(others, ["start", "key"]).where("c <> low or c <> high").select("start", "key", "a", "c"))
    met = probe.select("start", "key", "c").distinct().join(index.select("start", "key", "d").distinct(), ["start", "key"]).where("c <> d")
    half = probe.join(met, ["start", "key", "c"]).select("start", "key", "a", "d")
    return _checked(half.join(index, ["start", "key", "d"]), distance)


def linked_components(distinct: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(fp, component) of ``distinct`` (fp, least) under all links, without making those within what is already one component."""
    edges = cut(links(distinct, distance, leads=True))
    first = cut(components(edges, distinct.select("fp", F.col("fp").alias("least"))))
    return components(cut(edges.union(links_between(first, distance))), distinct)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(id, fingerprint, component_id, key): one row per row of ``docs``; key is xxhash64(id, text).

    Copies are folded into one fingerprint before anything is joined, so a group of copies of any size adds one row to the
    search. Fingerprints are linked to the leads of their buckets first, then only those of different components, so a dense
    cloud costs its members. component_id is the smallest id that can be reached over links, null ids last; equal ids are one,
    and of equal fingerprints all rows are in one component. Null, empty and wordless texts have the fingerprint 0. An empty
    table gives no rows; repeated rows give repeated rows; extra columns are ignored; a long text is hashed in parts of 65,536 shingles.
    """
    fps = cut(fingerprints(docs, id_col, text_col, shingle, seed))
    distinct = cut(fps.groupBy("fp").agg(F.min("id").alias("least")))
    label = linked_components(distinct)
    out = fps.join(label, "fp")
    return out.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"), "key")


def shingle_sets(docs: DataFrame, words: int) -> DataFrame:
    """(node, grams): the distinct hashed shingles of each text of ``docs`` (node, text); shorter texts have one, all of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = [np.unique(np.concatenate([*shingle_hashes(t, words), np.zeros(0, "<u8")])) for t in part.column("text").to_pylist()]
                grams = list_array(np.concatenate(sets).view(np.int64), np.array([len(x) for x in sets]), pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("node"), grams], names=["node", "grams"])

    return docs.select("node", "text").mapInArrow(run, f"node {dict(docs.dtypes)['node']}, grams array<long>")


def similar(pairs: DataFrame, texts: DataFrame, words: int, similarity: float) -> DataFrame:
    """The ``pairs`` (a, b) whose texts (node, text) have a Jaccard similarity of at least ``similarity`` over their shingles, stored."""
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    sets = stored(shingle_sets(texts.join(nodes, "node", "left_semi"), words))
    side = lambda c: sets.select(F.col("node").alias(c), F.col("grams").alias(f"of_{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    shared = F.size(F.array_intersect("of_a", "of_b"))
    out = stored(both.where(shared >= similarity * (F.size("of_a") + F.size("of_b") - shared)).select("a", "b"))
    let_go(sets)
    return out


def _needed(size, similarity: float):
    """The least overlap with any text as similar as ``similarity`` that a set of ``size`` shingles needs; rounding never raises it."""
    return np.ceil(size * similarity - 1e-6).astype(np.int64)


def _hot(texts: DataFrame, words: int) -> np.ndarray:
    """Shingles that many of a share of the texts have, the commonest last. It only orders prefixes, so a miss costs time, no link."""
    some = texts.where(F.pmod(F.xxhash64("node"), F.lit(HOT_SHARE)) == 0).dropDuplicates(["node"])
    counts = shingle_sets(some, words).select(F.explode("grams").alias("gram")).groupBy("gram").agg(F.count("*").alias("n")).where(F.col("n") >= HOT_LEAST)
    rows = counts.orderBy(F.desc("n"), "gram").limit(HOT).collect()
    return np.array([r["gram"] for r in reversed(rows)], np.int64)


def prefixes(texts: DataFrame, words: int, similarity: float, hot: np.ndarray) -> DataFrame:
    """(first, node, fp, size, bits, keys) of ``texts`` (first, node, text): fingerprint and number of the distinct shingles, and their prefix, in one order for all texts with ``hot`` last.

    Each of SKETCH_BITS bits says whether an odd number of shingles falls on it, so two texts differ in as many shingles at least as in bits.

    Two sets that share s of both's shingles share one of their first n - ceil(s * n) + 1 each. A wordless text has the key 0.
    """
    values = np.sort(hot)
    rank = np.argsort(hot) + 1

    def prefix(grams: np.ndarray) -> np.ndarray:
        if len(grams) == 0:
            return np.zeros(1, np.int64)
        take = len(grams) - int(_needed(len(grams), similarity)) + 1
        if len(values) == 0:
            return grams[:take]
        at = np.minimum(np.searchsorted(values, grams), len(values) - 1)
        order = np.where(values[at] == grams, rank[at], 0)
        return grams[np.argsort(order, kind="stable")[:take]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = [np.unique(np.concatenate([*shingle_hashes(t, words), np.zeros(0, "<u8")]).view(np.int64)) for t in part.column("text").to_pylist()]
                keys = [prefix(x) for x in sets]
                odd = np.array([np.bincount(x & (SKETCH_BITS - 1), minlength=SKETCH_BITS) & 1 for x in sets], np.uint8)
                bits = np.packbits(odd, axis=1).view(np.int64)
                fp = np.array([_majority([x]) for x in sets], np.uint64).view(np.int64)
                arrays = [pa.array(fp), pa.array(np.array([len(x) for x in sets], np.int32)), list_array(bits.ravel(), np.full(len(bits), bits.shape[1]), pa.int64()), list_array(np.concatenate(keys), np.array([len(x) for x in keys]), pa.int64())]
                yield pa.RecordBatch.from_arrays([part.column("first"), part.column("node"), *arrays], names=["first", "node", "fp", "size", "bits", "keys"])

    kinds = dict(texts.dtypes)
    return texts.select("first", "node", "text").mapInArrow(run, f"first {kinds['first']}, node {kinds['node']}, fp long, size int, bits array<long>, keys array<long>")


def _within_reach(similarity: float) -> str:
    """Whether sets x and y can be that similar if a key at their places is the first they share: true for all that are."""
    return f"least(x.size - x.at, y.size - y.at) >= {similarity / (1 + similarity)!r} * (x.size + y.size) - 0.000001 or x.size = 0 and y.size = 0"


def _screened(pairs: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """The ``pairs`` (a, b) whose sketches don't already show more different shingles than that similarity allows."""
    side = lambda c: nodes.select(F.col("node").alias(c), F.col("size").alias(f"size_{c}"), F.col("bits").alias(f"bits_{c}"))
    differ = F.aggregate(F.zip_with("bits_a", "bits_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda x, y: x + y)
    most = (F.col("size_a") + F.col("size_b")) * ((1 - similarity) / (1 + similarity)) + 1e-6
    return pairs.join(side("a"), "a").join(side("b"), "b").where(differ <= most).select("a", "b")


def _fingerprint_pairs(nodes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Pairs of texts whose fingerprints are linked to a lead's: each text with the first of its fingerprint, and those with leads of buckets."""
    leads = nodes.groupBy("fp").agg(F.min("node").alias("lead"))
    same = nodes.join(leads, "fp").select(F.col("lead").alias("a"), F.col("node").alias("b"))
    of = lambda c: leads.select(F.col("fp").alias(c), F.col("lead").alias(f"of_{c}"))
    near = links(leads.select("fp"), distance, leads=True).join(of("a"), "a").join(of("b"), "b").select("of_a", "of_b")
    return same.where("a <> b").union(near)


def keep_one(docs: DataFrame, words: int = 5, similarity: float = 0.8, rounds: int = ROUNDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` less near duplicates: of each group of texts the one with the smallest id stays, in one row.

    Groups are the connected components of all pairs of texts with a Jaccard similarity of ``similarity`` over their
    ``words``-word shingles; no pair is left out. Copies are folded first. SimHash fingerprints that the ring links to a lead
    give the first candidates; each is checked. A fingerprint can't promise every pair, so texts of different components that
    share a key of their prefixes are candidates too: in ``rounds`` rounds each text with one lead of each of its keys, so
    that a large group is one component at linear cost, then all. No text leaves the search, and components run over the
    edges of all rounds. Null and empty texts are wordless and one text; null ids come last; repeated rows are copies.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    digest = F.unhex(F.md5(text.cast("binary")))
    source = docs.select(F.col(id_col).cast("long").alias("first"), digest.alias("node"), text.alias("text"))
    hot = _hot(source, words)
    made = prefixes(source, words, similarity, hot).groupBy("node").agg(F.min(F.struct(F.col("first").isNull(), "first")).alias("first"), *[F.first(c).alias(c) for c in ("fp", "size", "bits", "keys")])
    # From here a text is named by a number: its digest is needed again only to find the text or its rows.
    distinct = stored(made.withColumnRenamed("node", "digest").withColumn("node", F.monotonically_increasing_id()))
    source = source.withColumnRenamed("node", "digest")

    def checked(pairs: DataFrame) -> DataFrame:
        asked = stored(pairs.distinct())
        pairs = stored(_screened(asked, distinct, similarity))
        let_go(asked)
        ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(distinct.select("node", F.col("digest").alias("of"), F.col("first.first").alias("id")), "node")
        ends = stored(ends)
        few = F.broadcast(ends) if ends.count() <= FEW else ends
        # Only the first row of a text is asked for: its copies are dealt out by their ids and match nothing.
        texts = source.join(few, (source["digest"] == few["of"]) & source["first"].eqNullSafe(few["id"])).groupBy("node").agg(F.first("text").alias("text"))
        out = similar(pairs, texts, words, similarity)
        let_go(pairs, ends)
        return out

    found = [checked(_fingerprint_pairs(distinct))]
    keys = distinct.select("node", "size", F.posexplode("keys").alias("at", "k"))
    repeated = stored(keys.groupBy("k").agg(F.count("*").alias("n")).where("n > 1").select("k"))
    shared = stored(keys.join(repeated, "k"))
    let_go(repeated)
    for k in range(rounds + 1):
        edges = reduce(DataFrame.union, found)
        label = stored(components(edges, distinct.select(F.col("node").alias("fp"), F.col("node").alias("least")))).select(F.col("fp").alias("node"), F.col("component").alias("comp"))
        placed = shared.join(label, "node")
        if k < rounds:
            # The lead is the text that most of the others are likely to be near: the one whose key is earliest.
            best = F.struct((-F.col("at") / F.greatest("size", F.lit(1))).alias("early"), F.xxhash64("node", F.lit(k)).alias("tie"), "node", "comp", "size", "at")
            lead = placed.groupBy("k").agg(F.max(best).alias("lead")).select("k", "lead.*")
            pairs = placed.alias("x").join(lead.alias("y"), "k").where("x.comp <> y.comp")
        else:
            groups = stored(placed.select("k", "comp").distinct())
            met = groups.alias("p").join(groups.alias("q"), "k").where("p.comp < q.comp").select("k", F.col("p.comp").alias("c"), F.col("q.comp").alias("d"))
            half = met.join(placed.withColumnRenamed("comp", "c"), ["k", "c"]).select("k", "d", F.struct("node", "size", "at").alias("x"))
            pairs = half.join(placed.select("k", F.col("comp").alias("d"), F.struct("node", "size", "at").alias("y")), ["k", "d"])
        found.append(checked(pairs.where(_within_reach(similarity)).select(F.expr("least(x.node, y.node)").alias("a"), F.expr("greatest(x.node, y.node)").alias("b"))))
        let_go(label, *([groups] if k == rounds else []))
    let_go(shared)
    group = components(reduce(DataFrame.union, found), distinct.select(F.col("node").alias("fp"), F.col("node").alias("least"))).withColumnsRenamed({"fp": "node"})
    best = group.join(distinct.select("node", "first", "digest"), "node").groupBy("component").agg(F.min(F.struct("first", "digest")).alias("best"))
    id_, digest_ = spare(docs, "id", "digest")
    keyed = docs.withColumns({id_: F.col(id_col).cast("long"), digest_: digest})
    # What is left of the search is a row for each group; all else goes before the texts are shuffled.
    kept = stored(best.select(F.col("best.first.first").alias("of_id"), F.col("best.digest").alias("of_digest")))
    let_go(distinct, *found)
    own = keyed.join(kept, keyed[id_].eqNullSafe(kept["of_id"]) & (keyed[digest_] == kept["of_digest"]), "left_semi")
    return own.dropDuplicates([id_, digest_]).select(*docs.columns)

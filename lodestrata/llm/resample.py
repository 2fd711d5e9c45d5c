"""Importance resampling towards a target distribution: hashed n-gram histograms, gains, and a seeded draw without replacement.

An untrained pre-tokeniser (a regular-expression split over ASCII-lowered text) gives words with offsets; windows of words by
pairs of offsets are the features, and the CRC-32 of a feature is its bucket. Each text is split once: its histogram is stored,
and the corpus' histogram and every weight come from what is stored. A bucket's gain is the logarithm of how much likelier the
target makes it; a text's weight is the mean gain of its features; with Gumbel noise from a hash of its id added, the highest
scores are a sample by weight without replacement.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from tokenizers import Regex, pre_tokenizers

from .columns import spare
from .storage import stored
from .tokens import list_array, slices

BUCKETS = 10_000
LENGTHS = 1
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
SCALE = 1000
#: Fixed value: what a word is made of, after A-Z have been lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ROWS_PER_PART = 1_000_000
_ASCII_LOWER = str.maketrans({c: c + 32 for c in range(0x41, 0x5B)})
_CHARS = 1 << 18
_KEPT = 1 << 18


class Splitter:
    """Words of a text by an untrained pre-tokeniser, in pieces that end between words, and the buckets of runs of words."""

    def __init__(self, lengths: int = LENGTHS, buckets: int = BUCKETS):
        self.lengths, self.buckets = lengths, buckets
        self.split = pre_tokenizers.Split(Regex(WORD), behavior="removed", invert=True)
        self.kept: dict[str, int] = {}

    def pieces(self, text: str) -> Iterator[str]:
        """A lower-cased text in pieces of about _CHARS characters; a piece ends at a space or other ASCII mark, so no word is cut."""
        at = 0
        while len(text) - at > _CHARS:
            to = at + _CHARS
            while to < len(text) and (text[to] > "\x7f" or text[to].isalnum()):
                to += 1
            yield text[at:to]
            at = to
        yield text[at:]

    def words(self, text: str | None) -> Iterator[list[tuple[str, tuple[int, int]]]]:
        """(word, (first, end)) of each piece; the offsets count code points of the whole text."""
        at = 0
        for piece in self.pieces((text or "").translate(_ASCII_LOWER)):
            yield [(w, (a + at, b + at)) for w, (a, b) in self.split.pre_tokenize_str(piece)] if at else self.split.pre_tokenize_str(piece)
            at += len(piece)

    def bucket(self, feature: str) -> int:
        got = self.kept.get(feature)
        if got is None:
            if len(self.kept) >= _KEPT:  # words of unheard-of texts; what is forgotten is worked out again
                self.kept.clear()
            got = self.kept[feature] = zlib.crc32(feature.encode("utf-8", "replace")) % self.buckets
        return got

    def histogram(self, text: str | None) -> tuple[int, int, np.ndarray, np.ndarray]:
        """Words, features, and the buckets that have any with their numbers of features."""
        n_words, total, tail = 0, np.zeros(self.buckets, np.int64), []
        for part in self.words(text):
            n_words += len(part)
            words = tail + [w for w, _ in part]
            new = range(len(tail), len(words))
            for n in range(1, self.lengths + 1):
                found = [self.bucket(" ".join(words[k - n + 1 : k + 1])) if n > 1 else self.bucket(words[k]) for k in new if k >= n - 1]
                if found:
                    total += np.bincount(np.array(found), minlength=self.buckets)
            tail = words[len(words) - self.lengths + 1 :] if self.lengths > 1 else []
        own = np.flatnonzero(total)
        return n_words, int(total.sum()), own, total[own]


def histograms(texts: DataFrame, lengths: int = LENGTHS, buckets: int = BUCKETS) -> DataFrame:
    """``texts`` with n_words, n_features, buckets and counts in place of the column text; repeated rows and null texts each have a row."""
    others = [f for f in texts.schema.fields if f.name != "text"]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in others), "n_words long, n_features long, buckets array<int>, counts array<int>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = Splitter(lengths, buckets)
        for batch in batches:
            for part in slices(batch, "text"):
                rows = [split.histogram(t) for t in part.column("text").to_pylist()]
                n_words, n, own, counts = zip(*rows, strict=True)
                sizes = np.array([len(x) for x in own])
                out = [part.column(f.name) for f in others] + [pa.array(n_words, pa.int64()), pa.array(n, pa.int64())]
                out += [list_array(np.concatenate(own).astype(np.int32), sizes, pa.int32()), list_array(np.concatenate(counts).astype(np.int32), sizes, pa.int32())]
                yield pa.RecordBatch.from_arrays(out, names=[*(f.name for f in others), "n_words", "n_features", "buckets", "counts"])

    return texts.select(*(f.name for f in others), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, schema)


def totals(found: DataFrame, buckets: int) -> np.ndarray:
    """How many features of all texts each bucket holds: a row for each bucket and task at most, then one for each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(buckets, np.int64)
        for batch in batches:
            np.add.at(sums, batch.column("buckets").flatten().to_numpy(), batch.column("counts").flatten().to_numpy())
        own = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), pa.array(sums[own])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in found.select("buckets", "counts").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """SCALE times the logarithm of how much likelier each bucket is in the target, by add-one estimates, rounded down."""
    n = len(raw)
    s, t = raw.astype(float), target.astype(float)
    return np.floor(SCALE * np.log((t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n)))).astype(np.int64)


def noise(id_: Column, seed: int = SEED) -> Column:
    """Standard Gumbel noise from a hash of the id, in SCALE-ths, rounded down. A null id hashes as an empty one."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.log(-F.log((h + 0.5) / float(1 << 32))) * -SCALE)


def ranks(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` and rank, from 1 in that order: a range sort with the rows' numbers as last key, so that no value is too common to be split."""
    (n, at, part, before) = spare(rows, "n", "at", "part", "before")
    if "rank" in rows.columns:
        raise ValueError("rank is taken")
    numbered = stored(rows.withColumn(n, F.monotonically_increasing_id()))
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), numbered.count() // ROWS_PER_PART)
    # Of a sorted part, a row's number is the part's and its place in it.
    placed = stored(numbered.repartitionByRange(parts, *order, n).sortWithinPartitions(*order, n).withColumn(at, F.monotonically_increasing_id()))
    placed = placed.withColumn(part, F.shiftright(at, 33))
    counts = sorted((r[part], r["count"]) for r in placed.groupBy(part).count().collect())
    starts, below = [], 0
    for k, size in counts:
        starts.append((k, below))
        below += size
    offsets = rows.sparkSession.createDataFrame(starts, f"{part} long, {before} long")
    rank = F.col(before) + F.col(at).bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return placed.join(F.broadcast(offsets), part).select(*rows.columns, rank.alias("rank"))


def weigh(docs: DataFrame, target: DataFrame, lengths: int = LENGTHS, buckets: int = BUCKETS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text") -> DataFrame:
    """(id, key, n_words, n_features, weight, score) for every row of ``docs``; key is a digest of the text.

    weight is the mean gain of a text's features, rounded down (none: 0); score is weight and noise. A null or wordless text has
    no features; repeated rows count as often as they occur and each have a row; a long text is split in pieces that end
    between words; without rows in ``target`` all gains come from the corpus alone; extra columns are ignored.
    """
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))).alias("key"), F.col(text_col).alias("text"))
    found = stored(histograms(source, lengths, buckets))
    gain = gains(totals(found, buckets), totals(histograms(target.select(F.col(target_text).alias("text")), lengths, buckets), buckets))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            each = gain[batch.column("buckets").flatten().to_numpy()] * batch.column("counts").flatten().to_numpy()
            ends = np.cumsum(np.concatenate(([0], batch.column("buckets").value_lengths().to_numpy())))
            sums = np.concatenate(([0], np.cumsum(each)))[ends]
            n = batch.column("n_features").to_numpy()
            weight = (sums[1:] - sums[:-1]) // np.maximum(n, 1)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "key", "n_words", "n_features")), pa.array(weight)], names=["id", "key", "n_words", "n_features", "weight"])

    weighed = found.mapInArrow(run, "id long, key binary, n_words long, n_features long, weight long")
    return weighed.withColumn("score", F.col("weight") + noise(F.col("id"), seed)).withColumnRenamed("id", id_col)


def draw(weighed: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, id_col: str = "doc_id") -> DataFrame:
    """``weighed`` and rank: 1, 2, ... by falling score, then id (null ids last), for the drawn ``percent`` of the rows of enough words; else null."""
    rows = stored(weighed)
    enough = F.col("n_words") >= least_words
    ranked = ranks(rows.where(enough), [F.col("score").desc(), F.col(id_col).asc_nulls_last()])
    most = rows.where(enough).count() * percent // 100
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= most, F.col("rank")))
    return ranked.unionByName(rows.where(~enough).withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, id_col: str = "doc_id", text_col: str = "text", **kwargs) -> DataFrame:
    """The rows of ``docs`` that are drawn, with weight, score and rank. Columns of ``docs`` with these names are replaced.

    Rows that are the same in id and text are drawn by their number: as many as were drawn, whichever.
    """
    docs = docs.drop("weight", "score", "rank")
    drawn = draw(weigh(docs, target, id_col=id_col, text_col=text_col, **kwargs), percent, least_words, id_col).where("rank is not null")
    id_, key, nth = spare(docs, "id", "key", "nth")
    drawn = drawn.select(F.col(id_col).alias(id_), F.col("key").alias(key), "weight", "score", "rank")
    # Equal rows are numbered on both sides; only those that have a drawn one are.
    drawn = drawn.withColumn(nth, F.expr(f"row_number() over (partition by {id_}, {key} order by rank)"))
    own = docs.withColumns({id_: F.col(id_col).cast("long"), key: F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary")))})
    some = drawn.where(F.col(nth) == 1).select(F.col(id_).alias(f"{id_}_"), F.col(key).alias(f"{key}_"))
    own = own.join(some, own[id_].eqNullSafe(some[f"{id_}_"]) & (own[key] == some[f"{key}_"]), "left_semi")
    own = own.withColumn(nth, F.expr(f"row_number() over (partition by {id_}, {key} order by {id_})"))
    out = own.alias("d").join(drawn.alias("w"), own[id_].eqNullSafe(drawn[id_]) & (own[key] == drawn[key]) & (own[nth] == drawn[nth]))
    return out.select(*[F.col(f"d.{c}").alias(c) for c in docs.columns], "w.weight", "w.score", "w.rank")

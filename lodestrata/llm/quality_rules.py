"""Quality rules: plain counts of a text, and a hashed n-gram log-likelihood ratio with a fixed threshold.

The ratio compares two multinomials over hashed word unigrams and bigrams, one of trusted texts and one of the raw corpus.
A text's score is the mean over its n-grams of log(trusted / raw), so that length doesn't count. There is no sampling: a
text is kept if the score reaches the threshold, which is the one that best separates the labelled texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..sources.folders import shared_folder
from .storage import let_go, stored
from .tokens import SPACE, U64, Words, mix, slices, span_hash

BUCKETS = 1 << 16
CUT_FOLDS = 3
MIN_WORDS = 10
WINDOW = 5
REPEAT_PERCENT = 20

# The characters that count as symbols.
SYMBOLS = "#*$%&|<>"

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS.encode())] = True
_COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


@dataclass(frozen=True)
class Ratio:
    """log(trusted / raw) for each bucket, and the least mean ratio of a kept text."""

    weights: np.ndarray
    threshold: float


def _grams(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the unigrams, of the bigrams, and the text that each bigram is in."""
    one = (words.hashes & U64(BUCKETS - 1)).astype(np.int64)
    first, h = words.windows(2)
    return one, (h & U64(BUCKETS - 1)).astype(np.int64), words.owner[first]


def _per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of values between consecutive bounds."""
    sums = np.zeros(len(values) + 1, np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=sums[1:])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def _repeated(owner: np.ndarray, h: np.ndarray) -> np.ndarray:
    """For each (owner, h): 0 if it is the only one of its value, 1 for the first of several, 2 for later ones."""
    if len(h) == 0:
        return np.zeros(0, np.int8)
    key = mix(h ^ mix(owner.astype(U64) + U64(1)))
    order = np.argsort(key, kind="stable")
    k = key[order]
    same = np.zeros(len(k) + 1, bool)
    same[1:-1] = k[1:] == k[:-1]
    kind = np.where(same[:-1], 2, np.where(same[1:], 1, 0)).astype(np.int8)
    out = np.empty(len(k), np.int8)
    out[order] = kind
    return out


def counts(words: Words) -> dict[str, np.ndarray]:
    """The plain counts of each text; words in repeated windows count once, however many windows they are in."""
    text = len(words.offsets) - 1
    starts_char = (words.data & 0xC0) != 0x80
    chars = _per_text((starts_char & ~SPACE[words.data]).astype(np.int64), words.offsets)
    symbols = _per_text(_SYMBOL[words.data].astype(np.int64), words.offsets)
    s, e, own = words.lines()
    dup = np.bincount(own[_repeated(own, span_hash(words.data, s, e)) == 2], minlength=text)
    first, h = words.windows(WINDOW)
    first = first[_repeated(words.owner[first], h) > 0]
    steps = np.zeros(len(words.starts) + 1, np.int64)
    np.add.at(steps, first, 1)
    np.add.at(steps, first + WINDOW, -1)
    repeat = _per_text((np.cumsum(steps[:-1]) > 0).astype(np.int64), words.bounds)
    return {"n_words": words.counts, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": dup, "n_repeat_words": repeat}


def ratio_scores(words: Words, weights: np.ndarray) -> np.ndarray:
    """The mean log ratio over each text's unigrams and bigrams; 0 for a text without words."""
    one, two, own = _grams(words)
    total = _per_text(weights[one], words.bounds) + np.bincount(own, weights[two], len(words.offsets) - 1)
    n = words.counts + np.maximum(words.counts - 1, 0)
    return total / np.maximum(n, 1)


def _tally(rows: DataFrame) -> np.ndarray:
    """How often each bucket occurs in the texts of ``rows``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                one, two, _ = _grams(Words(part.column("text")))
                total += np.bincount(one, minlength=BUCKETS) + np.bincount(two, minlength=BUCKETS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    table = rows.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(BUCKETS)
    out[table["bucket"]] = table["n"]
    return out


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Ratio:
    """Fit the ratio: raw counts over every text, trusted counts over all texts that ``labels`` (id, quality) marks 1.

    One labelled id in CUT_FOLDS isn't counted as trusted; these set the threshold. Labels that are null or contradict each
    other are ignored. Labelled texts are stored once. Without labelled texts every weight is 0 and all texts pass.
    """
    marked = labels.select(F.col(id_col).cast("long").alias("id"), F.col("quality").cast("int").alias("mark")).where("id is not null and mark in (0, 1)")
    marked = marked.groupBy("id").agg(F.min("mark").alias("mark"), F.max("mark").alias("most")).where("mark = most").drop("most")
    marked = marked.withColumn("cut", F.pmod(F.xxhash64("id"), F.lit(CUT_FOLDS)) == 0)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # A shuffle of the texts at every size: labels grow with them, so they are never broadcast.
    labelled = stored(texts.join(marked.where("cut or mark = 1").hint("merge"), "id"))

    good = _tally(labelled.where("not cut"))
    if not good.any():
        let_go(labelled)
        return Ratio(np.zeros(BUCKETS), -np.inf)
    raw = _tally(texts)
    weights = np.log((good + 1) / (good.sum() + BUCKETS)) - np.log((raw + 1) / (raw.sum() + BUCKETS))

    # An id that many rows have counts once, with the lowest ratio of its texts.
    judged = judge(labelled.where("cut"), Ratio(weights, -np.inf)).where("not base_failed")
    threshold = _threshold(judged.groupBy("id").agg(F.first("mark").alias("mark"), F.min("ratio").alias("ratio")))
    let_go(labelled)
    return Ratio(weights, threshold)


def _threshold(marks: DataFrame) -> float:
    """The cut of ``marks`` (ratio, mark) with the best balanced accuracy, in the middle of the widest gap of those. All pass if a class is missing.

    Ratios are sorted into ranges; what earlier ranges have, and where the next one begins, is a row for each range.
    """
    shared_folder(marks.sparkSession)
    ranges = marks.groupBy("ratio").agg(F.count_if(F.col("mark") == 1).alias("good"), F.count_if(F.col("mark") == 0).alias("bad")).repartitionByRange("ratio").withColumn("range", F.spark_partition_id()).checkpoint()
    held = ranges.groupBy("range").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"), F.min("ratio").alias("least")).orderBy("range").collect()
    good, bad = sum(r["good"] for r in held), sum(r["bad"] for r in held)
    if not good or not bad:
        return -np.inf
    before, g, b = [], 0, 0
    for k, r in enumerate(held):
        before.append((r["range"], g, b, held[k + 1]["least"] if k + 1 < len(held) else None))
        g, b = g + r["good"], b + r["bad"]
    before = ranges.sparkSession.createDataFrame(before, "range int, g long, b long, following double")
    own = Window.partitionBy("range").orderBy("ratio")
    so_far = own.rowsBetween(Window.unboundedPreceding, 0)
    rows = ranges.withColumns({"good": F.sum("good").over(so_far), "bad": F.sum("bad").over(so_far), "next": F.lead("ratio").over(own)}).join(F.broadcast(before), "range")
    rows = rows.select("ratio", F.coalesce("next", "following").alias("next"), (F.lit(1.0) - (F.col("g") + F.col("good")) / good + (F.col("b") + F.col("bad")) / bad).alias("value"))
    cuts = rows.where("next is not null").select("value", (F.col("next") - F.col("ratio")).alias("gap"), ((F.col("next") + F.col("ratio")) / 2).alias("cut"))
    # A cut below all ratios keeps all good and no bad texts.
    most = max(cuts.agg(F.max("value")).first()[0] or 1.0, 1.0)
    best = cuts.where(F.abs(F.col("value") - most) <= 1e-8 + 1e-5 * most).orderBy(F.desc("gap"), "cut").first()
    return float(held[0]["least"] - 1 if best is None else best["cut"])


def judge(docs: DataFrame, model: Ratio, text_col: str = "text") -> DataFrame:
    """``docs`` and its counts, base_failed, kept and ratio. Columns of ``docs`` with these names are replaced.

    Null text is empty: no words, base_failed, not kept. A ratio on the threshold is kept; repeated rows are judged each; a long
    text is counted in whole; an empty table gives no rows.
    """
    new = {"n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "ratio", "kept"}
    fields = [f for f in docs.schema.fields if f.name not in new]
    keep = [f.name for f in fields]
    weights, threshold = model.weights, model.threshold

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col):
                words = Words(part.column(text_col), lower=False)
                c = counts(words)
                failed = (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > REPEAT_PERCENT * c["n_words"])
                ratio = ratio_scores(Words(part.column(text_col)), weights)
                more = [*(pa.array(x.astype(np.int64)) for x in c.values()), pa.array(failed), pa.array(~failed & (ratio >= threshold)), pa.array(ratio)]
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in keep), *more], names=[*keep, *c, "base_failed", "kept", "ratio"])

    schema = docs.select(*keep).schema
    for f in (_COUNTS + ", base_failed boolean, kept boolean, ratio double").split(", "):
        schema = schema.add(*f.split(" "))
    return docs.select(*keep).mapInArrow(run, schema)


def rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fit on ``docs`` and ``labels`` and judge every row of ``docs``."""
    return judge(docs, fit(docs, labels, id_col, text_col), text_col)

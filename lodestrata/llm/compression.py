"""Quality by compression: dictionaries of good and of bad texts, and a calibrated difference of compressed sizes."""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from .tokens import slices

PER_CLASS = 1_500
MOST_BYTES = 64 << 10
DICT_BYTES = 400 << 10
LEVEL = 3
HELD_OUT = 5
CUT = 0.3
_CALIBRATION = 3


@dataclass(frozen=True)
class Model:
    """A dictionary for each class (none: no such texts) and the line that turns the difference into log odds."""

    good: bytes
    bad: bytes
    slope: float
    shift: float

    def difference(self, texts: list[bytes]) -> np.ndarray:
        """Compressed with the bad dictionary, less with the good one, over the sum of both."""
        if not (self.good and self.bad):
            return np.zeros(len(texts))
        pack = [zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(d), write_content_size=False, write_dict_id=False) for d in (self.good, self.bad)]
        good, bad = (np.array([len(c.compress(t)) for t in texts], float) for c in pack)
        return (bad - good) / np.maximum(bad + good, 1)

    def score(self, texts: list[bytes]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.difference(texts) + self.shift, -500, 500)))


@functools.lru_cache(maxsize=4)
def _dictionary(body: bytes) -> zstandard.ZstdCompressionDict:
    made = zstandard.ZstdCompressionDict(body)
    made.precompute_compress(level=LEVEL)
    return made


def held_out(id_col: Column) -> Column:
    """True for the ids that nothing is learned from; a null id counts as an empty one."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % HELD_OUT == 0


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, most_bytes: int = MOST_BYTES, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Learn from at most ``per_class`` labelled texts of each class, of ``most_bytes`` at most, taken in the order of a hash of the id.

    Both bound what comes to the driver; every text is scored in whole, however long.

    Two thirds build the dictionaries, one third calibrates. Rows that held_out marks, labels that are null and ids with both
    labels are left out. Without texts of both classes every score is the share of label 1 (one half if there are none).
    """
    marks = labels.select(F.col(id_col).cast("long").alias("id"), F.col("quality").cast("int").alias("mark")).where("id is not null and mark in (0, 1)")
    marks = marks.where(~held_out(F.col("id"))).groupBy("id").agg(F.min("mark").alias("mark"), F.max("mark").alias("most")).where("mark = most")
    marks = marks.select("id", "mark", F.xxhash64("id").alias("order"))
    picked = None
    for mark in (0, 1):
        some = marks.where(F.col("mark") == mark).orderBy("order", "id").limit(per_class)
        picked = some if picked is None else picked.union(some)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).where(F.octet_length("text") <= most_bytes)
    rows = texts.join(F.broadcast(picked), "id").groupBy("id", "mark", "order").agg(F.min("text").alias("text")).toPandas()
    rows = rows.sort_values(["order", "id"], ignore_index=True)
    return train(rows)


def train(rows: pd.DataFrame) -> Model:
    """The model of labelled texts: columns mark, text and order."""
    body = [t.encode("utf-8", "replace") for t in rows["text"]]
    mark = rows["mark"].to_numpy(int)
    calibrate = rows["order"].to_numpy(np.int64) % _CALIBRATION == 0
    share = float(mark.mean()) if len(mark) else 0.5
    prior = float(np.log((share + 1e-6) / (1 - share + 1e-6)))
    books = [_book([b for b, m, c in zip(body, mark, calibrate, strict=True) if m == k and not c]) for k in (1, 0)]
    model = Model(books[0], books[1], 0.0, prior)
    if not all(books) or len(set(mark[calibrate])) < 2:
        return Model(b"", b"", 0.0, prior)
    x = model.difference([b for b, c in zip(body, calibrate, strict=True) if c])
    slope, shift = _logistic(x, mark[calibrate])
    return Model(*books, slope, shift)


def _book(texts: list[bytes]) -> bytes:
    """A dictionary trained on the texts; the texts themselves where there are too few to train on."""
    if not texts:
        return b""
    try:
        return zstandard.train_dictionary(DICT_BYTES, texts, k=256, d=8, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(texts)[-DICT_BYTES:]


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50, ridge: float = 1e-3) -> tuple[float, float]:
    """Slope and intercept by Newton's method, both classes weighing the same as they occur."""
    scale = float(x.std()) or 1.0
    a = np.stack([(x - x.mean()) / scale, np.ones(len(x))], axis=1)
    w = np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (y - p) - ridge * len(x) * w * [1, 0]
        hess = (a * (p * (1 - p))[:, None]).T @ a + np.diag([ridge * len(x), 1e-9])
        step = np.linalg.solve(hess, grad)
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0] / scale), float(w[1] - w[0] * x.mean() / scale)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, score, predicted) for every row and whole text; a null text is empty.

    Repeated rows are scored each; other columns are ignored; an empty table gives no rows; a long text is compressed in whole.
    """
    source = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                p = model.score([t.encode("utf-8", "replace") for t in part.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(p)], names=["id", "score"])

    kind = source.schema["id"].dataType.simpleString()
    scored = source.mapInArrow(run, f"id {kind}, score double")
    return scored.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))

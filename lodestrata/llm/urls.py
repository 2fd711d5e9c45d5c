"""URL filters: rules on host and path, and a logistic regression on hashed character n-grams for the rest."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .tokens import U64, combine, mix, slices

BUCKETS = 1 << 16
GRAMS = (3, 4, 5)
MOST_LABELLED = 20_000

# The rules (verdict, host, start of the path).
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))

# A small table of labelled URLs (1: block) to train from.
LABELLED = (
    ("http://www.online-casino.example/slots/win", 1),
    ("https://casino-bonus.example/en/spin", 1),
    ("http://m.win-casino.example/en/12.html", 1),
    ("https://royal-casino-win.example/jackpot", 1),
    ("http://free-bets.example/odds/today", 1),
    ("https://www.sport-bets.example/en/free", 1),
    ("http://best-free-bets.example/en/41/", 1),
    ("https://betting-tips.example/free-bets", 1),
    ("http://cheap-pills.example/buy/now", 1),
    ("https://www.diet-pills.example/en/order", 1),
    ("http://pills-cheap-online.example/de/7", 1),
    ("https://cheap-meds.example/pills/blue", 1),
    ("http://adult-cams.example/live", 1),
    ("https://hot-xxx-videos.example/en/3", 1),
    ("http://payday-loans.example/fast-cash", 1),
    ("https://replica-watches.example/cheap", 1),
    ("http://free-torrents.example/download/crack", 1),
    ("https://click-here-prize.example/winner", 1),
    ("http://poker-slots.example/en/8", 1),
    ("https://instant-loans-cash.example/apply", 1),
    ("https://news.example/en/2024/article", 0),
    ("http://www.weather.example/forecast/today", 0),
    ("https://docs.python.example/library/json.html", 0),
    ("http://blog.garden.example/fr/tomato", 0),
    ("https://university.example/research/paper.pdf", 0),
    ("https://m.recipes.example/en/1570?page=2", 0),
    ("http://museum.example/de/visit/", 0),
    ("https://en.wiki.example/History_of_science", 0),
    ("http://www.theatre.example/en/1291/", 0),
    ("https://station.example/en/7817?utm_source=feed", 0),
    ("http://library.example/es/catalog/22", 0),
    ("https://www.city.example/council/minutes", 0),
    ("http://weatherhelp.example/en/8423.html", 0),
    ("https://shop.example/books/history", 0),
    ("http://brandnew.example/fr/4163#top", 0),
    ("https://health.example/en/vaccines/faq", 0),
    ("http://blog.music.example/en/notes/5", 0),
    ("https://forum.example/thread/991", 0),
    ("http://www.school.example/de/timetable", 0),
    ("https://planning.example/es/300?page=2&ref=x", 0),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What follows the first :// up to the path (A-Z lower-cased), and the path; empty without ://."""
    url = F.coalesce(url, F.lit(""))
    part = lambda k: F.regexp_extract(url, r"://([^/?#]*)([^?#]*)", k)
    return F.translate(part(1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), part(2)


def fitting_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict; null if none does. Of equal rules the first counts."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, of, start in sorted(reversed(rules), key=lambda r: len(r[1] + r[2])):
        fits = ((host == of) | F.endswith(host, F.lit(f".{of}"))) & F.startswith(path, F.lit(start))
        rule, verdict = F.when(fits, of + start).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


@dataclass(frozen=True)
class Regression:
    """Weights of the n-gram buckets; a text's log odds are their mean over its n-grams, and the bias."""

    weights: np.ndarray
    bias: float

    def odds(self, hosts: pa.Array, paths: pa.Array) -> np.ndarray:
        out = np.full(len(hosts), self.bias)
        for row, bucket, share in _grams(hosts, paths):
            out += np.bincount(row, self.weights[bucket] * share, len(hosts))
        return out


def _grams(hosts: pa.Array, paths: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Text number, bucket and weight of every n-gram; host and path have buckets of their own, and each text's weights have length 1."""
    rows, buckets = [], []
    for salt, texts in enumerate((hosts, paths)):
        for k, t in enumerate(texts.to_pylist()):
            body = np.frombuffer(f"^{t or ''}$".encode("utf-8", "replace"), np.uint8).astype(U64) + U64(256 * salt + 1)
            h = np.concatenate([combine(mix(body), n) for n in GRAMS])
            rows.append(np.full(len(h), k))
            buckets.append((h & U64(BUCKETS - 1)).astype(np.int64))
    if not rows:
        return
    row, bucket = np.concatenate(rows), np.concatenate(buckets)
    yield row, bucket, 1 / np.sqrt(np.maximum(np.bincount(row, minlength=len(hosts)), 1))[row]


def train(table: pd.DataFrame, rounds: int = 300, rate: float = 1.0, ridge: float = 1e-4) -> Regression:
    """Batch gradient steps over labelled hosts and paths (columns host, path, label). One class only: its verdict for all."""
    y = table["label"].to_numpy(float)
    share = y.mean() if len(y) else 0.0
    weights, bias = np.zeros(BUCKETS), float(np.log((share + 1e-3) / (1 - share + 1e-3)))
    if 0 < share < 1:
        row, bucket, size = next(_grams(pa.array(table["host"]), pa.array(table["path"])))
        bias = 0.0
        for _ in range(rounds):
            odds = bias + np.bincount(row, weights[bucket] * size, len(y))
            miss = 1 / (1 + np.exp(-odds)) - y
            weights -= rate * (np.bincount(bucket, miss[row] * size, BUCKETS) / np.sqrt(len(y)) + ridge * weights)
            bias -= rate * miss.mean()
    return Regression(weights, bias)


def fit(labelled: DataFrame, most: int = MOST_LABELLED) -> Regression:
    """Train from (url, label), label 1 for block: at most ``most`` rows, those with the smallest hash of the url. Null labels are left out."""
    host, path = host_and_path(F.col("url"))
    rows = labelled.where("label in (0, 1)").select(host.alias("host"), path.alias("path"), F.col("label").cast("int").alias("label"), F.xxhash64("url").alias("order"))
    return train(rows.orderBy("order", "host", "path", "label").limit(most).toPandas())


def judge(pages: DataFrame, model: Regression, rules=RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict, block_odds) for every row: the longest rule's verdict, else block where the log odds are over 0.

    A null url and one without :// have an empty host and path, which fit no rule and are judged like any other. Repeated rows
    are judged each; other columns are ignored, whatever their names; an empty table gives no rows; a long url is one row.
    """
    host, path = host_and_path(F.col(url_col))
    parts = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "host"):
                odds = model.odds(part.column("host"), part.column("path"))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(odds)], names=["id", "host", "path", "block_odds"])

    kind = parts.schema["id"].dataType.simpleString()
    scored = parts.mapInArrow(run, f"id {kind}, host string, path string, block_odds double")
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("block_odds") > 0, "block").otherwise("allow")
    return scored.select(F.col("id").alias(id_col), "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"), "block_odds")

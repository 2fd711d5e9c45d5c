"""Benchmark decontamination: n-gram seeds find passages, Smith-Waterman alignment of words scores them.

Texts are scanned once against the seeds of a bounded part of the benchmark (one scan for each part of a larger one). An
item's seeds are its n-grams that the fewest items of the benchmark have: no leak makes a seed common. An alignment of some
similarity can break only so many of an item's n-grams, so of one seed more than that at least one is whole: as many seeds
are taken, and some for a margin, and a passage needs as many as the margin. Seeds of one item on near diagonals make
one passage, which goes on to the alignment unless it has too few words of the item for that similarity.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .columns import row_digest, spare
from .storage import cut
from .tokens import U64, Words, slices

SEED_WORDS = 2
SIMILARITY = 0.5
PART_BYTES = 16 << 20
#: For so many words of an item it has one more seed than it needs to have, and a passage needs one more.
MARGIN = 8
WINDOW = 8
_CELLS = 4 << 20
_HITS = 1 << 16
_BATCH_CHARS = 4 << 20


def breakable(n: int, length: np.ndarray, similarity: float) -> np.ndarray:
    """How many n-grams of an item an alignment that scores ``similarity`` can break at most.

    Of m matched words with e errors, m - e is similarity * length at least; there are e + 1 runs of matches at most, and each
    has n - 1 n-grams fewer than words.
    """
    return np.floor(max(1, n - 1) * (1 - similarity) * length + 1e-9).astype(np.int64)


class Seeds:
    """The rarest n-grams of each of some items: sorted hashes, and for each the items and offsets that have it.

    least has for each item how many of its seeds an alignment of ``similarity`` keeps whole; n-grams are as long as ``n``
    allows and that is one or more. An item of one or two words has one seed, all of it.
    """

    def __init__(self, ids: list[int], texts: list[str | None], n: int = SEED_WORDS, similarity: float = SIMILARITY):
        if not 0 < similarity <= 1:
            raise ValueError("a similarity is above 0 and at most 1")
        words = Words(pa.array([t or "" for t in texts], pa.string()))
        self.n, self.ids, self.lengths, self.similarity = n, np.array(ids, np.int64), words.counts, similarity
        self.words, self.bounds = words.hashes, words.bounds
        width, lost = np.minimum(self.lengths, 2), np.zeros(len(self.lengths), np.int64)
        for k in range(1, n + 1):
            broken = breakable(k, self.lengths, similarity)
            fits = (self.lengths > 2) & (broken < self.lengths - k + 1)
            width, lost = np.where(fits, k, width), np.where(fits, broken, lost)
        rows = []
        for k in sorted(set(width[width > 0].tolist())):
            first, h = words.windows(k)
            item = words.owner[first]
            own = width[item] == k
            rows.append((np.full(own.sum(), k), h[own], item[own], (first - words.bounds[item])[own]))
        size, h, item, offset = (np.concatenate(x) for x in zip(*rows, strict=True)) if rows else (np.zeros(0, np.int64),) * 4
        h, item, offset = h.astype(U64), item.astype(np.int64), offset.astype(np.int64)
        rare = _rarest(h, item, size, lost + 1 + self.lengths // MARGIN)
        h, item, offset, size = h[rare], item[rare], offset[rare], size[rare]
        self.least = np.bincount(item, minlength=len(self.lengths)) - lost
        order = np.lexsort((offset, size, item, h))
        self.h, self.item, self.offset, self.size = h[order], item[order], offset[order], size[order]
        # Rows of one n-gram and item stand together: the number of each row's group, and the groups' first rows.
        fresh = np.ones(len(self.h), bool)
        fresh[1:] = (self.h[1:] != self.h[:-1]) | (self.item[1:] != self.item[:-1]) | (self.size[1:] != self.size[:-1])
        self.group, self.begin = np.cumsum(fresh) - 1, np.append(np.flatnonzero(fresh), len(self.h))
        self.widths = sorted(set(size.tolist()))

    def hits(self, words: Words) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Text, item, and first and last diagonal of every occurrence of an item's seed, some occurrences at a time.

        A seed that an item repeats gives one row, from its last place in the item to its first. Before them the first word
        that later occurrences of these items can have.
        """
        for k in self.widths:
            first, h = words.windows(int(k))
            low = np.searchsorted(self.h, h, "left")
            found = (low < len(self.h)) & (self.h[np.minimum(low, len(self.h) - 1)] == h)
            first, h, low = first[found], h[found], low[found]
            high = np.searchsorted(self.h, h, "right")
            text = words.owner[first]
            many = np.cumsum(self.group[np.maximum(high, 1) - 1] - self.group[low] + 1)
            at = 0
            while at < len(first):
                to = max(at + 1, int(np.searchsorted(many, (many[at - 1] if at else 0) + _HITS, "right")))
                g = self.group[low[at:to]]
                n = self.group[high[at:to] - 1] - g + 1
                of = np.repeat(np.arange(at, to), n)
                g = np.repeat(g - (np.cumsum(n) - n), n) + np.arange(n.sum())
                own = self.size[self.begin[g]] == k
                of, g = of[own], g[own]
                begin, end = self.begin[g], self.begin[g + 1] - 1
                upto = int(first[to]) if to < len(first) else len(words.hashes) + int(self.lengths.max()) * 3 + 3
                yield upto, text[of], self.item[begin], first[of] - self.offset[end], first[of] - self.offset[begin]
                at = to


def _rarest(h: np.ndarray, item: np.ndarray, size: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The rows of each item's n-grams that the fewest items have, all rows of an n-gram or none, until there are as many as wanted."""
    order = np.lexsort((size, h, item))
    fresh = np.ones(len(h), bool)
    fresh[1:] = (item[order][1:] != item[order][:-1]) | (h[order][1:] != h[order][:-1]) | (size[order][1:] != size[order][:-1])
    group = np.cumsum(fresh) - 1
    first = order[np.flatnonzero(fresh)]
    rows = np.bincount(group, minlength=len(first))
    _, of, items = np.unique(h[first], return_inverse=True, return_counts=True)
    rank = np.lexsort((h[first], items[of], item[first]))
    before = np.cumsum(rows[rank]) - rows[rank]
    own = item[first][rank]
    start = np.concatenate(([True], own[1:] != own[:-1])) if len(own) else np.zeros(0, bool)
    before -= before[np.flatnonzero(start)][np.cumsum(start) - 1] if len(own) else 0
    taken = np.zeros(len(first), bool)
    taken[rank] = before < wanted[own]
    return np.sort(order[taken[group]])


def _merged(text: np.ndarray, item: np.ndarray, low: np.ndarray, high: np.ndarray, count: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, ...]:
    """Ranges of diagonals of one text and item put together where at most ``room`` (by item) is between them; counts are added up."""
    order = np.lexsort((low, item, text))
    text, item, low, high, count = text[order], item[order], low[order], high[order], count[order]
    if not len(text):
        return text, item, low, high, count
    pair = np.concatenate(([0], np.cumsum((np.diff(text) != 0) | (np.diff(item) != 0))))
    span = int(high.max() - min(low.min(), high.min())) + 1
    reach = np.maximum.accumulate(pair * span + (high - high.min())) - pair * span + high.min()
    fresh = np.concatenate(([True], (np.diff(pair) > 0) | (low[1:] > reach[:-1] + room[item[1:]])))
    at = np.flatnonzero(fresh)
    return text[at], item[at], low[at], reach[np.append(at[1:], len(text)) - 1], np.add.reduceat(count, at)


def _runs(words: Words, seeds: Seeds, room: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Runs of enough hits. A run that no later hit can be near to is done: kept or forgotten, so that few are held at once."""
    held = tuple(np.zeros(0, np.int64) for _ in range(5))
    for upto, *part in seeds.hits(words):
        new = (*part, np.ones(len(part[0]), np.int64))
        runs = _merged(*(np.concatenate(x) for x in zip(held, new, strict=True)), room)
        item, high, count = runs[1], runs[3], runs[4]
        done = high + room[item] < upto - seeds.lengths[item]
        enough = done & (count >= seeds.least[item])
        yield tuple(x[enough] for x in runs[:4])
        held = tuple(x[~done] for x in runs)


def passages(words: Words, seeds: Seeds, similarity: float | None = None) -> Iterator[tuple[int, int, int, str]]:
    """(text, item, first word, passage) for each run of hits on near diagonals, with room for gaps around it.

    Nothing that an alignment could score ``similarity`` on (that of the seeds at least) is left out. Such an alignment of an
    item of n words has at most (1 - similarity) * n gaps, so all its hits are in one run; and it has similarity * n of the
    item's words. A run of more than WINDOW item lengths is cut into windows that overlap by as much as any such alignment spans.
    """
    similarity = seeds.similarity if similarity is None else similarity
    room = np.ceil((1 - similarity) * seeds.lengths).astype(np.int64) + 1
    for t, i, a, b in (row for runs in _runs(words, seeds, room) for row in zip(*(x.tolist() for x in runs), strict=True)):
        length = int(seeds.lengths[i])
        begin = max(a - int(room[i]), int(words.bounds[t]))
        stop = min(b + length + int(room[i]), int(words.bounds[t + 1]))
        wide, step = WINDOW * length, WINDOW * length - math.ceil((2 - similarity) * length) - 1
        own = seeds.words[seeds.bounds[i] : seeds.bounds[i + 1]]
        for low in range(begin, stop, step) if stop - begin > wide and step > 0 else (begin,):
            high = min(low + wide, stop) if step > 0 else stop
            if np.isin(own, words.hashes[low:high]).sum() / length >= similarity:
                body = words.data[words.starts[low] : words.ends[high - 1]].tobytes()
                yield t, i, low - int(words.bounds[t]), b" ".join(body.split()).decode("utf-8", "replace")
            if high == stop:
                break


def align(passage: np.ndarray, item: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smith-Waterman over pairs of word ids (rows; 0 and -1 are padding): the best score and the passage word it ends at.

    A match scores 1, a mismatch or a gap -1; of equal scores the one that ends first counts.
    """
    n, width = passage.shape
    column = np.arange(width, dtype=np.int32)
    best, end, row = np.zeros(n, np.int32), np.zeros(n, np.int32), np.zeros((n, width + 1), np.int32)
    for k in range(item.shape[1]):
        new = np.where(passage == item[:, k : k + 1], row[:, :-1] + 1, row[:, :-1] - 1)
        np.maximum(new, row[:, 1:] - 1, out=new)
        np.maximum(new, 0, out=new)
        np.maximum.accumulate(new + column, axis=1, out=new)
        new -= column
        row[:, 1:] = new
        j = new.argmax(axis=1)
        top = new[np.arange(n), j]
        better = (top > best) | ((top == best) & (top > 0) & (j < end))
        best, end = np.where(better, top, best), np.where(better, j, end)
    return best, end


def _padded(rows: list[list[int]], fill: int, flip: bool = False) -> np.ndarray:
    out = np.full((len(rows), max(1, max(map(len, rows), default=1))), fill, np.int32)
    for k, r in enumerate(rows):
        out[k, : len(r)] = r[::-1] if flip else r
    return out


def score_pairs(passage: list[str], item: list[str]) -> tuple[list[float], list[int], list[int]]:
    """For each pair of texts: the alignment score over the item's number of words, and the first and last aligned passage word."""
    number: dict[str, int] = {}
    ids = lambda t: [number.setdefault(w, len(number) + 1) for w in t.split(" ")] if t else []
    a, b = [ids(t) for t in passage], [ids(t) for t in item]
    score, start, stop = [0.0] * len(a), [0] * len(a), [0] * len(a)
    order = sorted(range(len(a)), key=lambda k: len(a[k]))
    while order:
        width = max(1, len(a[order[-1]]))
        take, order = order[-max(1, _CELLS // width) :], order[: -max(1, _CELLS // width)]
        p, q = [a[k] for k in take], [b[k] for k in take]
        best, end = align(_padded(p, 0), _padded(q, -1))
        _, back = align(_padded([x[: e + 1] for x, e in zip(p, end.tolist(), strict=True)], 0, True), _padded(q, -1, True))
        for k, s, e, r in zip(take, best.tolist(), end.tolist(), back.tolist(), strict=True):
            score[k], start[k], stop[k] = s / max(1, len(b[k])), max(0, e - r), e
    return score, start, stop


def contaminated(
    docs: DataFrame, items: DataFrame, seed_words: int = SEED_WORDS, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """(id, key, item id, similarity, first_word, last_word): the best passage of each text for each item it leaks.

    key is a 128-bit digest of id and text. similarity is the alignment score divided by the item's words, 1 for an exact copy. Null and
    wordless texts and items match nothing; an item of one or two words has one seed, all of it. Equal item texts
    are scored each; of equally good passages the first counts. Rows that are the same in id and text give one row for each
    item. A long text is scanned in bounded memory, whatever the number of items. Empty tables give no rows; extra columns are
    ignored. Any ``similarity`` above 0 and any number of seed words miss nothing; the longer the seeds the fewer they are.
    """
    source = docs.select(row_digest(id_col, text_col).alias("key"), F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    bench = items.select(F.col(item_id).cast("long").alias("item"), F.coalesce(F.col(item_text), F.lit("")).alias("item_text"))
    parts = max(1, math.ceil((bench.agg(F.sum(F.octet_length("item_text"))).first()[0] or 0) / PART_BYTES))
    out = None
    for part in range(parts):
        rows = bench.where(F.pmod(F.xxhash64("item", "item_text"), F.lit(parts)) == part).orderBy("item", "item_text").collect()
        found = _contaminated(source, [r["item"] for r in rows], [r["item_text"] for r in rows], seed_words, similarity)
        out = found if out is None else out.unionByName(found)
    return out.select(F.col("id").alias(id_col), "key", F.col("item").alias(item_id), "similarity", "first_word", "last_word")


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kwargs) -> DataFrame:
    """The rows of ``docs`` whose text leaks no item."""
    (key,) = spare(docs, "key")
    leaks = contaminated(docs, items, id_col=id_col, text_col=text_col, **kwargs).select(F.col("key").alias(key)).distinct()
    return docs.withColumn(key, row_digest(id_col, text_col)).join(leaks, key, "left_anti").select(*docs.columns)


def _in_parts(found: Iterable[tuple[int, int, int, str]]) -> Iterator[list[tuple[int, int, int, str]]]:
    """Passages in lists of about _BATCH_CHARS characters."""
    part, size = [], 0
    for row in found:
        part.append(row)
        size += len(row[3])
        if size >= _BATCH_CHARS:
            yield part
            part, size = [], 0
    if part:
        yield part


def _contaminated(source: DataFrame, ids: list[int], texts: list[str], seed_words: int, similarity: float) -> DataFrame:
    seeds = Seeds(ids, texts, seed_words, similarity)
    plain = [b" ".join(t.encode("utf-8", "replace").lower().split()).decode("utf-8", "replace") for t in texts]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                for got in _in_parts(passages(Words(piece.column("text")), seeds) if len(seeds.h) else ()):
                    t, item, first, passage = zip(*got, strict=True)
                    at = pa.array(t)
                    out = [piece.column("key").take(at), piece.column("id").take(at), pa.array(item, pa.int32()), pa.array(first, pa.int32()), pa.array(passage)]
                    yield pa.RecordBatch.from_arrays(out, names=["key", "id", "slot", "first", "passage"])

    found = cut(source.mapInArrow(scan, "key binary, id long, slot int, first int, passage string"))
    live = found.distinct()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = batch.column("slot").to_pylist()
            s, a, b = score_pairs(batch.column("passage").to_pylist(), [plain[k] for k in slot])
            item = pa.array([ids[k] for k in slot], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("slot"), batch.column("passage"), item, pa.array(s, pa.float64()), pa.array(a, pa.int32()), pa.array(b, pa.int32())], names=["slot", "passage", "item", "similarity", "a", "b"])

    pairs = live.select("slot", "passage").distinct().mapInArrow(score, "slot int, passage string, item long, similarity double, a int, b int").where(F.col("similarity") >= similarity)
    full = live.join(pairs, ["slot", "passage"]).select("key", "id", "item", F.struct("similarity", (-(F.col("first") + F.col("a"))).alias("a"), (F.col("first") + F.col("b")).alias("b")).alias("best"))
    best = full.groupBy("key", "id", "item").agg(F.max("best").alias("best"))
    return best.select("key", "id", "item", "best.similarity", (-F.col("best.a")).alias("first_word"), F.col("best.b").alias("last_word"))

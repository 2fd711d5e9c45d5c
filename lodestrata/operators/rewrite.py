"""Texts rewritten by a table of pairs, with the result of replacing pair after pair in the table's order.

An Aho-Corasick automaton finds all old strings in one pass over a text, so a text costs its length and its matches, however
many pairs there are. Earlier pairs win where matches overlap. What a replacement makes is looked at with what is around it:
if that holds an old string of a later pair, which only then exists, the text is rewritten pair by pair instead. The table is
cut into parts of bounded size, in order; each part is one pass over the texts.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from ..sources.folders import shared_folder

PART_BYTES = 8 << 20
#: So many bytes of rows are Python objects at once, of a batch of any size; a longer row is alone.
TEXT_BYTES = 2 << 20


class _Fold(dict):
    """The one letter that stands for all cases of a letter; a letter beyond ASCII never stands for an ASCII one."""

    def __missing__(self, code: int) -> int:
        upper = chr(code).upper()
        self[code] = code if len(upper) != 1 or code > 0xFFFF or (code > 0x7F and ord(upper) <= 0x7F) else ord(upper)
        return self[code]


_FOLD = _Fold()


class Rewriter:
    """The pairs of one part. ``every``: all occurrences of each old string, else its first; ``fold``: whatever its case."""

    def __init__(self, pairs: list[tuple[str, str]], every: bool = True, fold: bool = True):
        self.every, self.fold, self.pairs = every, fold, pairs
        self.reach = max((len(old) for old, _ in pairs), default=1) - 1
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        self.same: dict[int, int] = {}  # the next pair whose old string is the same but for its case
        for k in reversed(range(len(pairs))):
            old = self.folded(pairs[k][0])
            if (later := self.automaton.get(old, -1)) >= 0:
                self.same[k] = later
            self.automaton.add_word(old, k)
        if pairs:
            self.automaton.make_automaton()

    def folded(self, text: str) -> str:
        """As long as ``text``, with one form for all cases."""
        return text if not self.fold else text.upper() if text.isascii() else text.translate(_FOLD)

    def found(self, text: str) -> Iterator[tuple[int, int]]:
        """(pair, first character) of every occurrence, by last character."""
        for end, k in self.automaton.iter(self.folded(text)):
            at = end + 1 - len(self.pairs[k][0])
            while k is not None:
                yield k, at
                k = self.same.get(k)

    def __call__(self, text: str | None) -> str | None:
        if not text or not self.pairs:
            return text
        hits: dict[int, list[int]] = {}
        for k, at in self.found(text):
            hits.setdefault(k, []).append(at)
        return self._at_once(text, hits) if hits else text

    def _at_once(self, text: str, hits: dict[int, list[int]]) -> str:
        """The occurrences that no earlier pair has broken, each replaced where it is."""
        gone, value, start = bytearray(len(text)), {}, {}
        for k in sorted(hits):
            (old, new), made, last = self.pairs[k], [], 0
            size = len(old)
            for at in hits[k]:
                if at < last or gone.find(1, at, at + size) >= 0:
                    continue
                last = at + size
                gone[at:last] = b"\1" * size
                value[at], start[last] = (last, new), at
                made.append(at)
                if not self.every:
                    break
            for at in made:
                left, right = self._before(text, at, gone, value, start), self._after(text, at + size, gone, value)
                low, high = len(left), len(left) + len(new)
                if any(j > k and a < high and a + len(self.pairs[j][0]) > low for j, a in self.found(left + new + right)):
                    return self._one_by_one(text)
        out, at = [], 0
        for s in sorted(value):
            out += [text[at:s], value[s][1]]
            at = value[s][0]
        return "".join([*out, text[at:]])

    def _before(self, text: str, at: int, gone: bytearray, value: dict, start: dict) -> str:
        """As much of the text as rewritten so far, up to a place, as an old string can reach."""
        out, n = [], self.reach
        while n > 0 and at > 0:
            if at in start:
                at = start[at]
                part = value[at][1]
            else:
                low = max(0, at - n)
                low = max(low, gone.rfind(1, low, at) + 1)
                part, at = text[low:at], low
            out.append(part[-n:])
            n -= len(part)
        return "".join(reversed(out))

    def _after(self, text: str, at: int, gone: bytearray, value: dict) -> str:
        out, n = [], self.reach
        while n > 0 and at < len(text):
            if at in value:
                at, part = value[at]
            else:
                high = gone.find(1, at, at + n)
                high = min(len(text), at + n) if high < 0 else high
                part, at = text[at:high], high
            out.append(part[:n])
            n -= len(part)
        return "".join(out)

    def _one_by_one(self, text: str) -> str:
        """Pair by pair, over the pairs that are found in what the text has become."""
        waiting, last = sorted({k for k, _ in self.found(text)}), -1
        while waiting:
            k = heapq.heappop(waiting)
            if k <= last:
                continue
            last, whole, old, new = k, self.folded(text), self.folded(self.pairs[k][0]), self.pairs[k][1]
            out, at, hit = [], 0, whole.find(old)
            while hit >= 0:
                out += [text[at:hit], new]
                at = hit + len(old)
                hit = whole.find(old, at) if self.every else -1
            text = "".join([*out, text[at:]])
            waiting = sorted({j for j, _ in self.found(text) if j > k})
        return text


_built: dict[tuple, Rewriter] = {}


def _rewriter(shared: Broadcast, every: bool, fold: bool) -> Rewriter:
    """One automaton for each Python worker: that of the part it works on."""
    key = (id(shared.value), every, fold)  # what is built keeps the value, so the number is its own
    if key not in _built:
        _built.clear()
        _built[key] = Rewriter(shared.value, every, fold)
    return _built[key]


def changed(batches: Iterator[pa.RecordBatch], change: Callable[[str | None], str | None], places: list[int]) -> Iterator[pa.RecordBatch]:
    """``batches`` with ``change`` applied to each text of the columns at ``places``, in pieces of some TEXT_BYTES."""
    for batch in batches:
        step = max(1, batch.num_rows * TEXT_BYTES // max(1, batch.nbytes))
        for first in range(0, batch.num_rows, step):
            piece = batch.slice(first, step)
            arrays = list(piece.columns)
            for at in places:
                kind = arrays[at].type
                texts = arrays[at].to_pylist()
                new = [None if t is None else [change(x) for x in t] for t in texts] if pa.types.is_list(kind) else list(map(change, texts))
                arrays[at] = pa.array(new, kind)
            yield pa.RecordBatch.from_arrays(arrays, schema=piece.schema)


def in_order(pairs: DataFrame) -> DataFrame:
    """``pairs`` (old, new, ord) with each old string once, at its first place with its last value; null and empty ones are left out."""
    some = pairs.where(F.length("old") > 0)
    return some.groupBy("old").agg(F.min("ord").alias("ord"), F.max_by(F.coalesce("new", F.lit("")), "ord").alias("new"))


def _parts(pairs: DataFrame, part_bytes: int) -> list[DataFrame]:
    """``pairs`` cut by order into parts of at most twice ``part_bytes``, none of which any step gathers with another."""
    shared_folder(pairs.sparkSession)
    pairs = pairs.checkpoint()
    size = F.sum(F.octet_length("old") + F.octet_length("new"))
    n = 1 + (pairs.agg(size.alias("n")).first()["n"] or 0) // part_bytes
    while True:
        cut = pairs.repartitionByRange(n, "ord", "old").withColumn("part", F.spark_partition_id()).checkpoint() if n > 1 else pairs.withColumn("part", F.lit(0))
        sizes = {r["part"]: r["n"] for r in cut.groupBy("part").agg(size.alias("n")).collect()}
        if n == 1 or max(sizes.values(), default=0) <= 2 * part_bytes or n > 1 << 16:
            return [cut.where(F.col("part") == p) for p in sorted(sizes)]
        n *= 2


def rewrite(rows: DataFrame, columns: list[str], pairs: DataFrame, every: bool = True, fold: bool = True, part_bytes: int = PART_BYTES) -> DataFrame:
    """``rows`` with the texts in ``columns`` (string, or array of strings) rewritten by ``pairs`` (old, new, ord).

    As if for one pair after another, by ord and then old string, ``every`` occurrence, or else the first, was replaced; with
    ``fold`` whatever its case. A later pair sees what earlier ones made. Null stays null, empty texts stay, no pairs change
    nothing; repeated rows are each rewritten. A part of the pairs is broadcast, of at most twice ``part_bytes``; with several
    parts the texts are stored between them.
    """
    parts = _parts(in_order(pairs), part_bytes)
    context, schema = rows.sparkSession.sparkContext, rows.schema
    places = [rows.columns.index(c) for c in columns]
    for number, part in enumerate(parts):
        table = [(r["old"], r["new"]) for r in part.orderBy("ord", "old").collect()]
        shared = context.broadcast(table)

        def run(batches: Iterator[pa.RecordBatch], shared: Broadcast = shared) -> Iterator[pa.RecordBatch]:
            yield from changed(batches, _rewriter(shared, every, fold), places)

        rows = rows.mapInArrow(run, schema)
        if number + 1 < len(parts):
            rows = rows.checkpoint()
    return rows

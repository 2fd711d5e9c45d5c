"""SentencePiece encoding and decoding by suffix-array matching.

The new units of a batch are put in a row and indexed by a suffix array; a binary search finds the range of suffixes that
begin with each piece; the occurrences, dealt out by position and length, are the edges of the segmentation. For a model of
byte-pair pieces the edges are relaxed in the model's own order: of the edges that join two neighbouring pieces, the best
scored goes first, and of equal ones the leftmost, until none is left. Edges of different units, and of places in a long unit
that are too far apart to meet, are relaxed at once. Units end where no piece can cross.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BooleanType, DataType, IntegerType, StringType, StructType

from .tokens import list_array, slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
_CHARS = 1 << 18
_SHORT = 64
_KEPT_UNITS = 250_000
_SLICE_BYTES = 1 << 20
_SLICE_IDS = 1 << 18
_NEVER = np.float32(-np.inf)


class Pieces:
    """A byte-pair SentencePiece vocabulary, read once on the driver: plain arrays that tasks get with the function."""

    def __init__(self, model: str = MODEL):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=model)
        self.text = [sp.id_to_piece(k) for k in range(len(sp))]
        self.unknown = sp.unk_id()
        special = {k for k in range(len(sp)) if sp.is_control(k) or sp.is_unknown(k)}
        self.byte_id = {int(self.text[k][3:5], 16): k for k in range(len(sp)) if sp.is_byte(k)}
        plain = [k for k in range(len(sp)) if k not in special and not sp.is_byte(k)]
        self.special = special
        self.prefix = sp.decode(sp.encode("a")) == "a" and self.text[sp.encode("a")[0]].startswith(SPACE)
        self.single = {self.text[k]: k for k in plain if len(self.text[k]) == 1}
        many = [k for k in plain if len(self.text[k]) > 1]
        self.many = np.array(many, np.int32)
        self.score = np.array([sp.get_score(k) for k in many], np.float32)
        self.longest = max((len(self.text[k]) for k in many), default=1)
        self.codes = np.zeros((len(many), self.longest), np.uint32)
        for row, k in enumerate(many):
            self.codes[row, : len(self.text[k])] = [ord(c) for c in self.text[k]]
        self.length = (self.codes > 0).sum(axis=1)
        joined = {c for k in many for c in self.text[k]}
        crosses = any(SPACE in self.text[k].lstrip(SPACE) for k in many)
        inner = "".join(map(re.escape, sorted(joined - {SPACE})))
        self.pattern = f"[{SPACE}{inner}]+|." if crosses else f"{SPACE}*[{inner}]+|{SPACE}+|."

    def of_char(self, c: str) -> list[int]:
        """The ids of a character that is in no longer piece: its own, or those of its bytes, or unknown."""
        if c in self.single:
            return [self.single[c]]
        return [self.byte_id[b] for b in c.encode()] if self.byte_id else [self.unknown]


class Encoder:
    """Encodes texts; the ids of units seen lately are kept."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.units = re.compile(pieces.pattern, re.DOTALL).findall
        self.clear()

    def clear(self) -> None:
        self.slot: dict[str, int] = {}
        self.flat, self.ends = array("i"), array("q", [0])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and how many each text has."""
        if len(self.slot) > _KEPT_UNITS:
            self.clear()
        lead = SPACE if self.pieces.prefix else ""
        found = [self.units(lead + t.replace(" ", SPACE)) if t else [] for t in texts]
        flat_units = list(chain.from_iterable(found))
        slots = list(map(self.slot.get, flat_units))
        missing = [k for k, s in enumerate(slots) if s is None]
        new = sorted({flat_units[k] for k in missing}, key=lambda u: (len(u) > _SHORT, u))
        long = sum(len(u) > _SHORT for u in new)
        at = 0
        while at < len(new):
            to, size = at, 0
            while to < len(new) and (to == at or size + len(new[to]) + 1 <= _CHARS and to != len(new) - long):
                size += len(new[to]) + 1
                to += 1
            ids, counts = segment(new[at:to], self.pieces)
            base = self.ends[-1]
            self.slot.update(zip(new[at:to], range(len(self.slot), len(self.slot) + to - at)))
            self.flat.frombytes(ids.astype(np.int32).tobytes())
            self.ends.frombytes((np.cumsum(counts) + base).astype(np.int64).tobytes())
            at = to
        for k in missing:
            slots[k] = self.slot[flat_units[k]]
        unit = np.array(slots, np.int64)
        per_text = np.array([len(row) for row in found], np.int64)
        ends, flat = np.frombuffer(self.ends, np.int64).copy(), np.frombuffer(self.flat, np.int32).copy()
        start, n = ends[unit], ends[unit + 1] - ends[unit]
        index = np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())
        sums = np.zeros(len(unit) + 1, np.int64)
        np.cumsum(n, out=sums[1:])
        bounds = np.concatenate(([0], np.cumsum(per_text)))
        return flat[index], np.diff(sums[bounds])


def edges(codes: np.ndarray, pieces: Pieces) -> np.ndarray:
    """Row numbers of pieces by start and length (-1: none): every occurrence of every longer piece in ``codes`` (0 parts units)."""
    n, width = len(codes), pieces.longest
    known = np.unique(codes)
    table = np.full((n, width + 1), -1, np.int32)
    where = np.searchsorted(known, pieces.codes)
    where = np.minimum(where, len(known) - 1)
    usable = ((known[where] == pieces.codes) | (pieces.codes == 0)).all(axis=1)
    rows = np.flatnonzero(usable)
    if not len(rows):
        return table
    padded = np.zeros(n + width, ">u2")  # in this byte order, comparing bytes compares codes
    padded[:n] = np.searchsorted(known, codes)
    suffixes = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded, width)[:n]).view(f"S{2 * width}").ravel()
    order = np.argsort(suffixes, kind="stable")
    suffixes = suffixes[order]
    low = np.where(pieces.codes[rows] == 0, 0, where[rows]).astype(">u2")
    high = np.where(pieces.codes[rows] == 0, 0xFFFF, where[rows]).astype(">u2")
    first = np.searchsorted(suffixes, low.view(f"S{2 * width}").ravel(), "left")
    last = np.searchsorted(suffixes, high.view(f"S{2 * width}").ravel(), "right")
    count = last - first
    row = np.repeat(rows, count)
    start = order[np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())]
    table[start, pieces.length[row]] = row
    return table


def _best_of_each(value: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The leftmost of the best edges of each unit, and the units' numbers."""
    first = np.cumsum(size) - size
    hit = np.flatnonzero(value == np.repeat(np.maximum.reduceat(value, first), size))
    unit = np.searchsorted(first, hit, "right") - 1
    once = np.concatenate(([True], unit[1:] != unit[:-1]))
    return hit[once], unit[once]


def _best_nearby(value: np.ndarray, size: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """The edges that no other within ``reach`` tokens beats, and their units' numbers; of neighbouring equal ones every other, from the left.

    What joining makes scores below what was joined, and no piece is longer than ``reach``: so whatever goes on farther off
    can't put a better edge beside one of these, and they can be relaxed together.
    """
    top = np.concatenate((np.full(reach, _NEVER), value, np.full(reach, _NEVER)))
    span, wide = 1, 2 * reach + 1
    while 2 * span <= wide:
        top = np.maximum(top[:-span], top[span:])
        span *= 2
    top = np.maximum(top[: len(value)], top[wide - span :])
    safe = (value == top) & (value > _NEVER)
    start = np.concatenate(([True], value[1:] != value[:-1]))
    since = np.flatnonzero(start)[np.cumsum(start) - 1]
    unsafe = np.cumsum(~safe)
    hit = np.flatnonzero(safe & (unsafe == unsafe[since]) & safe[since] & ((np.arange(len(value)) - since) % 2 == 0))
    return hit, np.searchsorted(np.cumsum(size) - size, hit, "right") - 1


def segment(units: list[str], pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all units in a row, and how many each has."""
    short = max(map(len, units)) <= _SHORT
    text = "\0".join(units) + "\0"
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    breaks = np.flatnonzero(codes == 0) if "\0" not in "".join(units) else np.cumsum([len(u) + 1 for u in units]) - 1
    codes = codes.copy()
    nul = np.flatnonzero(codes == 0)
    codes[np.setdiff1d(nul, breaks)] = 0x110000  # a zero character of a text: above all others, in no piece
    table = edges(codes, pieces)
    score = np.append(pieces.score, _NEVER)
    limit = pieces.longest
    begins = np.ones(len(codes), bool)
    begins[breaks] = False

    # Tokens that are still being joined: start, end, whether the next is in the same unit, and the score of joining with it.
    s = np.flatnonzero(begins)
    size = np.diff(np.concatenate(([-1], breaks))) - 1
    size = size[size > 0]
    e = s + 1
    tail = np.zeros(len(s), bool)
    tail[np.cumsum(size) - 1] = True

    def joins(at: np.ndarray) -> np.ndarray:
        nxt = np.minimum(at + 1, len(s) - 1)
        span = e[nxt] - s[at]
        ok = ~tail[at] & (span <= limit)
        return np.where(ok, score[table[s[at], np.where(ok, span, 0)]], _NEVER)

    value = joins(np.arange(len(s)))
    while len(s):
        first = np.cumsum(size) - size
        live = np.maximum.reduceat(value, first) > _NEVER
        if not live.all():
            keep = np.repeat(live, size)
            s, e, tail, value, size = s[keep], e[keep], tail[keep], value[keep], size[live]
            if not len(s):
                break
        hit, unit = _best_of_each(value, size) if short else _best_nearby(value, size, limit)
        begins[s[hit + 1]] = False
        e[hit] = e[hit + 1]
        tail[hit] = tail[hit + 1]
        keep = np.ones(len(s), bool)
        keep[hit + 1] = False
        at = hit - np.arange(len(hit))
        s, e, tail, value = s[keep], e[keep], tail[keep], value[keep]
        size = size - np.bincount(unit, minlength=len(size))
        value[at] = joins(at)
        before = at[at > (np.cumsum(size) - size)[unit]] - 1
        value[before] = joins(before)

    s = np.flatnonzero(begins)
    stop = np.minimum(np.append(s[1:], len(codes)), breaks[np.searchsorted(breaks, s)])
    row = table[s, np.minimum(stop - s, limit)]
    row[stop - s == 1] = -1
    char, which = np.unique(codes[s], return_inverse=True)
    ids = [pieces.of_char(chr(c) if c < 0x110000 else "\0") for c in char.tolist()]
    width = np.array([len(x) for x in ids], np.int64)
    flat = np.array([i for x in ids for i in x], np.int64)
    offset = np.cumsum(width) - width
    n = np.where(row >= 0, 1, width[which])
    token = np.repeat(np.arange(len(s)), n)
    k = np.arange(len(token)) - np.repeat(np.cumsum(n) - n, n)
    out = np.where(row[token] >= 0, pieces.many[row[token]] if len(pieces.many) else 0, flat[np.minimum(offset[which[token]] + k, len(flat) - 1)])
    return out, np.bincount(np.searchsorted(breaks, s), n, len(units)).astype(np.int64)


def _with(docs: DataFrame, drop: set[str], column: str, kind: DataType) -> tuple[list[str], StructType]:
    keep = [f.name for f in docs.schema.fields if f.name not in drop]
    return keep, docs.select(*keep).schema.add(column, kind)


def encode(docs: DataFrame, pieces: Pieces, text_col: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` and the piece ids of each whole text, as the model's own encoder gives them. Null and empty texts have none.

    A column of ``docs`` with the new one's name is replaced; repeated rows stay; an empty table gives no rows. A long text
    takes memory for its own letters and ids, and its words are matched in parts.
    """
    keep, schema = _with(docs, {out}, out, ArrayType(IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(pieces)  # one for each task: a worker that lives on keeps nothing
        for batch in batches:
            for part in slices(batch, text_col, _SLICE_BYTES):
                ids, counts = encoder.encode([t or "" for t in part.column(text_col).to_pylist()])
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in keep), list_array(ids, counts, pa.int32())], names=[*keep, out])

    return docs.select(*keep).mapInArrow(run, schema)


class Decoder:
    """Texts of piece ids: control pieces stand for nothing, bytes that aren't UTF-8 become U+FFFD, one space at the front goes if the model adds one."""

    def __init__(self, pieces: Pieces):
        self.table = [b"" if k in pieces.special else t.replace(SPACE, " ").encode() for k, t in enumerate(pieces.text)]
        for b, k in pieces.byte_id.items():
            self.table[k] = bytes([b])
        self.front = 1 if pieces.prefix else 0

    def texts(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """The texts of all ids in a row, and how many each text has."""
        out, at = [], 0
        part = self.table.__getitem__
        for n in counts.tolist():
            body = b"".join(map(part, ids[at : at + n].tolist()))
            at += n
            out.append(body[self.front if body[:1] == b" " else 0 :].decode("utf-8", "replace"))
        return out


def round_trip(docs: DataFrame, pieces: Pieces, text_col: str = "text", out: str = "ids", same: str = "round_trip") -> DataFrame:
    """``docs`` without the text, the piece ids of each whole text, and whether they decode to it; one pass, so the texts go to Python once.

    Null and empty texts have no ids and come back as an empty text. Columns of ``docs`` with the new ones' names are replaced.
    Repeated rows each have their ids; an empty table gives no rows; a long text is encoded in whole, unit by unit.
    """
    keep, schema = _with(docs, {text_col, out, same}, out, ArrayType(IntegerType()))
    schema = schema.add(same, BooleanType())
    source = docs.select(*keep, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = Encoder(pieces), Decoder(pieces)
        for batch in batches:
            for part in slices(batch, text_col, _SLICE_BYTES):
                texts = [t or "" for t in part.column(text_col).to_pylist()]
                ids, counts = encoder.encode(texts)
                whole = [a == b for a, b in zip(texts, decoder.texts(ids, counts), strict=True)]
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in keep), list_array(ids, counts, pa.int32()), pa.array(whole, pa.bool_())], names=[*keep, out, same])

    return source.mapInArrow(run, schema)


def _id_slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Consecutive row ranges with at most _SLICE_IDS ids each (one row at least)."""
    ends, at = batch.column(column).offsets.to_numpy(), 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + _SLICE_IDS, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def decode(docs: DataFrame, pieces: Pieces, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``docs`` and the text that each list of ids stands for; a null list is an empty text. A column with the new one's name is replaced."""
    keep, schema = _with(docs, {out}, out, StringType())
    texts_of = Decoder(pieces).texts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _id_slices(batch, ids_col):
                column = part.column(ids_col)
                counts = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in keep), pa.array(texts_of(column.flatten().to_numpy(zero_copy_only=False), counts), pa.string())], names=[*keep, out])

    return docs.select(*keep).mapInArrow(run, schema)

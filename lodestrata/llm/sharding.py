"""Sharding by a histogram sort on (hash of the text, id, row number).

Every splitter has a target, its share of all bytes. Probes cut each unresolved bracket of a column's range into equal bins;
one aggregation counts the exact bytes in the bins of all brackets. A splitter is set at the probe next to its target when
that is within tolerance, else its bracket narrows to the bin with the target. Between two hashes no group of equal texts is
cut. Where one text alone is wider than the tolerance, the same search goes on over its ids, and where rows are the same in
id, too, over their numbers. The rows then move once.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame, functions as F

from .columns import spare
from .storage import cut

LAW = "bytes"
ROW_BYTES = 16
TOLERANCE = 0.02
ROWS_PER_PART = 200_000
_HASH_BITS = 60
_BINS_BITS = 16
_LEAST = -(1 << 63)
#: The columns that are searched one after another: text hash, whether the id is missing, id, and number of the row.
_LEVELS = ("h", "no_id", "id", "n")


def row_size(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) and a fixed overhead."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long")


def text_hash(text: Column) -> Column:
    """60 bits of the text's MD5; null counts as empty."""
    return F.conv(F.substring(F.md5(F.coalesce(text, F.lit("")).cast("binary")), 1, _HASH_BITS // 4), 16, 10).cast("long")


def _settle(edges: list[tuple[int, int]], targets: list[int], slack: int) -> tuple[dict[int, int], dict[int, list[int]]]:
    """Targets that have an edge within slack (target to edge value), and the rest by the number of the bin they are in."""
    done, open_ = {}, {}
    at = 0
    for t in sorted(targets):
        while at + 1 < len(edges) and edges[at + 1][1] <= t:
            at += 1
        value, below = min(edges[at : at + 2], key=lambda e: (abs(e[1] - t), e[0]))
        if abs(below - t) <= slack:
            done[t] = value
        else:
            open_.setdefault(at, []).append(t)
    return done, open_


def _unsigned(x: int) -> int:
    """A long's place in its order, from 0."""
    return x - _LEAST


def splitters(keys: DataFrame, shards: int, tolerance: float = TOLERANCE) -> list[tuple[int, ...]]:
    """The shards - 1 boundaries of ``keys`` (h, no_id, id, n, size), each the first values of a row's key; a row on a boundary goes above it."""
    total = keys.agg(F.sum("size")).first()[0] or 0
    targets = [total * j // shards for j in range(1, shards)]
    slack = int(total * tolerance) // shards
    found: dict[int, tuple[int, ...]] = {}
    open_: dict[tuple[int, ...], tuple[int, list[int]]] = {(): (0, targets)} if total and targets else {}
    for level in range(len(_LEVELS)):
        if open_:
            done, open_ = _search(keys, level, open_, slack)
            found |= done
    return [found[t] for t in targets] if total else []


def _search(keys: DataFrame, level: int, open_: dict, slack: int) -> tuple[dict[int, tuple[int, ...]], dict]:
    """Boundaries in column ``level`` of the rows that begin with the keys of ``open_`` (first values: bytes below them, targets); single values that stay open."""
    spark, name, prefix = keys.sparkSession, _LEVELS[level], list(_LEVELS[:level])
    place = F.col(name).bitwiseXOR(F.lit(_LEAST))
    rows = keys.withColumn("at", place)
    if level:
        table = spark.createDataFrame(list(open_), ", ".join(f"{c} long" for c in prefix))
        rows = cut(rows.join(F.broadcast(table), prefix))
    ends = rows.groupBy(*prefix).agg(F.min(name).alias("low"), F.max(name).alias("high")).collect()
    brackets = []  # first values, first place, width in bits, bytes below, targets
    for r in ends:
        low, high = _unsigned(r["low"]), _unsigned(r["high"])
        wide = (low ^ high).bit_length()
        brackets.append((tuple(r[c] for c in prefix), low >> wide << wide, wide, *open_[tuple(r[c] for c in prefix)]))
    found, single, whole = {}, {}, level == 0
    while brackets:
        bits = max(4, _BINS_BITS - len(brackets).bit_length())
        steps = [(first, low, wide, max(0, wide - bits)) for first, low, wide, _, _ in brackets]
        signed = lambda x: x - (1 << 64) if x >> 63 else x
        table = spark.createDataFrame([(*first, signed(low >> wide), wide, shift) for first, low, wide, shift in steps], ", ".join([*(f"{c} long" for c in prefix), "top long", "wide int", "shift int"]))
        if whole:  # the first round of all rows has one bracket
            (first, low, wide, shift), whole = steps[0], False
            hit = rows.withColumns({"top": F.lit(signed(low >> wide)).cast("long"), "shift": F.lit(shift)})
        else:
            widths = sorted({wide for _, _, wide, _ in steps})
            each = rows.withColumn("wide", F.explode(F.array(*map(F.lit, widths)))) if len(widths) > 1 else rows.withColumn("wide", F.lit(widths[0]))
            hit = each.withColumn("top", F.when(F.col("wide") > 63, 0).otherwise(F.expr("shiftrightunsigned(at, wide)"))).join(F.broadcast(table), [*prefix, "wide", "top"])
        bins = defaultdict(list)
        for r in hit.groupBy(*prefix, "top", F.expr("shiftrightunsigned(at, shift)").alias("bin")).agg(F.sum("size").alias("size")).collect():
            bins[tuple(r[c] for c in prefix), r["top"]].append((r["bin"] % (1 << 64), r["size"]))
        narrower = []
        for (first, low, wide, below, ts), (_, _, _, shift) in zip(brackets, steps, strict=True):
            edges = [(low, below)]
            for bin_, size in sorted(bins[first, signed(low >> wide)]):
                if edges[-1][0] != bin_ << shift:
                    edges.append((bin_ << shift, edges[-1][1]))
                edges.append(((bin_ + 1) << shift, edges[-1][1] + size))
            last = not shift and level + 1 == len(_LEVELS)  # between single rows the nearest boundary is the one
            done, rest = _settle(edges, ts, 1 << 62 if last else slack)
            found |= {t: (*first, at + _LEAST) for t, at in done.items()}
            for k, left in rest.items():
                if shift:
                    narrower.append((first, edges[k][0], shift, edges[k][1], left))
                else:
                    single[*first, edges[k][0] + _LEAST] = (edges[k][1], left)
        brackets = narrower
    return found, single


def _above(key: list[Column], bounds: list[tuple[int, ...]]) -> Column:
    """How many boundaries are at or below a key: a binary search in a constant array."""
    if not bounds:
        return F.lit(0)
    struct = lambda values: F.struct(*[v.alias(c) for c, v in zip(_LEVELS, values, strict=True)])
    whole = lambda b: [F.lit(min(x, (1 << 63) - 1)).cast("long") for x in (*b, *[_LEAST] * (len(_LEVELS) - len(b)))]
    table = F.array(*[struct(whole(b)) for b in bounds])
    steps = [1 << k for k in reversed(range(len(bounds).bit_length()))]
    # try_element_at: null beyond the end, and null is not at or below
    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda at, s: F.when(F.coalesce(F.try_element_at(table, at + s) <= struct(key), F.lit(False)), at + s).otherwise(at))


def assign(docs: DataFrame, shards: int, tolerance: float = TOLERANCE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the text, and size, law, shard and slot; see shard. Columns of ``docs`` with these names are replaced."""
    placed, text_key = _placed(docs, shards, tolerance, id_col, text_col)
    return placed.drop(text_key)


def _hash_name(docs: DataFrame) -> str:
    """A name for the hash that no column of ``docs`` has, nor the output."""
    return spare(docs, "text_hash")[0]


def _placed(docs: DataFrame, shards: int, tolerance: float, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    """The rows of assign with the hash of their texts, and that column's name.

    The rows are numbered and stored without their texts, and everything comes from the stored rows, so that rows that are
    the same in all columns can be parted and keep their numbers.
    """
    docs = docs.drop("size", "law", "shard", "slot")
    hash_name = _hash_name(docs)
    own = [c for c in docs.columns if c != text_col]
    h, no_id, id_, n = names = spare(docs, "h", "no_id", "id", "n")
    rows = docs.select(
        *own, row_size(F.col(text_col)).alias("size"), text_hash(F.col(text_col)).alias(h), F.col(id_col).isNull().cast("long").alias(no_id),
        F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias(id_), F.monotonically_increasing_id().alias(n),
    )
    rows = cut(rows)
    bounds = splitters(rows.select(*[F.col(c).alias(level) for c, level in zip(names, _LEVELS, strict=True)], "size"), shards, tolerance)
    parts = max(1, math.ceil(rows.count() / shards / ROWS_PER_PART))
    part, before, at = spare(rows, "part", "before", "at")
    placed = rows.withColumns({"law": F.lit(LAW), "shard": _above([F.col(c) for c in names], bounds).cast("int"), part: F.pmod(F.xxhash64(n), F.lit(parts)).cast("int")})
    counts = placed.groupBy("shard", part).agg(F.count("*").alias(before))
    offsets = counts.selectExpr("shard", part, f"sum({before}) over (partition by shard order by {part}) - {before} as {before}")
    numbered = placed.selectExpr("*", f"row_number() over (partition by shard, {part} order by {', '.join(names)}) - 1 as {at}")
    out = numbered.join(F.broadcast(offsets) if parts == 1 else offsets, ["shard", part])
    return out.select(*own, "size", "law", "shard", (F.col(before) + F.col(at)).cast("long").alias("slot"), F.col(h).alias(hash_name)), hash_name


def shard(docs: DataFrame, shards: int, tolerance: float = TOLERANCE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` and size, law, shard and slot. Columns of ``docs`` with these names are replaced.

    Shards have equal bytes, to within the tolerance (a part of a shard) and the one row at each end. Equal texts share a
    shard unless they alone are wider than the tolerance at a boundary; then they are parted by id (null ids last), and rows
    that are the same in id, too, by the order in which they are read. Slots run from 0 without gaps. Null texts are empty;
    an empty table gives no rows; a text of any length is one row.
    """
    # Rows that are the same in text and id have one text, whichever row it is taken from.
    h, id_, gone = spare(docs, "h", "id", "gone")
    placed, text_key = _placed(docs.withColumn(gone, F.col(text_col).isNull()), shards, tolerance, id_col, text_col)
    texts = docs.where(F.col(text_col).isNotNull()).select(text_hash(F.col(text_col)).alias(h), F.col(id_col).alias(id_), text_col).dropDuplicates([h, id_])
    found = placed.join(texts, (placed[text_key] == texts[h]) & placed[id_col].eqNullSafe(texts[id_]), "left")
    text = F.when(~F.col(gone), F.col(text_col)).alias(text_col)
    new = ("size", "law", "shard", "slot")
    return found.select(*[text if c == text_col else F.col(c) for c in docs.columns if c not in new], *new)

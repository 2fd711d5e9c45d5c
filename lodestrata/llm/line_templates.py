"""Line dedup by a log-template tree of fixed depth.

A line goes down the tree by its number of tokens and its leading tokens, where a token with a digit is a variable. The
rest of the line is cut into at most FIELDS runs of tokens by position. In a leaf, a field value that enough documents have
is constant and any other is variable: the line's template is its leaf with its constant fields. A template of enough
documents recurs, and its lines are dropped everywhere but in the document with the smallest id. A line of leading tokens
only is a template by itself. A line of LONG tokens or more also recurs where two different texts have it word for word;
copies of a text count once and are treated alike, so that they stay copies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .columns import row_digest, spare
from .storage import stored
from .tokens import DIGIT, U64, Words, combine, list_array, mix, ordered_sums, slices

MIN_DOCS = 3
MIN_TOKENS = 2
LONG = 50
LONG_TEXTS = 2
LEADING = 2
FIELDS = 8

_VARIABLE = U64(0x5BD1E9955BD1E995)


def line_keys(words: Words, min_tokens: int = MIN_TOKENS) -> tuple[np.ndarray, ...]:
    """For each line of at least ``min_tokens`` tokens: its text, number in the text, leaf, field values, number of fields, hash of all tokens, number of tokens.

    Lines without a field need a token that is no variable.
    """
    s, e, own = words.lines()
    a, b = np.searchsorted(words.starts, s), np.searchsorted(words.starts, e)
    digits = np.zeros(len(words.data) + 1, np.int64)
    np.cumsum(DIGIT[words.data], out=digits[1:])
    variable = digits[words.ends] > digits[words.starts]
    variables = np.concatenate(([0], np.cumsum(variable)))
    long = (b - a >= min_tokens) & ((b - a > LEADING) | (variables[b] - variables[a] < b - a))
    s, a, b, own = s[long], a[long], b[long], own[long]
    breaks = np.flatnonzero(words.data == 0x0A)
    number = np.searchsorted(breaks, s) - np.searchsorted(breaks, words.offsets[own])
    token = np.where(variable, _VARIABLE, words.hashes)
    n = b - a
    # A line that is shorter than the leading tokens has one, which is its leaf.
    lead = np.concatenate((combine(token, LEADING), token[-(LEADING - 1) :]))[: len(token)]
    leaf = mix(np.where(n < LEADING, token[a], lead[a]) ^ mix(n.astype(U64)))
    rest = np.maximum(n - LEADING, 0)
    fields = np.minimum(rest, FIELDS)
    row = np.repeat(np.arange(len(n)), fields)
    k = np.arange(len(row)) - np.repeat(np.cumsum(fields) - fields, fields)
    start = a[row] + LEADING + k * rest[row] // fields[row]
    end = a[row] + LEADING + (k + 1) * rest[row] // fields[row]
    value = mix(ordered_sums(token, start, end) ^ mix(leaf[row] + k.astype(U64)))
    return own, number, leaf, value, fields, ordered_sums(words.hashes, a, b), n


def _first_in_text(own: np.ndarray, h: np.ndarray) -> np.ndarray:
    """True for the first of equal (own, h)."""
    key = mix(h ^ mix(own.astype(U64)))
    out = np.zeros(len(key), bool)
    out[np.unique(key, return_index=True)[1]] = True
    return out


def recurring(docs: DataFrame, min_docs: int = MIN_DOCS, id_col: str = "doc_id", text_col: str = "text", min_tokens: int = MIN_TOKENS) -> DataFrame:
    """(key, number, drop): the lines whose template recurs, or that recur word for word; a row for each of the two.

    key is a 128-bit digest of id and text; drop is false in the first document: the one with the smallest id, null ids last,
    and of equal ids the one with the smallest digest.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                own, number, leaf, value, fields, same, n = line_keys(Words(part.column("text"), lower=False), min_tokens)
                at = pa.array(own)
                out = [part.column("key").take(at), part.column("id").take(at), pa.array(number.astype(np.int32))]
                once = _first_in_text(np.repeat(own, fields), value)
                out += [pa.array(leaf.view(np.int64)), pa.array(_first_in_text(own, leaf))]
                out += [list_array(value.view(np.int64), fields, pa.int64()), list_array(once, fields, pa.bool_())]
                out += [part.column("node").take(at), pa.array(same.view(np.int64), mask=n < LONG)]
                yield pa.RecordBatch.from_arrays(out, names=["key", "id", "number", "leaf", "once", "fields", "firsts", "node", "same"])

    source = docs.select(row_digest(id_col, text_col).alias("key"), F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    source = source.withColumn("node", F.unhex(F.md5(F.col("text").cast("binary"))))
    lines = stored(source.mapInArrow(run, "key binary, id long, number int, leaf long, once boolean, fields array<long>, firsts array<boolean>, node binary, same long"))

    # Lines that are the same up to their variables in leading and digit tokens are folded before anything meets by leaf or value.
    lines = lines.withColumn("line", F.xxhash64("leaf", "fields"))
    shapes = lines.groupBy("line").agg(
        F.min("leaf").alias("leaf"), F.first("fields").alias("fields"), F.count_if("once").alias("texts"), F.array(*[F.count_if(F.get("firsts", F.lit(k))) for k in range(FIELDS)]).alias("ns")
    )
    shapes = stored(shapes)
    leaves = shapes.groupBy("leaf").agg(F.sum("texts").alias("n")).where(F.col("n") >= min_docs).select("leaf")
    live = shapes.join(leaves, "leaf")
    values = live.select(F.explode(F.arrays_zip("fields", F.slice("ns", F.lit(1), F.size("fields")).alias("n"))).alias("f")).groupBy(F.col("f.fields").alias("value")).agg(F.sum("f.n").alias("n"))
    constant = values.where(F.col("n") >= min_docs).select("value", F.lit(True).alias("constant"))
    marked = live.select("line", "leaf", F.size("fields").alias("size"), F.explode_outer("fields").alias("value")).join(constant, "value", "left")
    template = marked.groupBy("line", "leaf", "size").agg(
        F.count("constant").alias("constants"), F.bit_xor(F.when(F.col("constant"), F.xxhash64("value")).otherwise(0)).alias("mask")
    )
    template = template.where("2 * constants >= size").select("line", F.xxhash64("leaf", "constants", "mask").alias("template"))
    by_template = lines.select("key", "id", "number", "line").join(template, "line").select("key", "id", "number", F.col("key").alias("doc"), "template", F.lit(min_docs).alias("least"))
    by_words = lines.where("same is not null").select("key", "id", "number", F.col("node").alias("doc"), F.col("same").alias("template"), F.lit(min(LONG_TEXTS, min_docs)).alias("least"))
    found = stored(by_template.unionByName(by_words))
    per_text = found.groupBy("template", "least", "doc").agg(F.min("id").alias("id"))
    # Stored, so that nothing but the join stands on the lines of one template, which it can then split.
    shared = stored(per_text.groupBy("template", "least").agg(F.count("*").alias("n"), F.min(F.struct(F.col("id").isNull(), "id", "doc")).alias("first")).where(F.col("n") >= F.col("least")))
    return found.join(shared, ["template", "least"]).select("key", "number", (F.col("doc") != F.col("first.doc")).alias("drop"))


def deduplicate(docs: DataFrame, min_docs: int = MIN_DOCS, id_col: str = "doc_id", text_col: str = "text", min_tokens: int = MIN_TOKENS) -> DataFrame:
    """``docs`` with the recurring lines taken out of the text, and n_lines, n_template_lines and dropped_lines.

    dropped_lines has the numbers, from 0, of the lines that went. Documents are never dropped: one that loses all its
    lines keeps its row with an empty text. Null text stays null with no lines. Rows that are the same in id and text count
    as one document; a line stays in the document with the smallest id, null ids last, and of equal ids with the smallest digest of
    id and text. Lines of fewer than ``min_tokens`` tokens stay. A long text has a row for each line; an empty table gives no
    rows. Columns of ``docs`` with the three names are replaced, and other names never clash.
    """
    found = recurring(docs, min_docs, id_col, text_col, min_tokens).groupBy("key").agg(
        F.size(F.collect_set("number")).alias("n"), F.sort_array(F.collect_set(F.when(F.col("drop"), F.col("number")))).alias("drop")
    )
    docs = docs.drop("n_lines", "n_template_lines", "dropped_lines")
    key, n, drop, lines = spare(docs, "key", "n", "drop", "lines")
    joined = docs.withColumn(key, row_digest(id_col, text_col)).join(found.withColumnsRenamed({"key": key, "n": n, "drop": drop}), key, "left").withColumn(lines, F.split(F.col(text_col), "\n", -1))
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), drop)
    kept = F.array_join(F.transform(left, lambda i: F.get(F.col(lines), i)), "\n")
    names = [F.when(F.size(drop) > 0, kept).otherwise(F.col(text_col)).alias(text_col) if c == text_col else F.col(c) for c in docs.columns]
    return joined.select(
        *names,
        F.when(F.col(text_col).isNull(), 0).otherwise(F.size(lines)).alias("n_lines"),
        F.coalesce(n, F.lit(0)).alias("n_template_lines"),
        F.coalesce(drop, F.array().cast("array<int>")).alias("dropped_lines"),
    )

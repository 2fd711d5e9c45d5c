"""A bigram language model by deleted interpolation, learned and applied over all texts.

p(v | u) = l2 * c(uv) / c(u) + l1 * c(v) / N + l0 / (V + 1), where the weights depend on how often the context u occurs
(by powers of two) and are learned by expectation-maximisation on documents whose counts are deleted from the others'.

Texts are gathered into blocks of bounded size. Each block asks for the counts of its distinct n-grams, sorted and cut by
ranges of their hash; each range is added up over all blocks, and the counts go back to the block in the same order. So an
n-gram crosses the network once for each block that has it, however often it occurs. A block has a row only for the ranges
that it has n-grams in, so there are never more rows than distinct n-grams of blocks, which grow as the corpus does; lists
take half the bytes of a row for each n-gram, as neither the block nor the place is repeated.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .storage import stored
from .tokens import U64, Words, combine, list_array, slices

FOLDS = 7
HELD_OUT_FOLD = 2
DELETED = 16
BLOCK_BYTES = 2 << 20
RANGE_BYTES = 8 << 20
ANSWER = 1 << 17
STEPS = 8
ROUNDS = 60
_START, _END = U64(0x5851F42D4C957F2D), U64(0x14057B7EF767814F)
_NONE = 1 << 20
_PART_BYTES = 1 << 18
_BLOCK = "block long, em boolean, bytes long, ids array<long>, folds array<int>, texts array<string>"
_ASK = "range int, block long, em boolean, words binary, word_n array<long>, pairs binary, pair_n array<long>"
_TOLD = "range int, block long, em boolean, words array<long>, pairs array<long>, types long, tokens long, kept_tokens long"


class Stream:
    """The tokens of some texts: their words and one end each, and the distinct words and pairs."""

    def __init__(self, texts: pa.Array):
        words = Words(texts)
        self.lengths = words.counts + 1
        self.stops = np.cumsum(self.lengths)
        self.starts = self.stops - self.lengths
        token = np.full(self.lengths.sum(), _END)
        inner = np.ones(len(token), bool)
        inner[self.stops - 1] = False
        token[inner] = words.hashes
        del words, inner
        self.words, self.word = _distinct(token)
        context = np.empty_like(token)
        context[1:] = token[:-1]
        context[self.starts] = _START
        self.pairs, self.pair = _distinct(pair_hash(context, token))

    def spread(self, values: np.ndarray) -> np.ndarray:
        """A value of each text for each of its tokens."""
        return np.repeat(values, self.lengths)

    def add_up(self, values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, self.starts) if len(values) else np.zeros(0)


def pair_hash(context: np.ndarray, token: np.ndarray) -> np.ndarray:
    return combine(np.stack([context, token]), 2)[0]


def _distinct(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values in order, and each value's place among them."""
    keys, at = np.unique(h, return_inverse=True)
    return keys, at.astype(np.int32)


def blocks(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows of about BLOCK_BYTES of whole texts; em: the block's training texts are the deleted ones."""
    id_ = F.col(id_col)
    fold = (F.crc32(F.coalesce(id_.cast("string"), F.lit("")).cast("binary")) % FOLDS).cast("int")
    em = (fold != HELD_OUT_FOLD) & (F.pmod(F.xxhash64(id_.cast("string"), F.lit("deleted")), F.lit(DELETED)) == 0)
    source = docs.select(id_.cast("long").alias("id"), fold.alias("fold"), em.alias("em"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bool, list[pa.RecordBatch]] = {False: [], True: []}
        size = {False: 0, True: 0}
        number = itertools.count(TaskContext.get().partitionId() << 32)

        def flush(em: bool) -> pa.RecordBatch:
            rows = pa.Table.from_batches(held[em])
            lists = [pa.ListArray.from_arrays([0, len(rows)], rows.column(c).combine_chunks()) for c in ("id", "fold", "text")]
            row = [pa.array([next(number)]), pa.array([em]), pa.array([size[em]]), *lists]
            held[em], size[em] = [], 0
            return pa.RecordBatch.from_arrays(row, names=["block", "em", "bytes", "ids", "folds", "texts"])

        for batch in batches:
            for part in slices(batch, "text", _PART_BYTES):
                for em in (False, True):
                    own = part.filter(pc.equal(part.column("em"), em))
                    if own.num_rows:
                        held[em].append(own)
                        size[em] += pc.sum(pc.binary_length(own.column("text"))).as_py()
                        if size[em] >= BLOCK_BYTES:
                            yield flush(em)
        for em in (False, True):
            if held[em]:
                yield flush(em)

    return source.mapInArrow(run, _BLOCK)


def _texts(column: pa.Array | pa.ChunkedArray, row: int = 0) -> pa.Array:
    """The list in one row of a list column, without a copy."""
    return column[row].values


def _range_of(keys: np.ndarray, ranges: int) -> np.ndarray:
    """The number of the range of hashes that each key is in."""
    return (((keys >> U64(32)) * U64(ranges)) >> U64(32)).astype(np.int64)


def _packed(keys: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Sorted hashes in lists of these sizes: the steps from each to the next, first bytes first, so that the high zero bytes take no room."""
    ends = np.cumsum(sizes)
    steps = np.diff(keys, prepend=keys[:1])
    first = (ends - sizes)[sizes > 0]
    steps[first] = keys[first]
    planes = steps.view(np.uint8).reshape(-1, 8)
    return pa.array([planes[a:b].T.tobytes() for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True)], pa.binary())


def _unpacked(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All hashes of packed lists in a row, and the length of each list."""
    lists = [np.cumsum(np.ascontiguousarray(np.frombuffer(v.as_buffer(), np.uint8).reshape(8, -1).T).view(U64).ravel(), dtype=U64) for v in column]
    return np.concatenate([*lists, np.zeros(0, U64)]), np.array([len(x) for x in lists], np.int64)


def ask(rows: DataFrame, ranges: int) -> DataFrame:
    """For each block and range of hashes that it has any in: its words and pairs, sorted, and how often training texts have them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                s = Stream(_texts(batch.column("texts"), k))
                train = s.spread(_texts(batch.column("folds"), k).to_numpy() != HELD_OUT_FOLD).astype(np.float32)
                word_at, pair_at = _range_of(s.words, ranges), _range_of(s.pairs, ranges)
                some = np.union1d(word_at, pair_at)
                lists = []
                for keys, at, where in ((s.words, s.word, word_at), (s.pairs, s.pair, pair_at)):
                    sizes = np.bincount(np.searchsorted(some, where), minlength=len(some))
                    lists += [_packed(keys, sizes), list_array(np.bincount(at, train, len(keys)).astype(np.int64), sizes, pa.int64())]
                del s, train
                same = pa.array([k] * len(some), pa.int32())
                out = [pa.array(some.astype(np.int32)), batch.column("block").take(same), batch.column("em").take(same), *lists]
                out = pa.RecordBatch.from_arrays(out, names=["range", "block", "em", "words", "word_n", "pairs", "pair_n"])
                step = max(1, ANSWER * len(some) // max(1, len(pair_at)))
                for i in range(0, len(some), step):
                    yield out.slice(i, step)

    return rows.mapInArrow(run, _ASK)


def _flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All values of a list column in a row, and the length of each list."""
    lists = column.combine_chunks()
    lists = lists if isinstance(lists, pa.Array) else pa.concat_arrays(lists.chunks)
    return lists.flatten().to_numpy(zero_copy_only=False), np.diff(lists.offsets.to_numpy())


def _tell(group: pa.Table) -> pa.Table:
    """One range of hashes: the sum of all blocks for each block's n-grams, and for deleted blocks also that of the others (em).

    One more row, without a block, has the range's number of types and tokens.
    """
    em = np.array(group.column("em").to_pylist(), bool)
    rows = np.concatenate((np.arange(len(em)), np.flatnonzero(em), [-1]))
    kind = np.concatenate((np.zeros(len(em), bool), np.ones(em.sum(), bool), [False]))
    lists, stats = [], {}
    for name, n in (("words", "word_n"), ("pairs", "pair_n")):
        keys, sizes = _unpacked(group.column(name))
        count, _ = _flat(group.column(n))
        of = np.repeat(em, sizes)
        unique, at = np.unique(keys, return_inverse=True)
        full = np.bincount(at, count, len(unique)).astype(np.int64)
        kept = np.bincount(at, np.where(of, 0, count), len(unique)).astype(np.int64)
        lists.append(list_array(np.concatenate((full[at], kept[at[of]])), np.concatenate((sizes, sizes[em], [0])), pa.int64()))
        if name == "words":
            stats = {"types": int((full > 0).sum()), "tokens": int(full.sum()), "kept_tokens": int(kept.sum())}
    block = [*group.column("block").to_pylist(), None]
    data = [pa.array([group.column("range")[0].as_py()] * len(rows), pa.int32()), pa.array([block[r] for r in rows], pa.int64()), pa.array(kind), *lists]
    data += [pa.array([None] * (len(rows) - 1) + [v], pa.int64()) for v in stats.values()]
    return pa.Table.from_arrays(data, names=["range", "block", "em", "words", "pairs", *stats])


def _counts(s: Stream, told: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each token its count, its context's and their pair's."""
    told = told.sort_by("range")
    word, pair = _flat(told.column("words"))[0], _flat(told.column("pairs"))[0]
    token = word[s.word]
    context = np.empty(len(token), np.int64)
    context[1:] = token[:-1]
    context[s.starts] = word[np.searchsorted(s.words, _END)]  # as many starts as ends
    return token, context, pair[s.pair]


def context_class(count: np.ndarray) -> np.ndarray:
    """0 for a context never seen, else 1 + floor(log2(count))."""
    return np.where(count > 0, 1 + np.floor(np.log2(np.maximum(count, 1))), 0).astype(np.int64)


def learn_weights(table: np.ndarray, uniform: float) -> np.ndarray:
    """Mixture weights (class, [pair, word, uniform]) by expectation-maximisation.

    ``table`` has rows (class, pair step, word step, n): the logarithms of the two estimates in STEPS-ths, _NONE for zero. A
    class without rows takes the weights of the class below it; class 0 has no pair estimate.
    """
    weights = np.full((65, 3), 1 / 3)
    weights[0] = [0, 0.5, 0.5]
    for k in range(65):
        rows = table[table[:, 0] == k]
        if not len(rows):
            weights[k] = weights[k - 1] if k > 1 else weights[k]
            continue
        p = np.stack([*(np.where(c == _NONE, 0, np.exp(-c / STEPS)) for c in (rows[:, 1], rows[:, 2])), np.full(len(rows), uniform)], axis=1)
        for _ in range(ROUNDS):
            part = p * weights[k]
            part *= (rows[:, 3] / np.maximum(part.sum(axis=1), 1e-300))[:, None]
            mass = part.sum(axis=0) + [float(k > 0), 1.0, 1.0]  # no estimate goes to nothing
            weights[k] = mass / mass.sum()
    return weights


def _quantised(p: np.ndarray) -> np.ndarray:
    return np.where(p > 0, np.round(-np.log(np.maximum(p, 1e-300)) * STEPS), _NONE).astype(np.int64)


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row and whole text; a null text is empty.

    Learns from texts whose crc32(id as text) mod FOLDS isn't HELD_OUT_FOLD. Scores are log10 probabilities; base_score has
    add-one unigrams. Repeated rows count as often as they occur. An empty table gives no rows; extra columns are ignored,
    whatever their names; a text longer than a block is a block of its own.
    """
    rows = stored(blocks(docs, id_col, text_col))
    ranges = max(1, math.ceil((rows.agg(F.sum("bytes")).first()[0] or 0) / RANGE_BYTES))
    told = stored(ask(rows, ranges).groupBy("range").applyInArrow(_tell, _TOLD))
    total = told.where("block is null").agg(F.sum("types").alias("v"), F.sum("tokens").alias("n"), F.sum("kept_tokens").alias("kept")).first()
    types, tokens, kept = (int(x or 0) for x in total)
    told = told.where("block is not null").select("range", "block", "em", "words", "pairs")

    def estimates(s: Stream, answer: pa.Table, n: int) -> tuple[np.ndarray, ...]:
        token, context, pair = _counts(s, answer)
        return token, context, pair / np.maximum(context, 1), token / max(n, 1)

    def deleted(left: pa.Table, right: pa.Table) -> pa.Table:
        s = Stream(_texts(left.column("texts")))
        _, context, p2, p1 = estimates(s, right, kept)
        key = np.stack([context_class(context), _quantised(p2), _quantised(p1)], axis=1)
        unique, n = np.unique(key, axis=0, return_counts=True)
        return pa.Table.from_arrays([*(pa.array(unique[:, k]) for k in range(3)), pa.array(n)], names=["class", "pair", "word", "n"])

    # Rows by class and step of a logarithm: bounded by the grid, whatever the corpus.
    em_rows, em_told = rows.where("em"), told.where("em")
    seen = em_rows.groupBy("block").cogroup(em_told.groupBy("block")).applyInArrow(deleted, "class long, pair long, word long, n long")
    table = seen.groupBy("class", "pair", "word").agg(F.sum("n").alias("n")).toPandas().sort_values(["class", "pair", "word"])
    weights = learn_weights(table.to_numpy(np.int64).reshape(-1, 4), 1 / (types + 1))

    def apply(left: pa.Table, right: pa.Table) -> pa.Table:
        s = Stream(_texts(left.column("texts")))
        token, context, p2, p1 = estimates(s, right, tokens)
        w = weights[context_class(context)]
        p = w[:, 0] * p2 + w[:, 1] * p1 + w[:, 2] / (types + 1)
        base = np.log10((token + 1) / (tokens + types + 1))
        out = [_texts(left.column("ids")), pa.array(_texts(left.column("folds")).to_numpy() == HELD_OUT_FOLD)]
        out += [pa.array(s.lengths.astype(np.int64)), pa.array(s.add_up((token > 0).astype(float)).astype(np.int64)), pa.array(np.full(len(s.lengths), tokens))]
        out += [pa.array(s.add_up(base)), pa.array(s.add_up(np.log10(p)))]
        return pa.Table.from_arrays(out, names=["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    schema = "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return rows.groupBy("block").cogroup(told.where("not em").groupBy("block")).applyInArrow(apply, schema).withColumnRenamed("id", id_col)

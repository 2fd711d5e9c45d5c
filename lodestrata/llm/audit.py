"""What filters do to each other: exact Shapley shares and step counts of every order, from one table of coalitions.

Each document has a mask of the filters that it fails. All else follows from how many documents of a part a coalition of
filters removes: there are 2 ** n coalitions, so one aggregation by part and mask is all that is ever read of the documents.
A filter's share is the solution of the weighted least squares that fit the coalitions' values by sums of shares, under the
constraint that all shares add up to the value of the whole. The normal equations don't depend on the values, so they are
solved once, in rationals; the shares are then whole-number combinations of the values, divided by n!.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, functions as F

from .storage import stored

FILTERS = "ABCDE"
MIN_WORDS = 100
LEAST_DISTINCT = 80
MOST_CAPITALS = 10
SYMBOLS = r"[#$%&*|]"
_WORD = r"[^\x20\x09-\x0D]+"


def shares(n: int) -> list[list[int]]:
    """For each of n filters, what each of the 2 ** n coalitions' values counts in n! times its share.

    The kernel weight of a coalition of s filters is (n - 1) / (C(n, s) * s * (n - s)); the whole is the constraint. Each row of
    the system is the normal equation of one filter, with a multiplier for the constraint, and one right side for each coalition.
    """
    whole = (1 << n) - 1
    rows = [[Fraction(0)] * (n + 1 + whole + 1) for _ in range(n + 1)]
    for s in range(1, whole):
        size = s.bit_count()
        weight = Fraction(n - 1, math.comb(n, size) * size * (n - size))
        members = [i for i in range(n) if s >> i & 1]
        for i in members:
            for j in members:
                rows[i][j] += weight
            rows[i][n + 1 + s] += weight
    for i in range(n):
        rows[i][n] = rows[n][i] = Fraction(1)
    rows[n][n + 1 + whole] = Fraction(1)
    for k in range(n + 1):
        pivot = next(r for r in range(k, n + 1) if rows[r][k])
        rows[k], rows[pivot] = rows[pivot], rows[k]
        rows[k] = [x / rows[k][k] for x in rows[k]]
        for r in range(n + 1):
            if r != k and rows[r][k]:
                rows[r] = [x - rows[r][k] * y for x, y in zip(rows[r], rows[k], strict=True)]
    return [[int(x * math.factorial(n)) for x in row[n + 1 :]] for row in rows[:n]]


def text_failures(text: Column) -> dict[str, Column]:
    """The filters that look at one text only; a null text is empty, and an empty one fails A."""
    text = F.coalesce(text, F.lit(""))
    words = F.regexp_extract_all(text, F.lit(_WORD), F.lit(0))
    return {
        "A": F.size(words) < MIN_WORDS,
        "B": F.size(F.array_distinct(words)) * 100 < F.size(words) * LEAST_DISTINCT,
        "C": F.length(F.regexp_replace(text, "[^A-Z]+", "")) * 100 > F.length(text) * MOST_CAPITALS,
        "D": text.rlike(SYMBOLS),
    }


def failures(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(part, mask, good, toxic, docs): how many documents of a part fail just the filters in mask (bit k: the k-th of FILTERS).

    A document fails E if a document with a smaller id has the same text, in whatever part; null ids come last and are not
    smaller than each other; equal ids aren't either, so repeated rows fail together or not at all. It is good or toxic if any
    row of ``labels`` (id, quality, toxic) says so, null ids never. A null part is the empty string, a null text the empty text.
    """
    id_ = F.col(id_col).cast("long")
    text = F.coalesce(F.col(text_col), F.lit(""))
    mask = sum((F.when(fails, 1 << k).otherwise(0) for k, fails in enumerate(text_failures(text).values())), F.lit(0))
    # Rows without an id have no label, so they may go anywhere: to where their text sends them.
    same = F.unhex(F.sha2(text.cast("binary"), 256))
    rows = docs.select(id_.alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), mask.alias("mask"), same.alias("same"))
    rows = rows.withColumn("salt", F.when(F.col("id").isNull(), F.xxhash64("same")).otherwise(0))
    marks = labels.groupBy(F.col(id_col).cast("long").alias("id")).agg(F.max(F.col("quality").eqNullSafe(1)).alias("good"), F.max(F.col("toxic").eqNullSafe(1)).alias("toxic"))
    marked = rows.join(marks.withColumn("salt", F.lit(0).cast("long")), ["id", "salt"], "left")
    # Copies are folded to a row for each part and mark before they meet by text.
    keys = ["same", "part", "mask", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic")]
    each = marked.groupBy("id", "salt", *keys).agg(F.count("*").alias("n"))
    folded = each.groupBy("same", "part", "mask", "good", "toxic").agg(F.sum("n").alias("n"), F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "n")).alias("first"))
    folded = stored(folded)
    least = folded.groupBy("same").agg(F.min(F.struct("first.no_id", "first.id")).alias("least"))
    met = folded.join(least, "same")
    own = F.when(F.struct("first.no_id", "first.id").eqNullSafe(F.col("least")), F.col("first.n")).otherwise(0)
    split = F.explode(F.array(F.struct(F.lit(0).alias("bit"), own.alias("n")), F.struct(F.lit(1 << FILTERS.index("E")).alias("bit"), (F.col("n") - own).alias("n"))))
    out = met.select("part", "mask", "good", "toxic", split.alias("s")).where("s.n > 0")
    return out.groupBy("part", (F.col("mask") + F.col("s.bit")).alias("mask"), "good", "toxic").agg(F.sum("s.n").alias("docs"))


def audit(failed: DataFrame, names: Sequence[str] = tuple(FILTERS)) -> DataFrame:
    """A row for each part of ``failed`` (part, mask, good, toxic, docs), order of the filters, and step: what the step's filter does there.

    kept: documents left after the step; removed: by it; redundant: fail its filter, but went before; unique_fails: fail no
    other filter; good_lost and toxic_lost: of those removed; shapley: removed, added up over all orders. Extra columns are
    ignored, repeated rows add up, and an empty table gives no rows. ``names`` has the filters by bit, six at most.
    """
    n = len(names)
    if not 2 <= n <= 6:
        raise ValueError("an audit takes two to six filters")
    counts = {"v": F.col("docs"), "g": F.when(F.col("good"), F.col("docs")).otherwise(0), "t": F.when(F.col("toxic"), F.col("docs")).otherwise(0)}
    removed = lambda what, s: F.sum(F.when(F.col("mask").bitwiseAND(s) != 0, what).otherwise(0))
    values = failed.groupBy("part").agg(F.sum("docs").alias("total"), *[F.array(*[removed(c, s) for s in range(1 << n)]).alias(k) for k, c in counts.items()])
    weights = [F.array(*map(F.lit, row)) for row in shares(n)]
    dot = lambda w: F.aggregate(F.zip_with("v", w, lambda x, y: x * y), F.lit(0).cast("long"), lambda a, x: a + x)
    values = values.withColumn("shares", F.array(*map(dot, weights)))
    # All orders and steps are one array of n * n! small rows, the same for each part.
    letter = {name: k for k, name in enumerate(names)}
    orders = F.array(*[F.struct(F.lit("".join(p)).alias("filter_order"), F.array(*[F.lit(letter[x]) for x in p]).alias("bits")) for p in itertools.permutations(names)])
    steps = values.withColumn("o", F.explode(orders)).select("*", F.posexplode("o.bits").alias("at", "bit"))
    before = F.aggregate(F.slice("o.bits", F.lit(1), F.col("at")), F.lit(0), lambda a, b: a + F.call_function("shiftleft", F.lit(1), b))
    steps = steps.withColumn("before", before).withColumn("own", F.call_function("shiftleft", F.lit(1), F.col("bit")))
    gone = lambda c, s: F.get(F.col(c), s)
    after = F.col("before") + F.col("own")
    taken = lambda c: gone(c, after) - gone(c, F.col("before"))
    return steps.select(
        "part", F.col("o.filter_order").alias("filter_order"), (F.col("at") + 1).alias("step"),
        (F.col("total") - gone("v", after)).alias("kept"), taken("v").alias("removed"), (gone("v", F.col("own")) - taken("v")).alias("redundant"),
        (gone("v", F.lit((1 << n) - 1)) - gone("v", F.lit((1 << n) - 1) - F.col("own"))).alias("unique_fails"),
        taken("g").alias("good_lost"), taken("t").alias("toxic_lost"), F.get("shares", F.col("bit")).alias("shapley"),
    )

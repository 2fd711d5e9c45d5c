"""Mixing sources to target weights: blocks of equal numbers of words, apportioned by highest quotients.

Each source's texts lie in a seeded order in shards, and each shard is cut into blocks of equal size. The blocks that the
targets ask for are given to the sources one after another to the highest quotient target / (2 * k + 1), where k is what the source
has so far, and each source's to its shards by their words in the same way. A shard takes all its blocks as often as its
quota allows, and of the rest those whose seeded hash is smallest.

Giving blocks out one by one would take as many steps as blocks. Only few quotients are in doubt: rounding target / d for a
divisor d a little too small or too large gives too many or too few blocks by no more than there are parties. Those between
are ranked, and the highest fill up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .columns import spare
from .storage import stored

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
BLOCK_WORDS = 16
#: A shard has a 4096th of all words, but no fewer and no more than these, and no more rows than that.
SHARD_WORDS = (1 << 14, 1 << 22)
SHARD_ROWS = 10_000
SEED = 11
_WORD = r"[^\x20\x09-\x0D]+"
_SPANS = "array<struct<first:long,last:long,times:int>>"


def n_words(text: Column) -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def numbered(sources: DataFrame) -> DataFrame:
    """``sources`` (source, ...) and place, from 0 by code point with null last: a range sort, so that any number of sources fits."""
    placed = stored(sources.repartitionByRange(F.col("source").asc_nulls_last()).sortWithinPartitions(F.col("source").asc_nulls_last()).withColumn("at", F.monotonically_increasing_id()))
    placed = placed.withColumn("part", F.shiftright("at", 33))
    starts, below = [], 0
    for part, size in sorted((r["part"], r["count"]) for r in placed.groupBy("part").count().collect()):
        starts.append((part, below))
        below += size
    offsets = sources.sparkSession.createDataFrame(starts, "part long, before long")
    return placed.join(F.broadcast(offsets), "part").withColumn("place", F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).drop("at", "part", "before")


def targets(sources: DataFrame, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``sources`` (source_size, weight, ...) and target: shares by weight of ``share`` times all words, none above ``most`` times the source.

    What a full source leaves is dealt again to the others by weight, until none is above; a round costs two sums.
    """
    cap = F.col("source_size") * most
    each, full = None, F.lit(False)
    while True:
        sums = sources.agg(F.sum("source_size").alias("all"), F.sum(F.when(full, cap)).alias("given"), F.sum(F.when(~full, F.col("weight"))).alias("weights"), F.count_if(full).alias("n")).first()
        if each is not None and sums["n"] == n_full or not sums["weights"]:
            break
        n_full = sums["n"]
        each = (share * sums["all"] - (sums["given"] or 0)) / sums["weights"]
        full = F.col("weight") * each >= cap
    return sources.withColumn("target", F.when(full, cap.cast("double")).otherwise(F.col("weight") * F.lit(each or 0.0)))


def apportioned(parties: DataFrame, group: list[str], by: list[str]) -> DataFrame:
    """``parties`` (group, by, votes, cap, seats) and quota: each group's ``seats`` by highest quotients votes / (2 * k + 1), ties to the first by ``by``.

    Keys are never null. A party stops at its cap. Those that would go over it are filled and the rest is apportioned again without them, which
    can only fill more; seats that no party has room for are not given.
    """
    own = spare(parties, "full", "votes_left", "seats_left", "n", "low", "high", "k", "place", "extra", "quota")
    full, votes, seats, n, low, high, k, place, extra, quota = own
    rows = stored(parties.withColumn(full, F.col("cap") <= 0))
    while True:
        left = lambda what: F.when(~F.col(full), what).otherwise(0)
        sums = rows.groupBy(*group).agg(
            F.sum(left(F.col("votes"))).alias(votes), (F.max("seats") - F.sum(F.when(F.col(full), F.col("cap")).otherwise(0))).alias(seats), F.count_if(~F.col(full)).alias(n)
        )
        met = rows.join(sums, group)
        open_ = ~F.col(full) & (F.col("votes") > 0) & (F.col(seats) > 0)
        # Seats at a divisor so large that no more than enough are given, and at one so small that enough are.
        rounded = lambda divisor: F.floor(F.col("votes") / divisor + 0.5).cast("long")
        slack = F.col(n) / 2 + 1
        sure = F.when(F.col(seats) > slack, rounded(F.col(votes) / (F.col(seats) - slack))).otherwise(0)
        met = met.withColumn(low, F.when(open_, F.greatest(sure, F.lit(0))).otherwise(0)).withColumn(high, F.when(open_, rounded(F.col(votes) / (F.col(seats) + slack)) + 1).otherwise(0))
        met = stored(met)
        doubtful = met.where(F.col(high) > F.col(low)).select(*group, *by, "votes", F.explode(F.sequence(F.col(low), F.col(high) - 1)).alias(k))
        taken = met.groupBy(*group).agg((F.max(seats) - F.sum(low)).alias(place))
        order = ", ".join(["votes / (2 * {0} + 1) desc".format(k), *by, k])
        ranked = doubtful.withColumn(extra, F.expr(f"row_number() over (partition by {', '.join(group)} order by {order})")).join(taken, group).where(F.col(extra) <= F.col(place))
        won = ranked.groupBy(*group, *by).agg(F.count("*").alias(extra))
        got = met.join(won, [*group, *by], "left").withColumn(extra, F.coalesce(extra, F.lit(0)))
        got = stored(got.withColumn(quota, F.when(F.col(full), F.greatest("cap", F.lit(0))).otherwise(F.col(low) + F.col(extra))))
        over = ~F.col(full) & (F.col(quota) > F.col("cap"))
        if got.where(over).isEmpty():
            return got.select(*parties.columns, F.col(quota).cast("long").alias("quota"))
        rows = got.withColumn(full, F.col(full) | (F.col(quota) >= F.col("cap"))).select(*parties.columns, full)


def _key(seed: int, shard: list[Column], block: Column) -> Column:
    """A block's place in the seeded order of its shard: a hash, and its number, so that none are equal."""
    return F.struct(F.xxhash64(F.lit(seed), *shard, block).alias("hash"), block.alias("block"))


def plan(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST, block_words: int = BLOCK_WORDS, shard_words: tuple[int, int] = SHARD_WORDS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> DataFrame:
    """(id, key, source, size, source_size, target, taken, spans) for every row of ``docs``; key is a digest of the text.

    spans has the ranges of words that the mix takes, from word first to before word last, and how often; taken adds them up. No word
    is taken more than ``most`` times. Sources by code point, null last, have the ``weights`` in turn. A null text has no
    words; repeated rows are numbered and each have a row; a long text spans many blocks; an empty table
    gives no rows; extra columns are ignored. A source's words differ from its target by about a block and what rounding its last
    shard's blocks makes.
    """
    text = F.col(text_col)
    key = F.md5(F.coalesce(text, F.lit("")).cast("binary"))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.unhex(key).alias("key"), F.col(source_col).cast("string").alias("source"), n_words(text).alias("size"))
    # Rows that are the same are folded and numbered, so that they can lie in many shards and runs agree.
    rows = stored(rows.groupBy("id", "key", "source", "size").agg(F.count("*").alias("copies")))
    sources = numbered(rows.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"), F.sum("copies").alias("n_rows")))
    sources = sources.withColumn("weight", F.get(F.array(*map(F.lit, weights)), (F.col("place") % len(weights)).cast("int")))
    sources = stored(targets(sources, share, most))
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    wide = max(shard_words[0], min(shard_words[1], total >> 12))
    n_shards = F.ceil(F.greatest(F.col("source_size") / wide, F.col("n_rows") / SHARD_ROWS))
    of = sources.select(F.col("place").alias("number"), F.col("source").alias("of_source"), "source_size", "target", n_shards.alias("n_shards"))
    # A source's texts are dealt to its shards, and lie in them, by a seeded hash; a text is not cut between shards.
    dealt = rows.join(of, rows["source"].eqNullSafe(of["of_source"])).drop("of_source")
    dealt = dealt.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    dealt = dealt.withColumn("hash", F.xxhash64(F.lit(seed), "id", "key", "copy")).withColumn("shard", F.pmod("hash", "n_shards"))
    laid = dealt.withColumn("stop", F.expr("sum(size) over (partition by number, shard order by hash, id, key, copy rows unbounded preceding)"))
    laid = stored(laid.drop("n_shards", "hash", "copy", "copies"))
    shards = laid.groupBy("number", "shard").agg(F.sum("size").alias("votes"), F.first("target").alias("target")).withColumn("n_blocks", F.ceil(F.col("votes") / block_words))
    shards = stored(shards.where("votes > 0").withColumn("cap", F.col("n_blocks") * most))
    by_source = shards.groupBy("number").agg(F.first("target").alias("votes"), F.sum("cap").alias("cap")).withColumn("whole", F.lit(0))
    seats = round((by_source.agg(F.sum("votes")).first()[0] or 0) / block_words)
    quotas = apportioned(by_source.withColumn("seats", F.lit(seats).cast("long")), ["whole"], ["number"]).select("number", F.col("quota").alias("seats"))
    each = apportioned(shards.drop("target").join(quotas, "number"), ["number"], ["shard"])
    shard = [F.col("number"), F.col("shard")]
    keys = F.array_sort(F.transform(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1), lambda b: _key(seed, shard, b)))
    each = each.withColumn("passes", F.floor(F.col("quota") / F.col("n_blocks")).cast("int")).withColumn("last_key", F.get(keys, (F.col("quota") % F.col("n_blocks") - 1).cast("int")))
    each = stored(each.select("number", "shard", F.col("votes").alias("wide"), "n_blocks", "passes", F.when(F.col("quota") % F.col("n_blocks") > 0, F.col("last_key")).alias("last_key")))
    met = laid.join(each, ["number", "shard"], "left")
    start = F.col("stop") - F.col("size")
    block = lambda p: F.expr(f"(({p} + 1) * n_blocks - 1) div wide")

    def span(b: Column) -> Column:
        times = F.col("passes") + F.when(_key(seed, shard, b) <= F.col("last_key"), 1).otherwise(0)
        low, high = F.call_function("div", b * F.col("wide"), F.col("n_blocks")), F.call_function("div", (b + 1) * F.col("wide"), F.col("n_blocks"))
        return F.struct((F.greatest(low, start) - start).alias("first"), (F.least(high, F.col("stop")) - start).alias("last"), times.cast("int").alias("times"))

    spans = F.filter(F.transform(F.sequence(block("(stop - size)"), block("(stop - 1)")), span), lambda s: s["times"] > 0)
    out = met.withColumn("spans", F.when(F.col("size") > 0, spans).otherwise(F.array().cast(_SPANS)))
    taken = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + (s["last"] - s["first"]) * s["times"])
    return out.select(F.col("id").alias(id_col), "key", F.col("source").alias(source_col), "size", "source_size", "target", taken.alias("taken"), "spans")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **kwargs) -> DataFrame:
    """The mixed text: a row (id, source, text, first, times) for each run of words that is taken; its words are joined by one space.

    Rows that are the same in id, source and text have the same words, so any of them gives the text.
    """
    planned = plan(docs, id_col=id_col, text_col=text_col, source_col=source_col, **kwargs)
    spans = planned.where(F.size("spans") > 0).select(F.col(id_col).alias("id"), F.col("key").alias("of"), F.col(source_col).alias("source"), "spans")
    texts = docs.select(F.col(id_col).cast("long").alias("own"), F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))).alias("key"), F.col(text_col).alias("text")).dropDuplicates(["own", "key"])
    met = spans.join(texts, spans["id"].eqNullSafe(texts["own"]) & (spans["of"] == texts["key"]))
    words = F.regexp_extract_all("text", F.lit(_WORD), F.lit(0))
    body = lambda s: F.array_join(F.slice("words", (s["first"] + 1).cast("int"), (s["last"] - s["first"]).cast("int")), " ")
    runs = F.transform("spans", lambda s: F.struct(body(s).alias("text"), s["first"].alias("first"), s["times"].alias("times")))
    cut = met.select("id", "source", "spans", words.alias("words")).select("id", "source", F.explode(runs).alias("run"))
    return cut.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "run.text", "run.first", "run.times")

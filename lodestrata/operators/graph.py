"""Graphs as edge tables: closures, depths, chains and an order to destroy in.

Loops are over rounds; each round is one distributed join, and a checkpoint cuts its lineage.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.folders import shared_folder
from .order import numbered


def _kept(df: DataFrame) -> DataFrame:
    """``df`` stored in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def closure(start: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, stage): every node that edges (src, dst) lead to from ``start`` (node), with the round that reached it first.

    Cycles end where nothing new is reached. Each round stores what it reached first, and nothing is stored twice.
    """
    rounds = [_kept(start.select("node", F.lit(0).alias("stage")).distinct())]
    while True:
        reached = rounds[-1].join(edges, F.col("node") == F.col("src")).select(F.col("dst").alias("node")).distinct()
        seen = reduce(DataFrame.unionByName, rounds)
        frontier = _kept(reached.join(seen, "node", "left_anti").withColumn("stage", F.lit(len(rounds))))
        if frontier.isEmpty():
            return seen
        rounds.append(frontier)


def reverse(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))


def depths(nodes: DataFrame, parent: str = "parent", key: str = "id") -> DataFrame:
    """(id, depth): 0 for nodes whose parent isn't among the nodes. Pointers double each round, so a chain of n takes log2(n).

    Nodes on a cycle, and below one, have no depth and are left out.
    """
    up = nodes.select(F.col(key).alias("id"), F.col(parent).alias("up"))
    known = up.select(F.col("id").alias("up"), F.lit(True).alias("known"))
    state = _kept(up.join(known, "up", "left").select("id", F.when(F.col("known"), F.col("up")).alias("up"), F.when(F.col("known"), 1).otherwise(0).alias("depth")))
    # Nodes that have arrived are done; only the others are joined, so that a root isn't asked by its whole tree again.
    done, state = [state.where("up is null")], state.where("up is not null")
    left, n = None, state.count()
    while n and n != left:
        settled = reduce(DataFrame.unionByName, done)
        above = state.unionByName(settled).select(F.col("id").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more"))
        moved = _kept(state.join(above, "up", "left").select("id", F.col("next").alias("up"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")))
        done.append(moved.where("up is null"))
        state = moved.where("up is not null")
        left, n = n, state.count()
    return reduce(DataFrame.unionByName, done).select(F.col("id").alias(key), "depth")


def chain_ends(pointers: DataFrame) -> DataFrame:
    """(src, end): where following ``pointers`` (src, dst, one for each src) ends; chains that run into a cycle are left out."""
    state = _kept(pointers.select("src", "dst"))
    left, n = None, -1
    while n != left:
        onward = state.select(F.col("src").alias("dst"), F.col("dst").alias("next"))
        state = _kept(state.join(onward, "dst", "left").select("src", F.coalesce("next", "dst").alias("dst"), F.col("next").isNotNull().alias("open")))
        left, n = n, state.where("open").count()
        if n == 0:
            break
    return state.where("not open").select("src", F.col("dst").alias("end"))


def in_degrees(edges: DataFrame) -> DataFrame:
    """(node, n): how many different nodes lead to each, itself left out."""
    return edges.where("src <> dst").distinct().groupBy(F.col("dst").alias("node")).agg(F.count("*").alias("n"))


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Edges (u, v), v < u, with each node's neighbours tied to the least of them: those above it, or it and those below it."""
    both = edges.union(edges.select("v", "u")) if large else edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    tied = both.join(least, "u").where("v > u" if large else "v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return (tied if large else tied.union(least.select("u", "m"))).where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): for each node of ``edges`` (src, dst) the least node that it is connected to, itself included.

    Large-star and small-star steps by turns until every component is a star: no step gathers a component.
    """
    nodes = edges.select(F.col("src").alias("node")).union(edges.select("dst")).distinct()
    pairs = _kept(edges.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).where("u <> v").distinct())
    while True:
        ends = pairs.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(pairs.select("v", F.lit(0), F.lit(1)))
        if ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or up = 1 and down = 1").isEmpty():
            break
        pairs = _kept(_star(_star(pairs, True), False))
    return nodes.join(pairs.select(F.col("u").alias("node"), F.col("v").alias("root")), "node", "left").select("node", F.coalesce("root", "node").alias("component"))


def _chains(nodes: DataFrame, live: DataFrame) -> DataFrame:
    """(own, up, most, stack, open) of nodes that one node alone leads to: the nearest one above that none or several lead to, and what
    the way from there does to a key (``_along``). Ways double each round. Open ones hang on a cycle."""
    one = live.groupBy(F.col("dst").alias("own")).agg(F.count("*").alias("n"), F.max("src").alias("up")).where("n = 1")
    state = one.join(nodes, "own").select("own", "up", F.col("at").alias("most"), F.array("at").alias("stack"))
    ended = lambda s: s.join(s.select(F.col("own").alias("up"), F.lit(True).alias("open")), "up", "left").withColumn("open", F.coalesce("open", F.lit(False)))
    state = _kept(ended(state))
    done, state = [state.where("not open")], state.where("open")
    left, n, columns = None, state.count(), ("own", "up", "most", "stack", "open")
    while n and n != left:
        # Those that have arrived are looked up by the others, but not joined again themselves.
        above = reduce(DataFrame.unionByName, [*done, state]).select(F.col("own").alias("up"), F.col("up").alias("next"), F.col("most").alias("peak"), F.col("stack").alias("before"), F.col("open").alias("onward"))
        moved = _kept(state.drop("open").join(above, "up").select("own", F.col("next").alias("up"), F.greatest("most", "peak").alias("top"), _along("before", "most", "stack").alias("way"), F.col("onward").alias("open")).toDF(*columns))
        done.append(moved.where("not open"))
        state = moved.where("open")
        left, n = n, state.count()
    return reduce(DataFrame.unionByName, [*done, state])


def _along(key: str, most: str, stack: str | Column) -> Column:
    """A key after a way: what is beyond all of the way stays, then follows what the way has put on top."""
    return F.concat(F.filter(key, lambda x: x > F.col(most)), stack)


def _keyed(groups: DataFrame, edges: DataFrame) -> DataFrame:
    """(grp, node, left_over, key): the key sorts nodes as destroy_keys says.

    A node waits until the last one that leads to it has gone. By then all earlier nodes are gone but those which wait for a node
    beyond the current one. So its key is that of the last node that leads to it, cut down to what is beyond the node, and the
    node itself: a list of falling places, in which a list comes right before what continues it.

    Keys move forward in rounds: a node that several lead to takes the greatest key of all when the last has one. Runs of nodes
    that one node alone leads to are one step, which takes a logarithm of their length to find. So there are as many rounds as a
    path has nodes that several lead to, and no part of the graph is ever in one task.
    """
    keys = [c for c in ("grp",) if c in groups.columns]
    nodes = _kept(groups.select(F.struct(*keys, "node").alias("own"), F.struct(F.col("ord").cast("long").alias("ord"), "node").alias("at")))
    there = groups.select(*keys, "node")
    live = edges.where("src <> dst").join(there.withColumnRenamed("node", "src"), [*keys, "src"], "left_semi").join(there.withColumnRenamed("node", "dst"), [*keys, "dst"], "left_semi").distinct()
    live = _kept(live.select(F.struct(*keys, F.col("src").alias("node")).alias("src"), F.struct(*keys, F.col("dst").alias("node")).alias("dst")))
    chains = _kept(_chains(nodes, live))
    several = live.groupBy(F.col("dst").alias("own")).agg(F.count("*").alias("waiting")).where("waiting > 1")
    free = nodes.join(live.select(F.col("dst").alias("own")), "own", "left_anti")
    frontier = _kept(free.select("own", F.array("at").alias("key")))
    pending = _kept(several.join(nodes, "own").select("own", "at", "waiting", F.lit(None).cast(dict(frontier.dtypes)["key"]).alias("best")))
    into = live.join(pending.select(F.col("own").alias("dst")), "dst", "left_semi").join(chains.select(F.col("own").alias("src"), "up", "most", "stack"), "src", "left")
    into = _kept(into.select("dst", F.coalesce("up", "src").alias("own"), "most", "stack"))
    done = [frontier]
    while not pending.isEmpty():
        told = into.join(frontier, "own").select("dst", F.when(F.col("most").isNull(), F.col("key")).otherwise(_along("key", "most", "stack")).alias("key"))
        told = told.groupBy(F.col("dst").alias("own")).agg(F.count("*").alias("n"), F.max("key").alias("last"))
        state = _kept(pending.join(told, "own", "left").select("own", "at", (F.col("waiting") - F.coalesce("n", F.lit(0))).alias("waiting"), F.greatest("best", "last").alias("best")))
        frontier = state.where("waiting = 0").select("own", _along("best", "at", F.array("at")).alias("key"))
        if frontier.isEmpty():
            break
        done.append(frontier)
        pending = state.where("waiting > 0")
    settled = reduce(DataFrame.unionByName, done)
    below = chains.where("not open").join(settled.withColumnRenamed("own", "up"), "up").select("own", _along("key", "most", "stack").alias("key"))
    rows = nodes.join(settled.unionByName(below), "own", "left")
    return rows.select("own.*", F.col("key").isNull().cast("int").alias("left_over"), F.coalesce("key", F.array("at")).alias("key"))


def destroy_keys(groups: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, left_over, reach, place): sort keys of an order in which the earliest node goes first that no remaining one leads to.

    ``groups`` has (node, ord), each node once, ``edges`` (src, dst); both may have grp, which then comes out, too. reach is the
    highest ord so far, place a running number from 0 among the nodes that go at this reach. left_over is 1 for what a cycle
    holds back; that follows by ord. Where ords are equal the lesser node is the earlier. Edges from a node to itself, to or from
    a node that isn't there, and repeated ones don't count.
    """
    keys = [c for c in ("grp",) if c in groups.columns]
    rows = _keyed(groups, edges).withColumn("reach", F.col("key")[0]["ord"])
    return numbered(rows, [*keys, "left_over", "reach"], "key", name="place").select("node", "left_over", "reach", (F.col("place") - 1).alias("place"), *keys)


def destroy_order(groups: DataFrame, edges: DataFrame) -> DataFrame:
    """(grp, node, rank): the order of destroy_keys within each group of ``groups`` (grp, node, ord); ``edges`` has (grp, src, dst).

    If a cycle is left, its nodes and all that depend on them follow in their own order.
    """
    return numbered(_keyed(groups, edges), ["grp"], "left_over", "key", name="rank").select("grp", "node", "rank")


def first_arrival(visits: DataFrame, key: str, *order: str) -> DataFrame:
    """The first visit of each key."""
    return visits.withColumn("__n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("__n = 1").drop("__n")

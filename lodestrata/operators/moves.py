"""Moves that bring ordered siblings from an old to a new arrangement, one scope-aware step at a time.

Each group (a model's fields and fieldsets, or a menu tree) is planned on its own, groups in parallel.
"""

from __future__ import annotations

from bisect import bisect_left

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from ..sources.folders import shared_folder
from .joins import wide

ROOT = ""
SCOPE_WEIGHT = 100
BLOCK = 256
ROWS = 8192


class IllegalMove(Exception):
    """A step would leave a gap, or the steps end elsewhere."""


class _Block:
    """Some neighbours of a list: positions in order less what is to be added to each, and their keys."""

    __slots__ = ("add", "at", "keys")

    def __init__(self, add: int, at: list[int], keys: list[str]):
        self.add, self.at, self.keys = add, at, keys


class _Siblings:
    """The members of one scope by position. A shift of all from a place on changes one block and a number in each later one."""

    def __init__(self) -> None:
        self.blocks: list[_Block] = []
        self.home: dict[str, _Block] = {}

    def insert(self, key: str, position: int) -> None:
        for n, block in enumerate(self.blocks):
            if block.add + block.at[-1] >= position:
                break
        else:
            if not self.blocks:
                self.blocks.append(_Block(0, [], []))
            n, block = len(self.blocks) - 1, self.blocks[-1]
        i = bisect_left(block.at, position - block.add)
        block.at.insert(i, position - block.add)
        block.keys.insert(i, key)
        self.home[key] = block
        if len(block.at) > 2 * BLOCK:
            rest = _Block(block.add, block.at[BLOCK:], block.keys[BLOCK:])
            del block.at[BLOCK:], block.keys[BLOCK:]
            self.blocks.insert(n + 1, rest)
            self.home.update(dict.fromkeys(rest.keys, rest))

    def delete(self, key: str) -> None:
        block = self.home.pop(key)
        i = block.keys.index(key)
        del block.at[i], block.keys[i]
        if not block.at:
            self.blocks.remove(block)

    def position(self, key: str) -> int:
        block = self.home[key]
        return block.add + block.at[block.keys.index(key)]

    def shift(self, since: int, by: int) -> None:
        """Add ``by`` (1 or -1) to all positions of ``since`` or more, which keeps their order."""
        for block in self.blocks:
            if block.add + block.at[0] >= since:
                block.add += by
            elif block.add + block.at[-1] >= since:
                i = bisect_left(block.at, since - block.add)
                block.at[i:] = [x + by for x in block.at[i:]]

    def last(self) -> int:
        return max(0, self.blocks[-1].add + self.blocks[-1].at[-1]) if self.blocks else 0


class Arrangement:
    """Entities with a scope and a position in it; positions close up and open up as entities move.

    A step costs about the square root of the lists that it touches.
    """

    def __init__(self, rows: dict[str, tuple[str, int]]):
        self.scope: dict[str, str] = {}
        self.members: dict[str, dict[str, None]] = {}
        self.lists: dict[str, _Siblings] = {}
        for k, (s, p) in rows.items():
            self.put(k, s, p)

    def place(self, key: str) -> tuple[str, int]:
        return self.scope[key], self.lists[self.scope[key]].position(key)

    def places(self) -> dict[str, tuple[str, int]]:
        at = {k: block.add + p for own in self.lists.values() for block in own.blocks for p, k in zip(block.at, block.keys, strict=True)}
        return {k: (s, at[k]) for k, s in self.scope.items()}

    def last(self, scope: str) -> int:
        return self.lists[scope].last() if scope in self.lists else 0

    def shift(self, scope: str, since: int, by: int) -> None:
        if scope in self.lists:
            self.lists[scope].shift(since, by)

    def take(self, key: str) -> None:
        """Out of its list; its gap stays."""
        self.members[self.scope[key]].pop(key)
        self.lists[self.scope[key]].delete(key)

    def put(self, key: str, scope: str, position: int) -> None:
        if key in self.scope:
            self.take(key)
        self.set(key, scope, position)

    def set(self, key: str, scope: str, position: int) -> None:
        self.scope[key] = scope
        self.members.setdefault(scope, {})[key] = None
        self.lists.setdefault(scope, _Siblings()).insert(key, position)

    def append(self, key: str, scope: str) -> None:
        self.put(key, scope, self.last(scope) + 1)

    def remove(self, key: str) -> None:
        """Take ``key`` out and close its gap; what it contained goes to the end of the root, one by one."""
        scope, position = self.place(key)
        self.take(key)
        del self.scope[key]
        self.shift(scope, position, -1)
        for k in list(self.members.get(key, ())):
            self.put(k, ROOT, self.last(ROOT) + 1)

    def move(self, key: str, scope: str, position: int, strict: bool) -> None:
        """An illegal move leaves the entity out of all lists."""
        old_scope, old_position = self.place(key)
        self.take(key)
        if strict and position > self.last(scope) + 1:
            raise IllegalMove(key)
        self.shift(old_scope, old_position, -1)
        self.shift(scope, position, 1)
        self.set(key, scope, position)


def start(old: dict[str, tuple[str, int]], new: dict[str, tuple[str, int]], first: str = "") -> Arrangement:
    """Where things are once what is new has been created (at the ends, containers first) and what is gone destroyed (from the last)."""
    by_position = lambda keys, of: sorted(keys, key=lambda k: of[k][1])
    state = Arrangement({k: old[k] for k in by_position(old, old)})
    created = by_position([k for k in new if k not in old], new)
    for k in sorted(created, key=lambda k: not k.startswith(first)) if first else created:
        state.append(k, new[k][0])
    for k in reversed(by_position([k for k in old if k not in new], old)):
        state.remove(k)
    return state


def weighed_plan(old: dict[str, tuple[str, int]], new: dict[str, tuple[str, int]], first: str = "") -> list[tuple[int, str, str, int]]:
    """Steps (weight, key, scope, position) that turn ``old`` into ``new``; both map keys to (scope, position), in the catalog's order.

    Far movers go first, which takes fewer steps; if that runs into an illegal move or misses the goal, all go by position
    with the weight 0, which always arrives where positions run from 1 without gaps. Keys with the prefix ``first`` are containers.
    """
    there = start(old, new, first).places()

    def run(order: list[str], strict: bool) -> list[tuple[int, str, str, int]]:
        state = Arrangement(there)
        steps = []
        for k in order:
            if state.place(k) != tuple(new[k]):
                steps.append((weight(k) if strict else 0, k, *new[k]))
                state.move(k, *new[k], strict)
        if strict and any(v != tuple(new[k]) for k, v in state.places().items()):
            raise IllegalMove
        return steps

    def weight(k: str) -> int:
        scope, position = there[k]
        return abs(new[k][1] - position) + (SCOPE_WEIGHT if scope != new[k][0] else 0)

    try:
        return run(sorted(new, key=lambda k: -weight(k)), True)
    except IllegalMove:
        return run(sorted(new, key=lambda k: new[k][1]), False)


def plan(old: dict[str, tuple[str, int]], new: dict[str, tuple[str, int]], first: str = "") -> list[tuple[str, str, int]]:
    """The steps (key, scope, position) of a weighed plan."""
    return [step[1:] for step in weighed_plan(old, new, first)]


def replay(old: dict[str, tuple[str, int]], new: dict[str, tuple[str, int]], steps: list[tuple[str, str, int]], first: str = "") -> dict[str, tuple[str, int]]:
    """Where the entities of ``new`` are after the steps."""
    state = start(old, new, first)
    for k, scope, position in steps:
        state.move(k, scope, position, False)
    return state.places()


def _both(old: DataFrame, new: DataFrame) -> DataFrame:
    """Each key's old list, place and order (a, p, m) and its new ones (b, q, ord) in one row."""
    a = old.select("grp", "key", F.col("scope").alias("a"), F.col("position").alias("p"), F.col("ord").alias("m"))
    b = new.select("grp", "key", F.col("scope").alias("b"), F.col("position").alias("q"), "ord")
    return wide(a).join(wide(b), ["grp", "key"], "full")


def unsettled(old: DataFrame, new: DataFrame, first: str = "") -> DataFrame:
    """The groups (grp) in which something has to move: the others are as wanted once things have been created and destroyed.

    Where no list is left for another one, none that is gone held anything and no place is taken twice, what stays moves up by
    those that are gone before it, and what is new follows the last, containers first: counts over each list tell where all are.
    """
    return _unsettled(_both(old, new), first)


def _unsettled(both: DataFrame, first: str) -> DataFrame:
    both = both.withColumn("list", F.coalesce("b", "a"))
    lost, made = F.col("b").isNull(), F.col("a").isNull()
    own = Window.partitionBy("grp", "list")
    later = ~F.startswith("key", F.lit(first)) if first else F.lit(False)
    placed = both.withColumns(
        {
            "gone": F.count_if(lost).over(own.orderBy(F.col("p").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)), "all_gone": F.count_if(lost).over(own), "last": F.coalesce(F.max("p").over(own), F.lit(0)),
            "rank": F.count_if(made).over(own.orderBy(F.when(made, later), "q", "ord", "key").rowsBetween(Window.unboundedPreceding, 0)), "twice": F.count("p").over(Window.partitionBy("grp", "list", "p")) > 1,
        }
    )
    at = F.when(made, F.col("last") + F.col("rank") - F.col("all_gone")).otherwise(F.col("p") - F.col("gone"))
    stirred = placed.where(F.col("twice") | F.coalesce(F.col("a") != F.col("b"), F.lit(False)) | ~lost & (at != F.col("q"))).select("grp")
    lists = both.where("a is not null").select("grp", F.col("a").alias("key")).distinct()
    held = both.where(lost).join(wide(lists), ["grp", "key"], "left_semi").select("grp")
    return stirred.union(held).distinct()


def plan_groups(old: DataFrame, new: DataFrame, first: str = "") -> DataFrame:
    """(grp, step, key, scope, position, weight) for every group of ``old`` and ``new`` (grp, key, scope, position, ord).

    Groups in which nothing has to move are left out before any task gets them; the others come to Python many at a time.
    """
    kind = dict(new.dtypes)["grp"]
    shared_folder(old.sparkSession)
    both = _both(old, new).checkpoint()
    stirred = both.join(wide(_unsettled(both, first)), "grp", "left_semi").checkpoint()
    sets = 1 + stirred.count() // ROWS

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        sides = []
        for s, p, m in (("a", "p", "m"), ("b", "q", "ord")):
            groups: dict = {}
            for g, k, scope, place in rows[rows[s].notna()].sort_values(m, kind="stable")[["grp", "key", s, p]].itertuples(index=False):
                groups.setdefault(g, {})[k] = (scope, int(place))
            sides.append(groups)
        steps = [(g, n, *s, w) for g in {**sides[0], **sides[1]} for n, (w, *s) in enumerate(weighed_plan(sides[0].get(g, {}), sides[1].get(g, {}), first), 1)]
        return pd.DataFrame(steps, columns=["grp", "step", "key", "scope", "position", "weight"])

    dealt = stirred.withColumn("set", F.pmod(F.xxhash64("grp"), F.lit(sets)))
    return dealt.groupBy("set").applyInPandas(run, f"grp {kind}, step long, key string, scope string, position long, weight long")

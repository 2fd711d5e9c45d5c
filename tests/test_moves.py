"""Moves in lists of blocks are those in plain lists; long lists take seconds."""

from __future__ import annotations

import random
import time

import pytest

from lodestrata.operators import moves


class Plain:
    """Every step goes through the whole list."""

    def __init__(self, rows):
        self.at = {k: list(v) for k, v in rows.items()}
        self.order = {}
        for k, (s, _) in rows.items():
            self.order.setdefault(s, {})[k] = None

    def last(self, scope, but=None):
        return max([0, *(p for k, (s, p) in self.at.items() if s == scope and k != but)])

    def shift(self, scope, since, by, but):
        for k, v in self.at.items():
            if k != but and v[0] == scope and v[1] >= since:
                v[1] += by

    def put(self, key, scope, position):
        if key in self.at:
            self.order[self.at[key][0]].pop(key)
        self.at[key] = [scope, position]
        self.order.setdefault(scope, {})[key] = None

    def remove(self, key):
        scope, position = self.at.pop(key)
        self.order[scope].pop(key)
        self.shift(scope, position, -1, key)
        for k in list(self.order.get(key, ())):
            self.put(k, "", self.last("") + 1)

    def move(self, key, scope, position, strict):
        old_scope, old_position = self.at[key]
        if strict and position > self.last(scope, key) + 1:
            raise moves.IllegalMove(key)
        self.put(key, scope, position)
        self.shift(old_scope, old_position, -1, key)
        self.shift(scope, position, 1, key)


@pytest.mark.parametrize("seed", range(30))
def test_any_steps(seed, monkeypatch):
    monkeypatch.setattr(moves, "BLOCK", 1 + seed % 4)
    r = random.Random(seed)
    rows = {f"k{k}": (r.choice(["", "k1", "k2", "x"]), r.randrange(0, 12)) for k in range(40)}
    mine, plain = moves.Arrangement(rows), Plain(rows)
    for _ in range(300):
        key, scope, position = r.choice(list(plain.at)), r.choice(["", "k1", "k2", "x", "new"]), r.randrange(0, 14)
        what = r.random()
        if what < 0.1 and len(plain.at) > 5:
            mine.remove(key), plain.remove(key)
        elif what < 0.2:
            mine.append(key, scope), plain.put(key, scope, plain.last(scope) + 1)
        elif what < 0.5 and position > plain.last(scope, key) + 1:
            with pytest.raises(moves.IllegalMove):
                moves.Arrangement(mine.places()).move(key, scope, position, True)
        else:
            mine.move(key, scope, position, False), plain.move(key, scope, position, False)
        assert mine.places() == {k: tuple(v) for k, v in plain.at.items()}
        assert all(mine.last(s) == plain.last(s) for s in ("", "k1", "k2", "x", "new"))
        assert {s: list(m) for s, m in mine.members.items() if m} == {s: list(m) for s, m in plain.order.items() if m}


@pytest.mark.parametrize("seed", range(6))
def test_plans_arrive(seed):
    """Trees whose lists lose containers with children, gain new ones, and are put in another order."""
    r = random.Random(seed)

    def tree(keys):
        scope = {k: "" if r.random() < 0.5 or n < 3 else r.choice(keys[:n]) for n, k in enumerate(keys)}
        lists, out = {}, {}
        for k in r.sample(keys, len(keys)):
            lists.setdefault(scope[k], []).append(k)
        for s, own in lists.items():
            out |= {k: (s, n) for n, k in enumerate(own, 1)}
        return out

    keys = [f"e{k}" for k in range(60)]
    old, new = tree(keys[:50]), tree([k for k in keys if int(k[1:]) % 7])
    steps = moves.plan(old, new)
    assert moves.replay(old, new, steps) == new and steps


def test_long_lists():
    n = 100_000
    r = random.Random(1)
    old = {f"k{k}": ("", k) for k in range(1, n + 1)}
    order = list(old)
    for _ in range(2000):
        order.insert(r.randrange(n), order.pop(r.randrange(n)))
    new = {k: ("", p) for p, k in enumerate(order, 1)}
    state, began = moves.Arrangement(old), time.process_time()
    for k in r.sample(order, 5000):
        state.move(k, "", new[k][1], False)
    assert time.process_time() - began < 20


@pytest.mark.parametrize("seed", range(3))
def test_groups_that_are_left_out_have_no_steps(spark, seed):
    """Every group planned in plain Python: exactly those with steps go to a task, with the steps that they have alone."""
    r = random.Random(seed)
    old, new, want = [], [], {}
    for g in range(60):
        keys = [r.choice(["", "box:"]) + f"e{k}" for k in range(r.randrange(1, 9))]
        boxes = [k for k in keys if k.startswith("box:")]
        a, b, lists = {}, {}, ({}, {})
        for k in keys:
            scope = r.choice(["", *boxes]) if not k.startswith("box:") and boxes else ""
            for side, own, chance in ((a, lists[0], 0.85), (b, lists[1], 0.85)):
                if r.random() < chance:
                    s = r.choice(["", *boxes]) if r.random() < 0.1 and not k.startswith("box:") else scope
                    side[k] = s if s in side else ""
                    own.setdefault(side[k], []).append(k)
        if g % 3 == 0:
            r.shuffle(lists[1].get("", []))
        elif g % 3 == 1:  # what is new comes last, boxes first
            lists[1][""] = [k for k in lists[1].get("", []) if k in a] + sorted((k for k in lists[1].get("", []) if k not in a), key=lambda k: not k.startswith("box:"))
        sides = []
        for side, own in ((a, lists[0]), (b, lists[1])):
            sides.append({k: (s, n) for s, ks in own.items() for n, k in enumerate(ks, 1)})
        for out, side in ((old, sides[0]), (new, sides[1])):
            out += [(g, k, *side[k], n) for n, k in enumerate(side)]
        steps = moves.weighed_plan(*sides, "box:")
        if steps:
            want[g] = [(n, *s, w) for n, (w, *s) in enumerate(steps, 1)]
    schema = "grp int, key string, scope string, position int, ord int"
    a, b = spark.createDataFrame(old, schema), spark.createDataFrame(new, schema)
    got = {}
    for x in moves.plan_groups(a, b, "box:").orderBy("grp", "step").collect():
        got.setdefault(x.grp, []).append((x.step, x.key, x.scope, x.position, x.weight))
    assert got == want and 5 < len(want) < 60
    sent = {x.grp for x in moves.unsettled(a, b, "box:").collect()}
    assert set(want) <= sent and len(sent) < 60

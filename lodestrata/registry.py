"""Operators by name: resource and method names match without case, _ and -."""

from __future__ import annotations

import inspect
from collections.abc import Callable
from types import ModuleType

from .operators import graph, joins, moves, order
from .plans import content, diff, ledger, posts, render, search
from .sources import settings, sinks, snapshots

RESOURCES: dict[str, ModuleType] = {
    "joins": joins, "order": order, "graph": graph, "moves": moves, "diff": diff, "render": render, "ledger": ledger, "search": search, "content": content, "posts": posts, "snapshots": snapshots,
    "settings": settings, "sinks": sinks,
}
SUGGESTIONS = 20


def plain(name: str) -> str:
    return name.replace("_", "").replace("-", "").lower()


def methods(resource: str) -> dict[str, Callable]:
    """The public functions of a resource."""
    module = {plain(k): m for k, m in RESOURCES.items()}.get(plain(resource))
    if module is None:
        raise LookupError(f"no resource {resource}; there are: {', '.join(sorted(RESOURCES)[:SUGGESTIONS])}")
    return {k: f for k, f in vars(module).items() if inspect.isfunction(f) and f.__module__ == module.__name__ and not k.startswith("_")}


def call(resource: str, method: str, *args, **kwargs):
    """Call an operator by its names; an unknown name or a wrong number of arguments says what there is."""
    found = methods(resource)
    f = {plain(k): f for k, f in found.items()}.get(plain(method))
    if f is None:
        raise LookupError(f"no method {method} of {resource}; there are: {', '.join(sorted(found)[:SUGGESTIONS])}")
    inspect.signature(f).bind(*args, **kwargs)
    return f(*args, **kwargs)


def describe(resource: str) -> list[tuple[str, str, str]]:
    """(name, signature, first line of the text) of each method, by name."""
    return [(k, str(inspect.signature(f)), (inspect.getdoc(f) or "").split("\n")[0]) for k, f in sorted(methods(resource).items())]

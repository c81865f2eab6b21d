"""Models that a Python worker keeps between tasks."""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Callable, Hashable

#: Versions that a worker keeps; the one that was not used for longest goes first.
KEPT = 2

_held: OrderedDict[Hashable, Callable] = OrderedDict()


def held(version: Hashable, load: Callable[[], Callable]) -> Callable:
    """The model of ``version``, loaded by the first task of this worker that asks for it.

    Spark reuses its Python workers for many tasks and micro-batches, so a model is loaded about once a worker.
    """
    if version not in _held:
        while len(_held) >= KEPT:
            _held.popitem(last=False)
        _held[version] = load()
    _held.move_to_end(version)
    return _held[version]

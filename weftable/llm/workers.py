"""Memory of Python workers, which run the tasks of one operator after another."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import cache, wraps
from typing import Any

import pyarrow as pa

_kept: dict[str, dict] = {}


def kept(operator: str) -> dict:
    """What this worker keeps from one task of an operator to the next."""
    return _kept.setdefault(operator, {})


@cache
def _trim() -> Callable[[int], int]:
    return getattr(ctypes.CDLL(None), "malloc_trim", lambda _: 0)  # other C libraries have none


def give_back() -> None:
    """Returns freed memory to the system. The C library else keeps tens of MB of a batch's arrays for the worker's next ones."""
    pa.default_memory_pool().release_unused()
    _trim()(0)


def tasks_of(operator: str) -> Callable[[Callable], Callable]:
    """For functions of ``mapInPandas`` and the like: their tasks drop what the worker keeps for other operators, and leave no freed memory."""

    def around(work: Callable[[Iterator[Any]], Iterator[Any]]) -> Callable[[Iterator[Any]], Iterator[Any]]:
        @wraps(work)
        def run(parts: Iterator[Any]) -> Iterator[Any]:
            others = [k for k in _kept if k != operator]
            for other in others:
                del _kept[other]
            if others:
                give_back()
            try:
                yield from work(parts)
            finally:
                give_back()

        return run

    return around

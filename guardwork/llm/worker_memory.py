"""What a Python worker remembers between tasks, of one operator at a time.

Spark reuses its Python workers for all stages of an application.  What an operator keeps for its
next task (vocabularies, words, tables) goes when another operator starts to work there, so a
worker's memory is that of its largest operator and not the sum of all.  So do tables that several
operators use, and what Arrow keeps of freed batches.
"""

from __future__ import annotations

import gc
from collections.abc import Callable
from functools import lru_cache, wraps

import pyarrow as pa

_memories: dict[str, list] = {}
#: The memories of helpers that several operators use.
SHARED = ""
_last = SHARED


def at_work(operator: str) -> None:
    """Called where an operator starts on a partition."""
    global _last
    if operator == _last:
        return
    _last = operator
    for name, memories in _memories.items():
        if name != operator:
            for memory in memories:
                memory.cache_clear()
    gc.collect()
    pa.default_memory_pool().release_unused()


def remembered_by_all(most: int) -> Callable:
    """Remembers a helper's results until another operator is at work."""

    def keep(find: Callable) -> Callable:
        memory = lru_cache(maxsize=most)(find)
        _memories.setdefault(SHARED, []).append(memory)
        return memory

    return keep


def remembered(operator: str, most: int = 1) -> Callable:
    """Remembers a function's results for an operator, while the operator is at work."""

    def keep(find: Callable) -> Callable:
        memory = lru_cache(maxsize=most)(find)
        _memories.setdefault(operator, []).append(memory)

        @wraps(find)
        def call(*args):
            at_work(operator)
            return memory(*args)

        return call

    return keep

"""What Python workers remember between batches, and give back.

Workers serve one stage after the other. Each operator names itself before it fills a memory; when
another one takes over, all memories are emptied and the freed pages go back to the system, so that a
worker holds one operator's memory at a time.
"""

from __future__ import annotations

import ctypes
import gc

import pyarrow as pa

_remembered: list[dict] = []
_user: list[str] = [""]


def remember(memory: dict) -> dict:
    """Register a memory, to be emptied when another operator takes over."""
    _remembered.append(memory)
    return memory


def use(name: str) -> None:
    """The operator that works in this process from now on."""
    if _user[0] != name:
        _user[0] = name
        for memory in _remembered:
            memory.clear()
        release()


def release() -> None:
    """Hand freed memory back to the operating system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)

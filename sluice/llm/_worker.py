"""What a Python worker process keeps from task to task."""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Callable

import pyarrow as pa

_HELD = "sluice_worker"


def kept(key: tuple, make: Callable):
    """The object of this key, made once in each worker process. Functions are shipped to the workers by
    value, so what modules and classes hold is new in every task; this is not."""
    held = sys.modules.setdefault(_HELD, types.ModuleType(_HELD)).__dict__
    if key not in held:
        held[key] = make()
    return held[key]


def release() -> None:
    """After a task: give freed memory back. Idle workers share the executor's memory with those that work, and
    what glibc keeps of large arrays that are gone would count as theirs."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)

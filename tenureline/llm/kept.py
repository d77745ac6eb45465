"""What a Python worker keeps between its tasks.

Task code travels by value, so its module globals start anew with every task; memos of pure
functions may last as long as the worker.
"""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Callable
from typing import Any

import pyarrow as pa

_NAME = "_llm_kept_between_tasks"


def give_back() -> None:
    """Memory that Arrow and the C library hold unused goes to the system: a worker outlives its
    tasks, and those of one executor share its memory."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def kept(operator: str, key: object, make: Callable[[], Any]) -> Any:
    """The worker's object for ``key``, made on first use. Those of one operator are held at a
    time: a worker that turns to another one gives their memory back."""
    held = sys.modules.setdefault(_NAME, types.ModuleType(_NAME)).__dict__
    if held.get("operator") != operator:
        held |= {"operator": operator, "objects": {}}
        give_back()
    objects = held["objects"]
    if key not in objects:
        objects[key] = make()
    return objects[key]

"""Helpers inside Python workers."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa


def worker_held(name: str, make: Callable[[], Any]) -> Any:
    """Object that a Python worker makes once and keeps for its later tasks."""
    held = sys.modules.setdefault("_muster_worker", types.ModuleType("_muster_worker")).__dict__
    if name not in held:
        held[name] = make()
    return held[name]


def parts(texts: pa.Array, max_bytes: int = 4 << 20) -> Iterator[pa.Array]:
    """Slices of a batch with about ``max_bytes`` of text each, or one row if that row is larger."""
    if texts.nbytes <= max_bytes or len(texts) < 2:
        yield texts
        return
    half = len(texts) // 2
    for part in (texts.slice(0, half), texts.slice(half)):
        yield from parts(part, max_bytes)

"""Memory that Python workers keep between tasks."""

from __future__ import annotations

import ctypes

import pyarrow as pa


def release() -> None:
    """Give free memory back to the system; a worker that is reused would hold on to its peak."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        # only the GNU C library has it
        pass

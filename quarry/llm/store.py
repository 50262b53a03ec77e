"""What Python workers need of their surroundings: files in the shared folder, by whatever store its URI names, and memory."""

from __future__ import annotations

import ctypes
import re

import pyarrow as pa
from pyarrow import fs


def release() -> None:
    """Give memory that is free again back to the system: workers live on between stages, and share an executor's."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library


def store(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri) if ":" in uri else "file://" + uri)

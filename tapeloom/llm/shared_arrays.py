"""Arrays in the shared folder: written whole by one task, memory-mapped by all workers."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager
from urllib.parse import unquote, urlparse

import numpy as np

_MAPPED: dict[tuple[str, str], np.ndarray] = {}


def _local(uri: str) -> str | None:
    """The path of a folder that is mounted on every machine, or None for other stores."""
    parsed = urlparse(uri)
    return unquote(parsed.path) if parsed.scheme in ("", "file") else None


def write_array(uri: str, values: np.ndarray) -> None:
    """Write under another name first: a task that is tried again leaves one whole file."""
    data = np.ascontiguousarray(values).tobytes()
    if (path := _local(uri)) is not None:
        os.makedirs(os.path.dirname(path), exist_ok=True)
        part = f"{path}.{uuid.uuid4().hex}"
        with open(part, "wb") as out:
            out.write(data)
        os.replace(part, path)
        return
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    store.create_dir(os.path.dirname(path), recursive=True)
    part = f"{path}.{uuid.uuid4().hex}"
    with store.open_output_stream(part) as out:
        out.write(data)
    store.move(part, path)


def mapped_array(uri: str, dtype: str) -> np.ndarray:
    """The array, mapped into memory once per worker; stores that cannot be mapped are copied to disk first."""
    key = (uri, dtype)
    if key not in _MAPPED:
        path = _local(uri)
        if path is None:
            from pyarrow import fs

            store, place = fs.FileSystem.from_uri(uri)
            with store.open_input_stream(place) as source, tempfile.NamedTemporaryFile(delete=False) as copy:
                while block := source.read(8 << 20):
                    copy.write(block)
                path = copy.name
        empty = os.path.getsize(path) == 0
        _MAPPED[key] = np.empty(0, dtype) if empty else np.memmap(path, dtype=dtype, mode="r")
    return _MAPPED[key]


def fresh_array(uri: str, dtype: str) -> np.ndarray:
    """The array, mapped for whoever holds it: what is looked at once does not stay in a worker's memory."""
    path = _local(uri)
    if path is None:
        return mapped_array(uri, dtype)
    return np.empty(0, dtype) if os.path.getsize(path) == 0 else np.memmap(path, dtype=dtype, mode="r")


@contextmanager
def opened_array(uri: str, dtype: str):
    yield fresh_array(uri, dtype)

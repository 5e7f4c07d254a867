"""Byte files in shared storage; scratch tables come from the core package."""

from __future__ import annotations

import os
import uuid
from urllib.parse import unquote, urlparse

from ..sources.scratch import drop, scratch, shared_dir, stash

__all__ = ["drop", "local_path", "map_array", "open_bytes", "scratch", "shared_dir", "stash", "write_bytes"]

def local_path(uri: str) -> str | None:
    """The plain path of a ``file:`` URI or bare path, None for other stores."""
    parts = urlparse(uri)
    if parts.scheme in ("", "file"):
        return unquote(parts.path)
    return None


def write_bytes(uri: str, chunks) -> int:
    """Write an iterable of bytes to ``uri`` so that readers see all or nothing.

    The bytes go to a name of this attempt first and are then renamed, so a
    task that runs twice (a retry, or speculation) leaves one whole file.
    """
    attempt = f"{uri}.{uuid.uuid4().hex}.part"
    done = 0
    path = local_path(uri)
    if path is not None:
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(local_path(attempt), "wb") as out:
            for chunk in chunks:
                out.write(chunk)
                done += len(chunk)
        os.replace(local_path(attempt), path)
        return done
    from pyarrow import fs

    store, place = fs.FileSystem.from_uri(attempt)
    store.create_dir(place.rsplit("/", 1)[0], recursive=True)
    with store.open_output_stream(place) as out:
        for chunk in chunks:
            out.write(chunk)
            done += len(chunk)
    store.move(place, fs.FileSystem.from_uri(uri)[1])
    return done


def open_bytes(uri: str):
    """A binary stream over ``uri``."""
    path = local_path(uri)
    if path is not None:
        return open(path, "rb")
    from pyarrow import fs

    store, place = fs.FileSystem.from_uri(uri)
    return store.open_input_stream(place)


def map_array(uri: str, dtype):
    """A numpy view of a flat file: memory-mapped where the store is a file
    system of this machine, read whole otherwise."""
    import numpy as np

    path = local_path(uri)
    if path is not None:
        return np.memmap(path, dtype=dtype, mode="r") if os.path.getsize(path) else np.empty(0, dtype)
    with open_bytes(uri) as src:
        return np.frombuffer(src.read(), dtype=dtype)

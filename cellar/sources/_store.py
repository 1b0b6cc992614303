"""Files of a shared folder from Python processes (Spark's own readers are used everywhere else)."""

from __future__ import annotations


def open_store(path: str):
    """The ``pyarrow.fs`` file system of a path (local, ``file:`` or a URI that it knows) and the path in it."""
    from pyarrow import fs
    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path

"""Plain files in the shared folder, by URI, from the driver or an executor."""

from __future__ import annotations

import uuid


def _fs(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def make_folder(path: str) -> None:
    f, p = _fs(path)
    f.create_dir(p, recursive=True)


def publish(path: str, fill) -> None:
    """Write a file through ``fill(stream)`` under a private name, then rename.

    A task that runs twice replaces the file with equal bytes; a task that dies
    leaves only its private file.
    """
    f, p = _fs(path)
    own = f"{p}.{uuid.uuid4().hex}.tmp"
    with f.open_output_stream(own) as out:
        fill(out)
    f.move(own, p)


def load(path: str) -> bytes:
    f, p = _fs(path)
    with f.open_input_stream(p) as src:
        return src.read()


def open_random(path: str):
    """A seekable reader of one file."""
    f, p = _fs(path)
    return f.open_input_file(p)

"""Binary files in the folder that all executors share."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyarrow import fs


def _resolved(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)


def write_file(path: str, pieces) -> int:
    """Write the pieces to a file that appears whole or not at all; returns its bytes.

    A task that is tried again, or runs twice, replaces the file by the same one.
    """
    held, name = _resolved(path)
    folder, _, last = name.rpartition("/")
    held.create_dir(folder, recursive=True)
    own = f"{folder}/.{last}.{uuid.uuid4().hex}"
    size = 0
    with held.open_output_stream(own) as out:
        for piece in pieces:
            out.write(piece)
            size += len(piece)
    held.move(own, name)
    return size


def open_file(path: str) -> pa.NativeFile:
    """A file to be read at any place."""
    held, name = _resolved(path)
    return held.open_input_file(name)

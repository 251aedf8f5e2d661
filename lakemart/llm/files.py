"""Binary files in a folder that all executors reach, opened inside tasks."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyarrow import fs


def locate(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of an absolute path or URI; ``s3a`` is the name Hadoop has for ``s3``."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


@contextmanager
def new_file(path: str) -> Iterator[pa.NativeFile]:
    """A file that appears under its name when it is complete.

    A task that is run again writes the same file again; the last to finish counts.
    """
    system, target = locate(path)
    system.create_dir(target.rpartition("/")[0], recursive=True)
    draft = f"{target}.{uuid.uuid4().hex}"
    with system.open_output_stream(draft, compression=None) as out:
        yield out
    system.move(draft, target)


def open_file(path: str) -> pa.NativeFile:
    """A file to read from any place in it."""
    system, target = locate(path)
    return system.open_input_file(target)

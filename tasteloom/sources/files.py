"""Files that tasks write and read themselves, on any store Arrow can reach."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyarrow import fs


def _located(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)


def written(folder: str, name: str, parts: Iterator[bytes]) -> str:
    """Write a file under a name that no other attempt of the task uses; give its path.

    Only paths that a finished task has reported are ever read, so what a lost executor
    or a repeated attempt leaves behind is never seen.
    """
    path = f"{folder}/{uuid.uuid4().hex}-{name}"
    store, at = _located(path)
    store.create_dir(at.rpartition("/")[0], recursive=True)
    with store.open_output_stream(at, compression=None) as out:
        for part in parts:
            out.write(part)
    return path


@contextmanager
def opened(path: str):
    store, at = _located(path)
    with store.open_input_file(at) as file:
        yield file

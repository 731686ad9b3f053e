"""Whole files in the shared folder, written and read by tasks through pyarrow.fs.

A file is written under a name of its attempt and then renamed, so a retried or
speculative task leaves one complete file, never a part.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyarrow import fs


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI (a bare path is local) and the path in it."""
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


@contextmanager
def replacing(uri: str) -> Iterator:
    """An output stream whose content appears at uri when the block ends well."""
    store, path = filesystem(uri)
    store.create_dir(path.rpartition("/")[0], recursive=True)
    own = f"{path}.{uuid.uuid4().hex}.part"
    try:
        with store.open_output_stream(own) as out:
            yield out
        store.move(own, path)
    except BaseException:
        try:
            store.delete_file(own)
        except OSError:
            pass
        raise


def read_bytes(uri: str) -> bytes:
    store, path = filesystem(uri)
    with store.open_input_file(path) as f:
        return f.read()

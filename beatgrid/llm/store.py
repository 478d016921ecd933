"""Whole files in the shared folder, written and read by tasks.

The folder is any that pyarrow opens by its URI (file, hdfs, s3 and others). A file is written
under a name of its own and then renamed, and its content depends on its rows only, so a task that
runs twice does no harm.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from urllib.parse import urlparse

from pyarrow import fs


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and the path in it; Spark's names for S3 are understood."""
    if not urlparse(uri).scheme:
        return fs.LocalFileSystem(), uri
    scheme, _, rest = uri.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem(), urlparse(uri).path
    return fs.FileSystem.from_uri(f"{'s3' if scheme in ('s3a', 's3n') else scheme}:{rest}")


@contextmanager
def written(uri: str):
    """A stream to a new file, in place under its name only when all of it is written."""
    system, path = opened(uri)
    folder, _, name = path.rpartition("/")
    system.create_dir(folder, recursive=True)
    part = f"{folder}/.{name}-{uuid.uuid4().hex}"
    with system.open_output_stream(part, compression=None) as out:
        yield out
    system.move(part, path)


def read_stream(uri: str):
    system, path = opened(uri)
    return system.open_input_stream(path, compression=None)


def random_access(uri: str):
    system, path = opened(uri)
    return system.open_input_file(path)

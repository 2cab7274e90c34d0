"""Binary files that tasks write and read by themselves, under the folder all executors share.

A task writes under a name of its own and reports it in its rows; only the reports of tasks that
succeed get into the manifest, so what a lost or repeated attempt leaves behind is never read.
Any store that Arrow's file systems know will do.
"""

from __future__ import annotations

import uuid

from pyarrow import fs


def _place(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:") :]
    return fs.FileSystem.from_uri(uri)


def create(folder: str, name: str):
    """A new file's address and its open stream."""
    uri = f"{folder}/{name}-{uuid.uuid4().hex}"
    system, path = _place(uri)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return uri, system.open_output_stream(path)


def open_random(uri: str):
    """A file to read at any place: ``read_at(n, offset)``, ``size()``."""
    system, path = _place(uri)
    return system.open_input_file(path)

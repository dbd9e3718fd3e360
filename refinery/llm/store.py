"""Files that tasks write to and read from the shared checkpoint folder, by URI."""

from __future__ import annotations

import contextlib
import re
import uuid
from collections.abc import Iterator

from pyarrow import fs as pafs


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder URI as Spark prints it."""
    return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri) if ":" in uri else f"file://{uri}")


@contextlib.contextmanager
def new_file(uri: str, name: str) -> Iterator:
    """An output stream to ``uri``/``name``.  The name appears only when the
    file is whole: an attempt that dies leaves a file with another ending."""
    fs, folder = open_folder(uri)
    fs.create_dir(folder, recursive=True)
    part = f"{folder}/{name}.{uuid.uuid4().hex}.part"
    with fs.open_output_stream(part, compression=None) as out:
        yield out
    fs.move(part, f"{folder}/{name}")

"""Binary files in the shared folder, written and read by tasks."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyarrow import fs


def located(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def as_uri(path: str) -> str:
    """``file:/x`` as Hadoop writes it, in the form that pyarrow takes."""
    return "file:///" + path[5:].lstrip("/") if path.startswith("file:") else path


def write_file(uri: str, parts: Sequence[bytes]) -> None:
    """Write under a temporary name, then rename, so that a file is whole or not there.

    A second attempt of the same task writes the same bytes and replaces the file.
    """
    store, path = located(as_uri(uri))
    store.create_dir(path.rpartition("/")[0], recursive=True)
    temporary = f"{path}.{uuid.uuid4().hex}.tmp"
    with store.open_output_stream(temporary, compression=None) as out:
        for part in parts:
            out.write(part)
    try:
        store.move(temporary, path)
    except OSError:  # a store that does not rename over a file
        if store.get_file_info(path).type == fs.FileType.File:
            store.delete_file(path)
        store.move(temporary, path)


def open_file(uri: str):
    store, path = located(as_uri(uri))
    return store.open_input_file(path)


def local_path(uri: str) -> str | None:
    """The path of a file on a mounted file system, else None."""
    store, path = located(as_uri(uri))
    return path if isinstance(store, fs.LocalFileSystem) else None

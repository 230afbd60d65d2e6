"""Small files in the folders that driver and tasks share, for code in tasks, where Spark's own file systems can't be called."""

from __future__ import annotations

import re
import uuid

from pyarrow import fs


def located(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    path = re.sub(r"^file:/+", "file:///", path)
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def get(path: str) -> bytes | None:
    """A file's content; None if there is none."""
    store, at = located(path)
    if store.get_file_info(at).type != fs.FileType.File:
        return None
    with store.open_input_stream(at) as f:
        return f.read()


def put(path: str, data: bytes) -> None:
    """Write a file under a temporary name and move it into place, so that nobody reads a part of it."""
    store, at = located(path)
    folder, _, name = at.rpartition("/")
    store.create_dir(folder, recursive=True)
    own = f"{folder}/.{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(own) as f:
        f.write(data)
    store.move(own, at)


def names(folder: str, kind: fs.FileType | None = None) -> list[str]:
    """Names in a folder, sorted, hidden ones left out; empty if there is no such folder."""
    store, at = located(folder)
    found = store.get_file_info(fs.FileSelector(at, allow_not_found=True))
    return sorted(x.base_name for x in found if x.base_name[:1] not in "._" and kind in (None, x.type))


def size(path: str) -> int:
    """Bytes of a file."""
    store, at = located(path)
    return store.get_file_info(at).size


def remove(folder: str) -> None:
    """Delete a folder with what is in it, if it is there."""
    store, at = located(folder)
    if store.get_file_info(at).type == fs.FileType.Directory:
        store.delete_dir(at)

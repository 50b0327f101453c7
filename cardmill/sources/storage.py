"""Files as executors see them: any storage that Arrow knows (local, HDFS, object stores), by paths or URIs."""

from __future__ import annotations

import uuid
from pathlib import PurePosixPath

from pyarrow import fs


def located(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    if path.startswith("file:") and not path.startswith("file://"):  # Hadoop writes file:/x
        path = "file://" + path[len("file:") :]
    return fs.FileSystem.from_uri(path)


def listed(folder: str, suffix: str = "") -> list[fs.FileInfo]:
    """The files right in a folder, by path; none where it doesn't exist."""
    system, root = located(folder)
    found = system.get_file_info(fs.FileSelector(root, allow_not_found=True))
    return sorted((f for f in found if f.type == fs.FileType.File and f.path.endswith(suffix)), key=lambda f: f.path)


def deleted(folder: str) -> None:
    system, root = located(folder)
    if system.get_file_info(root).type == fs.FileType.Directory:
        system.delete_dir(root)


def removed(path: str) -> None:
    system, inside = located(path)
    system.delete_file(inside)


def replaced(path: str, data: bytes) -> None:
    """A file's content by a rename, so a reader finds the old one or the new one whole."""
    system, inside = located(path)
    system.create_dir(inside.rpartition("/")[0])
    tmp = f"{inside}.{uuid.uuid4().hex}.tmp"
    with system.open_output_stream(tmp) as out:
        out.write(data)
    system.move(tmp, inside)


def child(folder: str, *names: str) -> str:
    return "/".join([folder.rstrip("/"), *names])


def stem(path: str) -> str:
    return PurePosixPath(path).stem

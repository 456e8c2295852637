"""Small files on any store that tasks reach without a session: local or mounted disks, HDFS, S3, GCS."""

from __future__ import annotations

import re

from pyarrow import fs


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    path = re.sub(r"^file:/+", "/", path)
    return (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)


def exists(path: str) -> bool:
    store, inner = opened(path)
    return store.get_file_info(inner).type == fs.FileType.File


def listed(folder: str, prefix: str = "") -> list[str]:
    """Paths of the files in ``folder`` whose names start so; none if there is no folder."""
    store, inner = opened(folder)
    found = store.get_file_info(fs.FileSelector(inner, allow_not_found=True))
    return sorted(f"{folder.rstrip('/')}/{x.base_name}" for x in found if x.type == fs.FileType.File and x.base_name.startswith(prefix))


def read_text(path: str) -> str:
    store, inner = opened(path)
    with store.open_input_stream(inner) as file:
        return file.read().decode()


def put_text(path: str, text: str) -> None:
    """Writes a file so that it is there whole or not at all: aside first, then moved into place."""
    store, inner = opened(path)
    folder, name = inner.rsplit("/", 1)
    store.create_dir(folder, recursive=True)
    aside = f"{folder}/_writing-{name}"  # names that start so are not read as data
    with store.open_output_stream(aside) as file:
        file.write(text.encode())
    store.move(aside, inner)


def remove(path: str) -> None:
    store, inner = opened(path)
    store.delete_file(inner)

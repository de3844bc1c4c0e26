"""Binary files in the shared folder, from inside tasks; any store that pyarrow knows by its URI."""

from __future__ import annotations

import functools

from pyarrow import fs


@functools.lru_cache(maxsize=64)
def _store(root: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(root)


def _at(uri: str) -> tuple[fs.FileSystem, str]:
    folder, _, name = uri.rpartition("/")
    store, path = _store(folder)
    return store, f"{path}/{name}"


def create(uri: str):
    """A new file, open for writing; its folder is made if need be."""
    store, path = _at(uri)
    store.create_dir(path.rpartition("/")[0], recursive=True)
    return store.open_output_stream(path, compression=None)


def rename(old: str, new: str) -> None:
    store, path = _at(old)
    store.move(path, _at(new)[1])


def size(uri: str) -> int:
    store, path = _at(uri)
    return store.get_file_info(path).size


def open_at(uri: str):
    """A file, open for reads at any place."""
    store, path = _at(uri)
    return store.open_input_file(path)


@functools.lru_cache(maxsize=4)
def _kept_open(uri: str):
    return open_at(uri)


def read_range(uri: str, at: int, length: int) -> bytes:
    file = _kept_open(uri)
    file.seek(at)
    return file.read(length)

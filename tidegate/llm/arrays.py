"""Sorted arrays in files of the shared folder, mapped into memory by the workers that look things up."""

from __future__ import annotations

import io
import json
import mmap
import os
import uuid
from functools import lru_cache
from urllib.parse import unquote, urlparse

import numpy as np


_ALIGN = 16  # arrays in one file begin at multiples of it


def mounted(uri: str) -> str | None:
    """The path of a folder that is mounted on every machine; None for an object store or HDFS."""
    parts = urlparse(uri)
    if parts.scheme in ("", "file"):
        return unquote(parts.path)
    return None


def save(folder: str, name: str, array: np.ndarray) -> None:
    """Write one array.  A repeated task puts the same content in the same place, whole or not at all."""
    data = io.BytesIO()
    np.save(data, array)
    _put(folder, f"{name}.npy", [data.getbuffer()])


def save_together(folder: str, name: str, held: dict[str, np.ndarray]) -> None:
    """Write several arrays into one file: the length of a head, the head (type, shape and place of each), the arrays."""
    head, parts, at = {}, [], 0
    for key, array in held.items():
        array = np.ascontiguousarray(array)
        head[key] = [array.dtype.str, list(array.shape), at]
        gap = -array.nbytes % _ALIGN
        parts += [array.tobytes(), bytes(gap)]
        at += array.nbytes + gap
    text = json.dumps(head).encode()
    text += b" " * (-(len(text) + 8) % _ALIGN)
    _put(folder, f"{name}.pack", [len(text).to_bytes(8, "little"), text, *parts])


def _put(folder: str, name: str, parts: list) -> None:
    path = mounted(folder)
    if path is None:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        with store.open_output_stream(f"{root}/{name}") as out:  # visible once it is closed
            for part in parts:
                out.write(part)
        return
    os.makedirs(path, exist_ok=True)
    hidden = f"{path}/.{name}-{uuid.uuid4().hex}"
    with open(hidden, "wb") as out:
        out.writelines(parts)
    os.replace(hidden, f"{path}/{name}")


def _unpacked(data) -> dict[str, np.ndarray]:
    start = 8 + int.from_bytes(data[:8], "little")
    head = json.loads(bytes(data[8:start]))
    return {key: np.frombuffer(data, dtype, int(np.prod(shape)), start + at).reshape(shape) if np.prod(shape) else np.zeros(shape, dtype)
            for key, (dtype, shape, at) in head.items()}


@lru_cache(maxsize=4096)
def _mapped(path: str) -> np.ndarray | None:
    try:
        return np.asarray(np.load(path, mmap_mode="r"))  # a plain array over the mapped pages
    except FileNotFoundError:
        return None
    except ValueError:  # an empty array cannot be mapped
        return np.load(path)


@lru_cache(maxsize=4096)
def _mapped_together(path: str) -> dict[str, np.ndarray] | None:
    try:
        with open(path, "rb") as file:
            return _unpacked(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ))
    except FileNotFoundError:
        return None


@lru_cache(maxsize=16)
def _fetched(folder: str, name: str) -> np.ndarray | None:
    data = _content(folder, f"{name}.npy")
    return None if data is None else np.load(io.BytesIO(data))


@lru_cache(maxsize=4)
def _fetched_together(folder: str, name: str) -> dict[str, np.ndarray] | None:
    data = _content(folder, f"{name}.pack")
    return None if data is None else _unpacked(data)


def _content(folder: str, name: str) -> bytes | None:
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(folder)
    if store.get_file_info(f"{root}/{name}").type == fs.FileType.NotFound:
        return None
    with store.open_input_file(f"{root}/{name}") as file:
        return file.read()


def load(folder: str, name: str) -> np.ndarray | None:
    """An array as it was saved, None where no such file was written.

    In a mounted folder the file is memory-mapped: only the pages that are looked
    at are read, and the processes of a machine share them.  Elsewhere one shard
    is fetched at a time, and a few are kept.
    """
    path = mounted(folder)
    return _fetched(folder, name) if path is None else _mapped(f"{path}/{name}.npy")


def load_together(folder: str, name: str) -> dict[str, np.ndarray] | None:
    """The arrays that were saved together, by their keys, None where no such file was written; one file is opened for all."""
    path = mounted(folder)
    return _fetched_together(folder, name) if path is None else _mapped_together(f"{path}/{name}.pack")

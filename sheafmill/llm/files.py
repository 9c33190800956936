"""Files of arrays in the shared folder, which workers write and read."""

from __future__ import annotations

import os
import uuid

import numpy as np
import pyarrow.fs as fs


def write_arrays(root: str, arrays: list[np.ndarray]) -> str:
    """Write arrays one after another; returns the file's URI."""
    uri = f"{root}/{uuid.uuid4().hex}"
    store, path = fs.FileSystem.from_uri(uri)
    store.create_dir(os.path.dirname(path), recursive=True)
    with store.open_output_stream(path) as out:
        for a in arrays:
            out.write(np.ascontiguousarray(a).tobytes())
    return uri


class File:
    """Arrays in a file of the shared folder, read where they are needed: mapped, or by reads at a place."""

    def __init__(self, uri: str):
        store, path = fs.FileSystem.from_uri(uri)
        self.map = np.memmap(path, dtype=np.uint8, mode="r") if isinstance(store, fs.LocalFileSystem) else None
        self.source = None if self.map is not None else store.open_input_file(path)

    def read(self, offset: int, kind: str, *shape: int) -> np.ndarray:
        size = int(np.prod(shape)) * np.dtype(kind).itemsize
        octets = self.map[offset : offset + size] if self.map is not None else np.frombuffer(self.source.read_at(size, offset), dtype=np.uint8)
        return octets.view(kind).reshape(shape)

    def rows(self, places: np.ndarray, d: int) -> np.ndarray:
        """The vectors at these places of an array of vectors that starts the file."""
        if self.map is not None:
            return self.map[: len(self.map) // (8 * d) * 8 * d].view("<i8").reshape(-1, d)[places]
        return np.concatenate([self.read(int(p) * 8 * d, "<i8", 1, d) for p in places]) if len(places) else np.empty((0, d), dtype="<i8")

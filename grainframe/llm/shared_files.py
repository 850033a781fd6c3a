"""Files of the folder that all executors share, by URI."""

from __future__ import annotations

import mmap
import tempfile

import numpy as np
from pyarrow import fs as pafs


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder given as URI or plain path."""
    return pafs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))


def write_file(folder: str, name: str, parts: list[bytes], attempt: int) -> None:
    """Writes under a name of the attempt, then renames: what is read is complete."""
    store, base = filesystem(folder)
    store.create_dir(base, recursive=True)
    draft = f"{base}/{name}.{attempt}"
    with store.open_output_stream(draft, compression=None) as out:
        for part in parts:
            out.write(part)
    store.move(draft, f"{base}/{name}")


def map_file(folder: str, name: str) -> np.ndarray:
    """The file's bytes, memory-mapped.

    A file of a remote store is first copied to a nameless temporary file of this
    worker, which goes with the mapping.
    """
    store, base = filesystem(folder)
    if isinstance(store, pafs.LocalFileSystem):
        return np.memmap(f"{base}/{name}", dtype=np.uint8, mode="r")
    copy = tempfile.TemporaryFile()
    with store.open_input_stream(f"{base}/{name}", compression=None) as source:
        while block := source.read(8 << 20):
            copy.write(block)
    copy.flush()
    return np.frombuffer(mmap.mmap(copy.fileno(), 0, access=mmap.ACCESS_READ), dtype=np.uint8)

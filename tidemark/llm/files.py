"""Binary files that tasks write to and read from the shared folder."""

from __future__ import annotations

import uuid

from pyarrow import NativeFile, fs


def new_file(folder: str, name: str) -> tuple[str, NativeFile]:
    """A file no other attempt of the task writes to, and its path, which counts once the task succeeded."""
    system, path = fs.FileSystem.from_uri(folder)
    system.create_dir(path, recursive=True)
    own = f"{name}-{uuid.uuid4().hex}"
    return f"{folder}/{own}", system.open_output_stream(f"{path}/{own}")


def open_file(uri: str) -> NativeFile:
    """A stored file for reading at any place."""
    system, path = fs.FileSystem.from_uri(uri)
    return system.open_input_file(path)

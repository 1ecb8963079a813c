"""Binary files that tasks write to and read from the shared folder."""

from __future__ import annotations

import uuid
from typing import BinaryIO

from pyarrow import fs


def _place(folder: str) -> tuple[fs.FileSystem, str]:
    if folder.startswith("file:"):
        return fs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)


def create(folder: str, suffix: str) -> tuple[str, BinaryIO]:
    """A new file with a name no other attempt of the task uses. Only files named by finished tasks are ever read."""
    system, path = _place(folder)
    system.create_dir(path, recursive=True)
    name = f"{uuid.uuid4().hex}{suffix}"
    return name, system.open_output_stream(f"{path}/{name}", compression=None)


def open_file(folder: str, name: str) -> BinaryIO:
    system, path = _place(folder)
    return system.open_input_file(f"{path}/{name}")

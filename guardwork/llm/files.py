"""Files that tasks write to and read from a folder that all executors share."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyarrow import fs


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


@contextlib.contextmanager
def whole_file(folder: str, name: str) -> Iterator:
    """A stream to a new file that gets its name only when complete.

    A task that runs twice replaces its file by an equal one; a lost task leaves a file under
    another name, which no reader takes.
    """
    system, path = opened(folder)
    system.create_dir(path, recursive=True)
    draft = f"{path}/.{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(draft) as stream:
        yield stream
    system.move(draft, f"{path}/{name}")


def reading(folder: str, name: str):
    """Random access to a file."""
    system, path = opened(folder)
    return system.open_input_file(f"{path}/{name}")

"""Whole files in the shared folder, written and read inside tasks through the file system of their URI."""

from __future__ import annotations

import uuid

from pyarrow import fs

from txrisk.llm.common import full_uri


def write_file(folder: str, suffix: str, data: bytes) -> str:
    """Write ``data`` below ``folder`` and return its URI.

    The name is used once, so a repeated or speculative task never overwrites a file. Readers go by the table of names that
    the tasks return, which holds those of one successful attempt of each.
    """
    return write_named(folder, uuid.uuid4().hex + suffix, data)


def write_named(folder: str, name: str, data: bytes) -> str:
    """Write ``data`` to the file ``name`` below ``folder``, for what is the same whoever writes it."""
    uri = f"{full_uri(folder)}/{name}"
    system, path = fs.FileSystem.from_uri(uri)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with system.open_output_stream(path) as out:
        out.write(data)
    return uri


def read_file(uri: str, at: int = 0, size: int | None = None) -> bytes:
    """The whole file, or ``size`` bytes of it from ``at``."""
    system, path = fs.FileSystem.from_uri(uri)
    if size is not None:
        with system.open_input_file(path) as file:
            return file.read_at(size, at)
    with system.open_input_stream(path) as file:
        return file.read()

"""Plain files in the shared folder, written and read inside tasks.

A file's name holds the task attempt that wrote it, and only names that a
finished task reported are read, so a repeated or speculative attempt never
touches another's file.
"""

from __future__ import annotations

from pyarrow import fs
from pyspark import TaskContext


def _at(uri: str) -> tuple[fs.FileSystem, str]:
    if "://" not in uri:
        return fs.LocalFileSystem(), uri.removeprefix("file:")
    system, path = fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))
    return system, path


def attempt_name(kind: str, number: int) -> str:
    task = TaskContext.get()
    return f"part-{task.partitionId():06d}-{task.taskAttemptId()}-{number:05d}.{kind}"


def write_bytes(folder: str, name: str, data: bytes) -> None:
    system, path = _at(folder)
    system.create_dir(path, recursive=True)
    with system.open_output_stream(f"{path}/{name}", compression=None) as f:
        f.write(data)


def open_file(folder: str, name: str):
    """A seekable file; the caller closes it."""
    system, path = _at(folder)
    return system.open_input_file(f"{path}/{name}")

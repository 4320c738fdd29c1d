"""Files of an own format in the shared folder, written by tasks.

A task attempt writes under a name nobody else uses and reports it in a row of a
manifest, which Spark commits as a table. Files of failed or repeated attempts are in
no manifest and so are never read.
"""

from __future__ import annotations

import uuid

from pyspark import TaskContext


def _place(path: str):
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def create(path: str):
    """A stream to write; missing folders are made."""
    system, place = _place(path)
    system.create_dir(place.rpartition("/")[0], recursive=True)
    return system.open_output_stream(place, compression=None)


def reopen(path: str):
    """A file that can be read from any position."""
    system, place = _place(path)
    return system.open_input_file(place)


def attempt_name(folder: str, ending: str) -> str:
    return f"{folder}/{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}{ending}"

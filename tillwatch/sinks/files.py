"""Files behind a path or URI, for data sources whose tasks write them and whose driver makes them visible."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import WriterCommitMessage

STAGED = "_staged"


@dataclass
class Written(WriterCommitMessage):
    """What a task wrote: staged files, and what the driver needs to know of each."""

    files: list


def at(path: str):
    """(file system, path in it)."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def exists(system, path: str) -> bool:
    return bool(system.get_file_info(path).is_file)


def staged_name(folder: str, job: str) -> str:
    """A fresh name; attempts of a task never share one."""
    return f"{folder}/{STAGED}/{job}/{uuid.uuid4().hex}"


def replace(system, source: str, target: str) -> None:
    """Rename; where the file system doesn't replace files that way, the old one goes first."""
    try:
        system.move(source, target)
    except OSError:
        if not exists(system, target) or not exists(system, source):
            raise
        system.delete_file(target)
        system.move(source, target)


def drop_staged(system, folder: str, job: str) -> None:
    from pyarrow import fs

    if system.get_file_info(f"{folder}/{STAGED}/{job}").type == fs.FileType.Directory:
        system.delete_dir(f"{folder}/{STAGED}/{job}")


def digests(folder: str, batches: Iterator) -> Iterator:
    """Length and SHA-256 of the files named in ``document``, read in blocks: a file may be larger than what fits into one value."""
    import pyarrow as pa

    system, place = at(folder)
    for batch in batches:
        for name in batch.column("document").to_pylist():
            hashed, length = hashlib.sha256(), 0
            with system.open_input_stream(f"{place}/{name}") as stream:
                while block := stream.read(1 << 22):
                    hashed.update(block)
                    length += len(block)
            yield pa.RecordBatch.from_pydict({"document": [name], "n_bytes": [length], "sha256": [hashed.hexdigest()]})

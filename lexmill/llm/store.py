"""Binary artefacts (filters, automata, token files) in the shared folder of the session.

Tasks write whole objects under names that depend on their content's place only, so a task that
runs again overwrites its own object with the same bytes.
"""

from __future__ import annotations

import re
import uuid

from pyarrow import fs
from pyspark.sql import SparkSession

from ..operators.lineage import ensure_checkpoint_dir


def new_folder(spark: SparkSession, name: str) -> str:
    """URI of a fresh folder under ``spark.checkpoint.dir``."""
    ensure_checkpoint_dir(spark)
    root = spark.sparkContext.getCheckpointDir().rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex}"


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    uri = re.sub(r"^file:/+", "file:///", uri)
    uri = re.sub(r"^s3[an]://", "s3://", uri)
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def put(uri: str, *parts: bytes) -> int:
    """Write the parts as one object: under another name first, then moved into place."""
    system, path = _open(uri)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    draft = f"{path}.{uuid.uuid4().hex}"
    size = 0
    with system.open_output_stream(draft) as out:
        for part in parts:
            out.write(part)
            size += len(part)
    system.move(draft, path)
    return size


def get(uri: str) -> bytes:
    system, path = _open(uri)
    with system.open_input_stream(path) as f:
        return f.read()


class Ranges:
    """Ranged reads of one object."""

    def __init__(self, uri: str):
        system, path = _open(uri)
        self.file = system.open_input_file(path)

    def __call__(self, start: int, size: int) -> bytes:
        self.file.seek(start)
        return self.file.read(size)

    def close(self) -> None:
        self.file.close()

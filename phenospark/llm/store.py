"""Files of our own in the shared folder, through the file system that the address names."""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from itertools import accumulate

from pyarrow import fs
from pyspark.sql import DataFrame


def located(address: str) -> tuple[fs.FileSystem, str]:
    """The file system of an address (file, hdfs, s3, gs or a plain path) and the path in it."""
    if address.startswith("file:") or "://" not in address:
        path = address.removeprefix("file:")
        return fs.LocalFileSystem(), "/" + path.lstrip("/")
    return fs.FileSystem.from_uri(address.replace("s3a://", "s3://", 1))


@contextmanager
def new_file(folder: str, name: str):
    """A file for one attempt of a task, and its address.

    Each attempt writes a file of its own; only the rows of the attempt that Spark commits
    name one, so a lost or repeated task leaves at most a file that nothing reads.
    """
    address = f"{folder}/{name}-{uuid.uuid4().hex}"
    system, path = located(address)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with system.open_output_stream(path) as out:
        yield out, address


class Ranges:
    """Range reads from files that stay open between reads."""

    def __init__(self, keep: int = 16) -> None:
        self.keep, self.files = keep, {}

    def file(self, address: str):
        if address not in self.files:
            while len(self.files) >= self.keep:
                self.files.pop(next(iter(self.files))).close()
            system, path = located(address)
            self.files[address] = system.open_input_file(path)
        return self.files[address]

    def read(self, address: str, offset: int, length: int) -> bytes:
        return self.file(address).read_at(length, offset)

    def tail(self, address: str, length: int) -> bytes:
        file = self.file(address)
        return file.read_at(length, file.size() - length)


def running_totals(manifest: DataFrame, count: str, order: str) -> dict[str, int]:
    """What lies before each file of a manifest; one row per file passes through the driver."""
    rows = manifest.select("file", count).orderBy(order).collect()
    before = accumulate((r[count] for r in rows), initial=0)
    return {r["file"]: b for r, b in zip(rows, before, strict=False)}

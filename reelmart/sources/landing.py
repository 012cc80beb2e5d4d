"""Landed objects listed and hashed inside tasks.

A Spark file scan gathers the status of every file on the driver before its
first task runs. Here the driver knows prefixes only (one a client, or one a
client and day): each task lists its prefixes and gives the statuses back as
rows, so a store of any number of objects costs the driver nothing. Objects
are hashed as streams, a few megabytes at a time, whatever their size.

Tasks open stores through ``pyarrow.fs`` (local and shared folders, S3, GCS,
Azure, HDFS). ``files.landing_listing`` remains for stores that only Spark's
readers can open.
"""

from __future__ import annotations

import hashlib
import os
import sys
from collections.abc import Iterator
from datetime import datetime, timezone
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame

# tasks get these functions with the job: they need no installed package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: statuses of one Arrow batch
BATCH = 10_000
#: bytes of an object held at a time
PIECE = 8 << 20
_STATUS = [("path", pa.string()), ("length", pa.int64()), ("modified_at", pa.timestamp("us", tz="UTC"))]


def opened(path: str) -> tuple[fs.FileSystem, str, str]:
    """File system, path in it, and what stands before the path in URIs. Paths
    are taken as they are written, with blanks and percent signs."""
    scheme, there, rest = path.partition(":/")
    if not there or "/" in scheme:
        return fs.FileSystem.from_uri(path) + ("",)
    rest = "/" + rest if scheme != "file" else "//" + "/" + rest.lstrip("/")
    store, name = fs.FileSystem.from_uri(f"{scheme}:{quote(rest, safe='/@:')}")
    whole = f"{scheme}:{rest}"
    return store, name, whole[:len(whole) - len(name)]


def statuses(prefix: str) -> Iterator[tuple[str, int, datetime]]:
    """Every object under a prefix; folders are entered one by one, a missing
    prefix has none."""
    store, top, head = opened(prefix.rstrip("/") or "/")
    local = isinstance(store, fs.LocalFileSystem)
    folders = [top]
    while folders:
        folder = folders.pop()
        if local:  # an iterator: a folder of many files is never held
            if not os.path.isdir(folder):
                continue
            with os.scandir(folder) as entries:
                for e in entries:
                    if e.is_dir():
                        folders.append(e.path)
                    elif not e.name.startswith((".", "_")):
                        s = e.stat()
                        yield head + e.path, s.st_size, datetime.fromtimestamp(s.st_mtime, timezone.utc)
        else:
            for e in store.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
                if e.type == fs.FileType.Directory:
                    folders.append(e.path)
                elif not e.base_name.startswith((".", "_")):
                    yield head + e.path, e.size, e.mtime


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), _STATUS)],
                                      [n for n, _ in _STATUS])


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    for batch in batches:
        for prefix in batch.column(0).to_pylist():
            for status in statuses(prefix):
                rows.append(status)
                if len(rows) == BATCH:
                    yield _batch(rows)
                    rows = []
    if rows:
        yield _batch(rows)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sums = []
        for path in batch.column("path").to_pylist():
            store, name, _ = opened(path)
            total = hashlib.sha256()
            with store.open_input_stream(name) as stream:
                while piece := stream.read(PIECE):
                    total.update(piece)
            sums.append(total.hexdigest())
        yield batch.append_column("content_sha256", pa.array(sums, pa.string()))


def _folders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for prefix in batch.column(0).to_pylist():
            store, top, head = opened(prefix.rstrip("/") or "/")
            if isinstance(store, fs.LocalFileSystem):
                with os.scandir(top) as entries:
                    found = [head + e.path for e in entries if e.is_dir()]
            else:
                found = [head + e.path for e in store.get_file_info(fs.FileSelector(top, allow_not_found=True))
                         if e.type == fs.FileType.Directory]
            for a in range(0, len(found), BATCH):
                yield pa.RecordBatch.from_arrays([pa.array(found[a:a + BATCH], pa.string())], ["prefix"])


def folders(prefixes: DataFrame) -> DataFrame:
    """``prefix`` column -> the folders right under each, as prefixes, so that the
    next listing has a row for each and is shared out among tasks."""
    return prefixes.select("prefix").distinct().mapInArrow(_folders, "prefix string")


#: characters that Spark escapes in the folder names of partitions, and its name for a missing value
_ESCAPED = frozenset([*map(chr, range(1, 32)), *"\"#%'*/:=?\\{[]^", "\x7f"])
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def part_folder(name: str, value: str | None) -> str:
    """``name=value`` as Spark's partitioned writers call the folder."""
    safe = "".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in value or NO_VALUE)
    return f"{name}={safe}"


def _written(root: str, keys: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top, _ = opened(root)
        local, at, stream = isinstance(store, fs.LocalFileSystem), None, None
        try:
            for batch in batches:
                for *values, text in zip(*(c.to_pylist() for c in batch.columns)):
                    folder = "/".join([top, *map(part_folder, keys, values)])
                    if folder != at:
                        if stream:
                            stream.close()
                        if local:  # other stores have no folders to make
                            os.makedirs(folder, exist_ok=True)
                        at, stream = folder, store.open_output_stream(f"{folder}/part-00000.txt")
                    stream.write((text or "").encode() + b"\n")
        finally:
            if stream:
                stream.close()
        yield from ()
    return run


def put_objects(objects: DataFrame, keys: list[str], text: str, root: str) -> None:
    """Write the ``text`` of each object, a line end after it, into a folder by
    its ``keys`` (the last one tells objects apart; rows of equal keys share an
    object). Tasks write the objects where they belong: there is no commit that
    moves them one by one on the driver, and a repeated task writes them anew."""
    (objects.select(*keys, text).repartition(keys[-1]).sortWithinPartitions(*keys)
     .mapInArrow(_written(root.rstrip("/"), keys), "done boolean").write.format("noop").mode("overwrite").save())


def list_prefixes(prefixes: DataFrame, tasks: int | None = None) -> DataFrame:
    """``prefix`` column -> path, length and modification time of every object
    under it. Names that begin with a dot or an underscore are not objects."""
    rows = prefixes.select("prefix").distinct()
    if tasks:
        rows = rows.repartition(tasks, "prefix")
    return rows.mapInArrow(_listed, "path string, length long, modified_at timestamp")


def hash_objects(listing: DataFrame) -> DataFrame:
    """``listing`` with the sha256 of each object's bytes. Objects are dealt out
    by path, so a client of many objects keeps no task to itself."""
    return listing.repartition("path").mapInArrow(
        _hashed, "path string, length long, modified_at timestamp, content_sha256 string")

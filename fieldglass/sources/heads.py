"""A data source that looks at the beginning of files: ``spark.read.format("file_heads").load(folder)``.

One row per file ``(path, size, header, reason)``: the first line that is not blank, or why there is none. A partition is a list of files or
of folders; folders are listed by the task that gets them, so neither the driver nor any task holds all paths. Of a plain file one
block is read. A compressed file is read through once, as only its end shows whether it is whole.

The class is pickled by value: workers need pyarrow, and this package only here.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "path string, size long, header string, reason string"
#: Bytes read of a plain file at first, and files or folders of a partition.
BLOCK, ENTRIES = 1 << 16, 64
#: Compressions that Spark tells by the suffix and Python can check.
COMPRESSED = {".gz": "gzip", ".bz2": "bz2", ".zst": "zstd"}
#: Stores that pyarrow can open without more than a path.
SCHEMES = ("", "file")


def openable(paths: Sequence[str]) -> bool:
    """Whether Python workers can open all of these paths; for other stores Spark's own readers must do."""
    from urllib.parse import urlsplit

    return all(urlsplit(p).scheme in SCHEMES for p in paths)


class HeadsPartition(InputPartition):
    def __init__(self, entries: list[str]):
        self.entries = entries


class HeadsReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.paths = json.loads(options["paths"]) if "paths" in options else [options["path"]]
        self.files = self.folders = None

    @staticmethod
    def _store(path: str):
        from pyarrow import fs

        if "://" in path or path.startswith("file:"):
            return fs.FileSystem.from_uri(path.replace("file:", "file://", 1) if path.startswith("file:/") and not path.startswith("file://") else path)
        return fs.LocalFileSystem(), path

    @staticmethod
    def _hidden(name: str) -> bool:
        return name[0] in "._"

    def _listed(self, path: str, deep: bool) -> Iterator:
        """Entries of a folder as ``(path, is a folder)``, hidden ones left out."""
        from pyarrow import fs

        store, inner = self._store(path)
        selector = fs.FileSelector(inner, recursive=deep)
        for info in sorted(store.get_file_info(selector), key=lambda i: i.path):
            below = info.path[len(inner.rstrip("/")) + 1 :].split("/")
            if not any(self._hidden(part) for part in below):
                yield info.path, info.type == fs.FileType.Directory

    def partitions(self) -> list[HeadsPartition]:
        from glob import glob

        from pyarrow import fs

        entries: list[str] = []
        for path in self.paths:
            store, inner = self._store(path)
            matches = (sorted(glob(inner)) or [inner]) if any(c in inner for c in "*?[") else [inner]
            for one in matches:
                if store.get_file_info(one).type == fs.FileType.Directory:
                    entries += [p for p, _ in self._listed(one, False)]
                else:
                    entries.append(one)
        return [HeadsPartition(entries[i : i + ENTRIES]) for i in range(0, len(entries), ENTRIES)] or [HeadsPartition([])]

    def read(self, partition: HeadsPartition) -> Iterator[tuple]:
        from pyarrow import fs

        for entry in partition.entries:
            store, inner = self._store(entry)
            info = store.get_file_info(inner)
            if info.type == fs.FileType.NotFound:
                yield "file://" + inner, None, None, "not found"
            elif info.type == fs.FileType.Directory:
                for path, folder in self._listed(inner, True):
                    if not folder:
                        yield self._head(store, path)
            else:
                yield self._head(store, inner)

    def _head(self, store, path: str) -> tuple:
        size = store.get_file_info(path).size
        header = reason = None
        if not size:
            reason = "empty file"
        else:
            try:
                header = self._first_line(store, path)
                reason = None if header else "empty file"
            except (OSError, EOFError, ValueError) as error:
                reason = (str(error).splitlines() or [type(error).__name__])[0][:200]
        return "file://" + path, size, header or None, reason

    def _first_line(self, store, path: str) -> str | None:
        kind = next((k for suffix, k in COMPRESSED.items() if path.endswith(suffix)), None)
        found, held = None, b""
        # Without a compression pyarrow would guess one by the name.
        with store.open_input_stream(path, compression=kind) as stream:
            while block := stream.read(BLOCK):
                if found is None:
                    held += block
                    *lines, held = held.replace(b"\r\n", b"\n").replace(b"\r", b"\n").split(b"\n") if not held.endswith(b"\r") else [held]
                    found = next((line for line in lines if line.strip()), None)
                if found is not None and kind is None:
                    break
        line = found if found is not None else held
        return line.decode("utf-8", "replace").removeprefix("﻿").strip("\r\n") or None


class FileHeads(DataSource):
    @classmethod
    def name(cls) -> str:
        return "file_heads"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> HeadsReader:
        return HeadsReader(self.options)


def file_heads(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Heads of the files under folders, files or globs; a path without any file gives a row with its reason."""
    import sys

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(FileHeads)
    return spark.read.format("file_heads").option("paths", json.dumps(list(paths))).load()

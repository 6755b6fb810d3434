"""A data source of stored files that are inflated in blocks: their lines, their elements, or their sizes and hashes.

    spark.read.format("inflated").option("rows", "lines").load(path)

``rows`` is ``lines`` (file, line from 1, value), ``elements`` (file, position, xml, error: the elements of ``tag``, cut out by a
pull parser; a document that breaks, or isn't of element ``root``, has a row with the error) or ``digests`` (file, size_bytes, sha256_file, bytes_raw, sha256_raw, n_lines: those that aren't blank). ``path`` may have
``*``, ``?`` and ``{a,b}``. Files that end in ``.gz`` may have several members.

A task holds a block, not a file, and the row it is at: a member of any size passes in the same memory. Small files are packed
to about ``PACK`` bytes a task. A damaged file fails the read and is named.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..session import importable
from . import xml

BLOCK, PACK = 1 << 20, 64 << 20
SCHEMAS = {
    "lines": "file string, line long, value string",
    "elements": "file string, position long, xml string, error string",
    "digests": "file string, size_bytes long, sha256_file string, bytes_raw long, sha256_raw string, n_lines long",
}


def located(path: str) -> tuple[fs.FileSystem, str, str]:
    """The store of a path, the path in it, and what it is to be prefixed with."""
    uri = re.sub(r"^file:/(?!/)", "file:///", path if "://" in path or path.startswith("file:/") else f"file://{path}")
    scheme, rest = uri.split("://", 1)
    host = rest.split("/", 1)[0]
    # a glob is no address: only the scheme and the host are given to the store
    store, inner = fs.FileSystem.from_uri(f"{scheme}://{host}/")
    prefix = inner.rstrip("/")
    return store, f"{prefix}/{rest.split('/', 1)[1]}", f"{scheme}://{host}"


def _pattern(path: str) -> re.Pattern:
    out, depth = "", 0
    for c in path:
        depth += (c == "{") - (c == "}")
        out += {"*": "[^/]*", "?": "[^/]", "{": "(?:", "}": ")", ",": "|" if depth else ","}.get(c, re.escape(c))
    return re.compile(out)


def found(path: str) -> list[tuple[str, int]]:
    """(path, size) of the files of a glob, in order; one that matches a folder stands for the files in it."""
    store, inner, _ = located(path)
    base = re.split(r"[*?{]", inner, maxsplit=1)[0]
    if base == inner:
        info = store.get_file_info(inner)
        listed = [info] if info.is_file else store.get_file_info(fs.FileSelector(inner, allow_not_found=True))
        wanted = re.compile(".*", re.S)
    else:
        listed = store.get_file_info(fs.FileSelector(base.rsplit("/", 1)[0] or "/", recursive=True, allow_not_found=True))
        wanted = re.compile(f"{_pattern(inner).pattern}(?:/[^/]*)?")
    hidden = lambda p: p.rsplit("/", 1)[-1].startswith(("_", "."))
    return sorted((i.path, i.size) for i in listed if i.is_file and wanted.fullmatch(i.path) and not hidden(i.path))


def blocks(store: fs.FileSystem, path: str, seen=None) -> Iterator[bytes]:
    """The content of a file, inflated if it is gzip, in pieces of at most ``BLOCK`` bytes; ``seen`` is called with the stored bytes."""
    with store.open_input_stream(path, compression=None) as f:
        inflater = zlib.decompressobj(31) if path.endswith(".gz") else None
        while data := f.read(BLOCK):
            if seen:
                seen(data)
            if inflater is None:
                yield data
                continue
            while data:
                if inflater.eof:
                    data = data.lstrip(b"\0")  # what pads the end of a member
                    if not data:
                        break
                    inflater = zlib.decompressobj(31)
                try:
                    out = inflater.decompress(data, BLOCK)
                except zlib.error as e:
                    raise ValueError(f"{path}: {e}") from e
                if out:
                    yield out
                data = inflater.unused_data if inflater.eof else inflater.unconsumed_tail
        if inflater is not None and not inflater.eof:
            raise ValueError(f"{path}: the file ends within a gzip member")


def _lines(pieces: Iterator[bytes]) -> Iterator[bytes]:
    rest: list[bytes] = []
    for piece in pieces:
        first, *more = piece.split(b"\n")
        rest.append(first)
        if more:
            yield b"".join(rest)
            yield from more[:-1]
            rest = [more[-1]]
    if last := b"".join(rest):
        yield last


@dataclass
class Files(InputPartition):
    paths: list[str]


class Inflated(DataSource):
    @classmethod
    def name(cls) -> str:
        return "inflated"

    def schema(self) -> str:
        return SCHEMAS[self.options.get("rows", "lines")]

    def reader(self, schema) -> DataSourceReader:
        return InflatedReader(self.options["path"], self.options.get("rows", "lines"), self.options.get("tag"), self.options.get("root"))


class InflatedReader(DataSourceReader):
    def __init__(self, path: str, rows: str, tag: str | None, root: str | None) -> None:
        self.path, self.rows, self.tag, self.root = path, rows, tag, root

    def partitions(self) -> list[Files]:
        total, packed = 0, []
        for path, size in found(self.path):
            packed.append((total // PACK, path))
            total += max(size, PACK // 256)
        return [Files([p for _, p in group]) for _, group in groupby(packed, lambda x: x[0])] or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        store, _, prefix = located(self.path)
        for path in partition.paths:
            name = f"{prefix}{path if path.startswith('/') else '/' + path}"
            yield from getattr(self, self.rows)(store, path, name)

    def lines(self, store: fs.FileSystem, path: str, name: str) -> Iterator[pa.RecordBatch]:
        held, size, at = [], 0, 1

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([name] * len(held), pa.string()), pa.array(range(at, at + len(held)), pa.int64()), pa.array(held, pa.string())], ["file", "line", "value"])

        for line in _lines(blocks(store, path)):
            held.append(line.removesuffix(b"\r").decode("utf-8", "replace"))
            size += len(line)
            if size > BLOCK or len(held) == 10_000:
                yield batch()
                at, held, size = at + len(held), [], 0
        if held:
            yield batch()

    def elements(self, store: fs.FileSystem, path: str, name: str) -> Iterator[pa.RecordBatch]:
        names = ["file", "position", "xml", "error"]
        for i, (text, error) in enumerate(xml.elements(blocks(store, path), self.tag, self.root)):
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([i], pa.int64()), pa.array([text], pa.string()), pa.array([error], pa.string())], names)

    def digests(self, store: fs.FileSystem, path: str, name: str) -> Iterator[pa.RecordBatch]:
        stored, raw = hashlib.sha256(), hashlib.sha256()
        sizes, told = [0, 0], [0, False]

        def seen(data: bytes) -> None:
            stored.update(data)
            sizes[0] += len(data)

        for piece in blocks(store, path, seen):
            raw.update(piece)
            sizes[1] += len(piece)
            # of the line that a piece ends in only whether it has told something so far is kept
            first, *more = piece.split(b"\n")
            told[1] = told[1] or bool(first.strip())
            for line in more:
                told[0] += told[1]
                told[1] = bool(line.strip())
        values = [name, sizes[0], stored.hexdigest(), sizes[1], raw.hexdigest(), told[0] + told[1]]
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in values], ["file", "size_bytes", "sha256_file", "bytes_raw", "sha256_raw", "n_lines"])


def inflated(spark: SparkSession, path: str, rows: str = "lines", **options: str) -> DataFrame:
    importable(spark).dataSource.register(Inflated)
    reader = spark.read.format("inflated").option("rows", rows)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(path)

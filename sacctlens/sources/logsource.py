"""A data source that reads event logs file by file and never fails on one of them.

``spark.read.format("sacctlens_event_log").load(folder)`` gives a row per line and, for
every file, a closing row with its status:

* ``whole``       — read to its end;
* ``open``        — its application is still running (``.inprogress`` in its name, or an
  ``appstatus_*.inprogress`` beside it): what had been written when the folder was
  listed counts, a last line or frame that is not complete does not;
* ``cut off``     — a compressed stream that ends early;
* ``damaged``     — bytes that are no such stream, or a codec that cannot be read here;
* ``unreadable``  — the file vanished or may not be opened.

A file is decoded in pieces of ``READ`` bytes and handed on in batches of lines, so its
size does not matter.  Plain files are split into ranges of ``SPLIT`` bytes (a line
belongs to the range it starts in); a compressed stream is one partition.  Files are
opened with ``pyarrow.fs``: local, HDFS, S3 and GCS addresses.  Only names, sizes and
times pass through the driver.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# Executors need no copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "sacctlens_event_log"
SCHEMA = "log_id string, file_name string, file_mtime_ms long, line string, status string"
READABLE = ("whole", "open")
READ = 1 << 16
SPLIT = 128 << 20
#: Lines handed on at a time, in bytes; a longer single line is no event and counts as malformed.
BATCH_BYTES = 4 << 20
LONGEST_LINE = 64 << 20
TOO_LONG = "(line too long)"

ROLLED = re.compile(r"^events_\d+_")
SUFFIX = re.compile(r"\.(gz|zst|zstd|lz4|snappy|lzf|inprogress)$")
CODEC = re.compile(r"\.(gz|zst|zstd|lz4|snappy|lzf)(?:\.inprogress)?$")


class Broken(Exception):
    """A stream that cannot be decoded; its argument is the status."""


@dataclass
class LogPart(InputPartition):
    path: str
    log_id: str
    name: str
    mtime_ms: int
    start: int
    stop: int
    size: int
    running: bool


def file_system(address: str):
    """The file system of an address and the path within it."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", address))


def log_of(folder: str, parent: str, name: str) -> str:
    """Rolled parts in a folder are one log, by the folder's name; others are named by their file."""
    if ROLLED.match(name) and parent != folder:
        return parent
    plain = name
    while SUFFIX.search(plain):
        plain = SUFFIX.sub("", plain)
    return ROLLED.sub("", plain)


def list_parts(address: str, split: int = SPLIT) -> list[LogPart]:
    from pyarrow import fs as pafs
    fs, top = file_system(address)
    found = [f for f in fs.get_file_info(pafs.FileSelector(top, recursive=True)) if f.type == pafs.FileType.File]
    running = {f.path.rsplit("/", 1)[0] for f in found if re.match(r"appstatus_.*\.inprogress$", f.base_name)}
    parts = []
    for f in sorted(found, key=lambda f: f.path):
        name, folder = f.base_name, f.path.rsplit("/", 1)[0]
        inside = f.path[len(top.rstrip("/")) + 1:]
        if name.endswith(".crc") or name.startswith("appstatus_") or any(p[0] in "._" for p in inside.split("/")):
            continue
        log_id = log_of(top.rstrip("/").rsplit("/", 1)[-1], folder.rsplit("/", 1)[-1], name)
        mtime = int(f.mtime_ns // 1_000_000) if f.mtime_ns is not None else 0
        step = f.size if CODEC.search(name) else split
        for start in range(0, max(f.size, 1), max(step, 1)):
            parts.append(LogPart(f.path, log_id, name, mtime, start, min(start + step, f.size), f.size,
                                 name.endswith(".inprogress") or folder in running))
    return parts


def decoded(codec: str | None, pieces: Iterator[bytes]) -> Iterator[bytes]:
    """The bytes of a stream of one or more members; ``Broken`` where it ends or goes wrong."""
    if codec is None:
        yield from pieces
        return
    if codec == "gz":
        new, errors = (lambda: zlib.decompressobj(wbits=31)), (zlib.error,)
    elif codec in ("zst", "zstd"):
        import zstandard
        new, errors = (lambda: zstandard.ZstdDecompressor().decompressobj()), (zstandard.ZstdError,)
    else:
        raise Broken("damaged")
    member = None
    for piece in pieces:
        while piece:
            member = member or new()
            try:
                out = member.decompress(piece)
            except errors:
                raise Broken("damaged") from None
            if out:
                yield out
            piece = member.unused_data if member.eof else b""
            member = None if member.eof else member
    if member is not None:
        raise Broken("cut off")


def lines_of(pieces: Iterator[bytes], skip_first: bool, owned: int | None, keep_last: bool) -> Iterator[bytes]:
    """Lines of a stream of bytes.

    ``skip_first`` drops what belongs to a line that began before; with ``owned`` bytes,
    lines that start beyond them are left to the next range.  A last line without its
    end counts only with ``keep_last``.
    """
    rest, at, too_long = b"", 0, False                       # at: where ``rest`` starts
    for piece in pieces:
        body = rest + piece
        lines = body.split(b"\n")
        rest = lines.pop()
        for line in lines:
            if owned is not None and at >= owned:
                return
            if not skip_first:
                yield TOO_LONG.encode() if too_long else line
            skip_first = too_long = False
            at += len(line) + 1
        if len(rest) > LONGEST_LINE:
            at, rest, too_long = at + len(rest), b"", True
    if (rest or too_long) and keep_last and not skip_first and (owned is None or at < owned):
        yield TOO_LONG.encode() if too_long else rest


class LogReader(DataSourceReader):
    def __init__(self, address: str, split: int):
        self.address, self.split = address, split

    def partitions(self) -> list:
        return list_parts(self.address, self.split) or [LogPart("", "", "", 0, 0, 0, 0, False)]

    def read(self, part: LogPart) -> Iterator[pa.RecordBatch]:
        if not part.path:
            return
        columns = ["log_id", "file_name", "file_mtime_ms", "line", "status"]

        def rows(lines: list, status: str | None) -> pa.RecordBatch:
            n = len(lines)
            return pa.RecordBatch.from_arrays([pa.array([part.log_id] * n), pa.array([part.name] * n), pa.array([part.mtime_ms] * n, pa.int64()),
                                               pa.array(lines, pa.string()), pa.array([status] * n, pa.string())], names=columns)

        held, size, status = [], 0, "open" if part.running else "whole"
        codec = CODEC.search(part.name)
        try:
            for line in self._lines(part, codec[1] if codec else None):
                if line.strip():
                    held.append(line.decode("utf-8", "replace"))
                    size += len(line)
                    if size > BATCH_BYTES:
                        yield rows(held, None)
                        held, size = [], 0
        except Broken as broken:
            # A running application's last frame may be under way.
            if not (part.running and broken.args[0] == "cut off"):
                status = broken.args[0]
        except OSError:
            status = "unreadable"
        if held:
            yield rows(held, None)
        yield rows([None], status)

    def _lines(self, part: LogPart, codec: str | None) -> Iterator[bytes]:
        fs, _ = file_system(self.address)
        # A range starts at the byte before it: then a line that starts right there is told from one that began before.
        first = part.start - 1 if part.start else 0
        with fs.open_input_file(part.path) as f:
            f.seek(first)

            def pieces() -> Iterator[bytes]:
                left = part.size - first                     # what is written after the listing is left alone
                while left > 0:
                    piece = f.read(min(READ, left))
                    if not piece:
                        return
                    left -= len(piece)
                    yield piece

            owned = None if codec else part.stop - first
            yield from lines_of(decoded(codec, pieces()), part.start > 0, owned, keep_last=not part.running)


class EventLogSource(DataSource):
    """Options: ``path`` (the folder), ``split`` (bytes per range of a plain file)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return LogReader(self.options["path"], int(self.options.get("split", SPLIT)))

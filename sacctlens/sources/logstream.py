"""Event logs as they are written: a streaming data source over a folder of logs.

``spark.readStream.format("sacctlens_event_log_stream").load(folder)`` gives each line of
each log once, as soon as its end is written, in the columns of ``logsource``:

* a plain file is read from where the last batch stopped; a line belongs to the range in
  which it *ends*, so a line that is half written waits for the batch that sees its end;
* a compressed file is read when nothing more is written to it: a rolled part once a later
  part exists, any other file once its application has ended;
* a file that is complete gives a closing row with its status (``open`` while its
  application still runs, else as in ``logsource``), and every file of an application
  that has ended one more row, ``ended``.

The offset holds, per file, the bytes that are read, its state and its time; partitions
follow from two offsets alone, so a batch that is repeated after a failure reads the same
bytes.  Only names, sizes and times pass through the driver.  The folder is listed twice
for an offset: the states come from the first listing and the sizes from the second, so a
file that counts as complete has its final size.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from sacctlens.sources import logsource as L

# Executors need no copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "sacctlens_event_log_stream"
#: State of a file: still written, complete, complete and its application has ended.
OPEN, COMPLETE, ENDED = 0, 1, 2
ENDED_ROW = "ended"

PART_NUMBER = re.compile(r"^events_(\d+)_")
IN_PROGRESS = re.compile(r"\.inprogress$")


@dataclass
class Range(InputPartition):
    """Bytes start … stop of a file; a complete file has one byte more, which ends its last line."""
    path: str
    log_id: str
    mtime_ms: int
    start: int
    stop: int
    state: int
    closes: bool
    reads: bool


def file_states(parts: list[L.LogPart]) -> dict[str, int]:
    """The state of every file of a listing, by its path without ``.inprogress``."""
    newest: dict[str, int] = {}
    for p in parts:
        if number := PART_NUMBER.match(p.name):
            newest[p.log_id] = max(newest.get(p.log_id, 0), int(number[1]))
    states = {}
    for p in parts:
        number = PART_NUMBER.match(p.name)
        rolled = number and int(number[1]) < newest[p.log_id]
        states[IN_PROGRESS.sub("", p.path)] = ENDED if not p.running else COMPLETE if rolled else OPEN
    return states


def offset_of(states: dict[str, int], parts: list[L.LogPart]) -> dict[str, list[int]]:
    """path -> bytes to have read, state, time; ``parts`` may be listed later than ``states``."""
    out = {}
    for p in parts:
        key = IN_PROGRESS.sub("", p.path)
        state = states.get(key, OPEN)
        if state == OPEN and L.CODEC.search(p.name):
            out[key] = [0, OPEN, p.mtime_ms]
        else:
            out[key] = [p.size + (state != OPEN), state, p.mtime_ms]
    return out


def ranges_between(start: dict, end: dict, log_ids, split: int) -> list[Range]:
    """What the files hold at ``end`` beyond ``start``; ``log_ids`` names the log of a path."""
    found = []
    for path, (stop, state, mtime) in sorted(end.items()):
        at, before, _ = start.get(path, (0, OPEN, 0))
        log_id = log_ids(path)
        if before != OPEN:                       # complete: nothing more to read
            if before == COMPLETE and state == ENDED:
                found.append(Range(path, log_id, mtime, stop, stop, state, True, False))
            continue
        if stop <= at:
            continue
        step = stop - at if L.CODEC.search(path) else split
        for lo in range(at, stop, step):
            hi = min(lo + step, stop)
            found.append(Range(path, log_id, mtime, lo, hi, state, hi == stop and state != OPEN, True))
    return found


def line_start(f, at: int) -> int:
    """Where the line begins that holds byte ``at`` or begins there."""
    while at > 0:
        lo = max(0, at - L.READ)
        f.seek(lo)
        cut = f.read(at - lo).rfind(b"\n")
        if cut >= 0:
            return lo + cut + 1
        at = lo
    return 0


def lines_ending_in(f, size: int, start: int, stop: int, codec: str | None) -> Iterator[bytes]:
    """The lines of an open file whose ends lie in the bytes start … stop (a compressed one is whole)."""
    first = 0 if codec else line_start(f, start)
    f.seek(first)

    def pieces() -> Iterator[bytes]:
        left = min(stop, size) - first
        while left > 0:
            piece = f.read(min(L.READ, left))
            if not piece:
                return
            left -= len(piece)
            yield piece

    yield from L.lines_of(L.decoded(codec, pieces()), False, None, keep_last=stop > size)


class LogStreamReader(DataSourceStreamReader):
    def __init__(self, address: str, split: int):
        self.address, self.split, self.seen = address, split, {}

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        earlier = L.list_parts(self.address, 1 << 62)
        later = L.list_parts(self.address, 1 << 62)
        # A file that is being renamed may be missing from a listing: it keeps its place.
        now = offset_of(file_states(earlier), later)
        self.seen = {**self.seen, **{k: v for k, v in now.items() if v[:2] >= self.seen.get(k, [0, OPEN])[:2]}}
        return self.seen

    def partitions(self, start: dict, end: dict) -> list:
        top = L.file_system(self.address)[1].rstrip("/").rsplit("/", 1)[-1]

        def log_id(path: str) -> str:
            folder, name = path.rsplit("/", 1)
            return L.log_of(top, folder.rsplit("/", 1)[-1], name)

        return ranges_between(start, end, log_id, self.split)

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        name = part.path.rsplit("/", 1)[-1]
        columns = ["log_id", "file_name", "file_mtime_ms", "line", "status"]

        def rows(lines: list, status: str | None) -> pa.RecordBatch:
            n = len(lines)
            return pa.RecordBatch.from_arrays([pa.array([part.log_id] * n), pa.array([name] * n), pa.array([part.mtime_ms] * n, pa.int64()),
                                               pa.array(lines, pa.string()), pa.array([status] * n, pa.string())], names=columns)

        status, held, size = None, [], 0
        if part.reads:
            try:
                for line in self._lines(part):
                    if line.strip():
                        held.append(line.decode("utf-8", "replace"))
                        size += len(line)
                        if size > L.BATCH_BYTES:
                            yield rows(held, None)
                            held, size = [], 0
            except L.Broken as broken:
                status = broken.args[0]
            except OSError:
                status = "unreadable"
            if held:
                yield rows(held, None)
            if status or part.closes:
                yield rows([None], status or ("whole" if part.state == ENDED else "open"))
        if part.closes and part.state == ENDED:
            yield rows([None], ENDED_ROW)

    def _lines(self, part: Range) -> Iterator[bytes]:
        fs, _ = L.file_system(self.address)
        codec = L.CODEC.search(part.path)
        try:
            f = fs.open_input_file(part.path)
        except FileNotFoundError:
            f = fs.open_input_file(part.path + ".inprogress")
        with f:
            # What a later batch will read is left alone; a complete file has its final size.
            size = part.stop if part.state == OPEN else f.size()
            yield from lines_ending_in(f, size, part.start, part.stop, codec[1] if codec else None)


class EventLogStream(DataSource):
    """Options: ``path`` (the folder), ``split`` (bytes per range of a plain file)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return L.SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return LogStreamReader(self.options["path"], int(self.options.get("split", L.SPLIT)))

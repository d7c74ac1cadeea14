"""A stream of lines from files that are still being written."""

from __future__ import annotations

import fnmatch
import json
import posixpath
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

LINES = "path string, offset long, line string"
_CHUNK = 1 << 20


@dataclass
class Span(InputPartition):
    """Lines of a file that begin in ``[start, stop)``; the last may end behind ``stop``, but not behind ``end``."""

    path: str
    first: int
    start: int
    stop: int
    end: int


def _last_line_end(store: fs.FileSystem, path: str, low: int, high: int) -> int:
    """The position behind the last line end in ``[low, high)``; ``low`` if there is none. Reads backwards."""
    with store.open_input_file(path) as f:
        at = high
        while at > low:
            begin = max(low, at - _CHUNK)
            cut = f.read_at(at - begin, begin).rfind(b"\n")
            if cut >= 0:
                return begin + cut + 1
            at = begin
    return low


def _next_line_end(store: fs.FileSystem, path: str, low: int, high: int) -> int:
    """The position behind the first line end in ``[low, high)``; ``high`` if there is none."""
    with store.open_input_file(path) as f:
        at = low
        while at < high:
            part = f.read_at(min(_CHUNK, high - at), at)
            cut = part.find(b"\n")
            if cut >= 0:
                return at + cut + 1
            at += len(part)
    return high


class GrowingLinesReader(DataSourceStreamReader):
    """Offsets are bytes per file, always behind a line end, so a half line waits for its rest."""

    def __init__(self, options: dict):
        options = {k.lower(): v for k, v in options.items()}
        self.store, self.root = fs.FileSystem.from_uri(options["path"])
        self.pattern = options.get("pathglobfilter", "*")
        self.split = int(options.get("splitbytes", 64 << 20))
        self.most = int(options.get("maxbytespertrigger", 0))
        self.positions = options.get("positions")
        if self.most and not self.positions:
            raise ValueError("maxBytesPerTrigger needs a 'positions' file, which tells a restarted stream where it stands")
        self.known: dict[str, int] = {}
        if self.positions:
            at, path = fs.FileSystem.from_uri(self.positions)
            if at.get_file_info(path).type == fs.FileType.File:
                with at.open_input_file(path) as f:
                    self.known = json.loads(f.read())["files"]

    def _sizes(self) -> dict[str, int]:
        info = self.store.get_file_info(self.root)
        if info.type == fs.FileType.File:
            return {info.path: info.size}
        found = self.store.get_file_info(fs.FileSelector(self.root, recursive=True, allow_not_found=True))
        hidden = lambda p: any(x[:1] in ("_", ".") for x in p[len(self.root):].strip("/").split("/"))
        return {f.path: f.size for f in found if f.type == fs.FileType.File and not hidden(f.path) and fnmatch.fnmatch(posixpath.basename(f.path), self.pattern)}

    def initialOffset(self) -> dict:
        self.known = {}
        return {"files": {}}

    def latestOffset(self) -> dict:
        left, out = self.most, {}
        for path, size in sorted(self._sizes().items()):
            low = self.known.get(path, 0)
            low = low if low <= size else 0  # shorter than before: written anew
            high = size if not self.most else min(size, low + max(0, left))
            end = _last_line_end(self.store, path, low, high) if high > low else low
            if end == low and low < high < size:  # the first line alone is longer than what is left
                end = _next_line_end(self.store, path, high, size)
                end = _last_line_end(self.store, path, low, end)
            left -= end - low
            if end or path in self.known:
                out[path] = end
        return {"files": out}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self.known = dict(end["files"])
        if self.positions:  # written when a batch is planned: a restart plans it again or goes on from its end
            at, path = fs.FileSystem.from_uri(self.positions)
            at.create_dir(posixpath.dirname(path), recursive=True)
            with at.open_output_stream(path + ".new") as f:
                f.write(json.dumps(end).encode())
            at.move(path + ".new", path)
        spans: list[InputPartition] = []
        for path, stop in sorted(end["files"].items()):
            low = start["files"].get(path, 0)
            low = low if low <= stop else 0
            spans += [Span(path, low, at, min(stop, at + self.split), stop) for at in range(low, stop, self.split)]
        return spans

    def read(self, partition: Span) -> Iterator[pa.RecordBatch]:
        p = partition
        at = p.start if p.start == p.first else _next_line_end(self.store, p.path, p.start - 1, p.end)
        rest = b""
        with self.store.open_input_file(p.path) as f:
            f.seek(at + len(rest))
            while at < p.stop:
                part = f.read(min(_CHUNK, p.end - at - len(rest)))
                if not part:
                    break
                lines = (rest + part).split(b"\n")
                rest = lines.pop()
                offsets = []
                for line in lines:
                    offsets.append(at)
                    at += len(line) + 1
                keep = sum(o < p.stop for o in offsets)
                texts = [x.removesuffix(b"\r").decode("utf-8", "replace") for x in lines[:keep]]
                yield pa.RecordBatch.from_arrays([pa.array([p.path] * keep, pa.string()), pa.array(offsets[:keep], pa.int64()), pa.array(texts, pa.string())],
                                                 names=["path", "offset", "line"])


class GrowingLines(DataSource):
    """Format ``growing_lines``: options ``path`` (a file or folder, local or a URI that pyarrow opens), ``pathGlobFilter``,
    ``splitBytes`` (of one task), ``maxBytesPerTrigger`` with ``positions``."""

    @classmethod
    def name(cls) -> str:
        return "growing_lines"

    def schema(self) -> str:
        return LINES

    def streamReader(self, schema) -> GrowingLinesReader:
        return GrowingLinesReader(dict(self.options))


def tail_lines(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """``path, offset, line``: every line once, as soon as its line end is written, also of files that go on growing.

    The offset is the byte at which the line begins. Bytes that are no UTF-8 become replacement characters; a carriage
    return before the line end is dropped; names that begin with ``_`` or ``.`` are passed over. Every executor must reach
    the files. A file that is shorter than before is read again from its beginning; one that was replaced by a longer one
    cannot be told from one that has grown.
    """
    spark.dataSource.register(GrowingLines)
    return spark.readStream.format("growing_lines").options(path=path, **options).load()

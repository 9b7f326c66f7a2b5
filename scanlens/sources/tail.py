"""Growing log files as a stream: offsets are byte positions, so appended lines are seen.

Spark's own file stream reads a file once, when it appears.  This source remembers how far
each file has been read; every micro-batch reads what was appended since.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

SCHEMA = "file string, position long, line string"
#: Bytes of one task; longer stretches of a file are cut at line ends.
SPLIT_BYTES = 64 << 20
#: Bytes read at a time, and lines of an Arrow batch.
BLOCK_BYTES = 1 << 20
BATCH_LINES = 10_000


def open_store(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path for a URI or an absolute path."""
    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path[5:]
    return pafs.FileSystem.from_uri(path)


def log_files(store: pafs.FileSystem, root: str, suffix: str) -> dict[str, int]:
    """Sizes of the log files: ``root`` itself, or the files in it that end in ``suffix``; hidden ones are left out."""
    info = store.get_file_info(root)
    if info.type == pafs.FileType.File:
        return {root: info.size}
    if info.type == pafs.FileType.NotFound:
        return {}
    found = store.get_file_info(pafs.FileSelector(root))
    return {i.path: i.size for i in found if i.type == pafs.FileType.File and i.base_name.endswith(suffix) and i.base_name[:1] not in "._"}


def whole_lines(store: pafs.FileSystem, path: str, size: int) -> int:
    """End of the last whole line among the first ``size`` bytes; a line still being written waits."""
    with store.open_input_file(path) as log:
        end = size
        while end > 0:
            start = max(0, end - BLOCK_BYTES)
            at = log.read_at(end - start, start).rfind(b"\n")
            if at >= 0:
                return start + at + 1
            end = start
    return 0


@dataclass
class Stretch(InputPartition):
    """The lines of a file that begin in ``[begin, end)``; ``limit`` ends the last whole line, ``whole`` says that a line begins at ``begin``."""

    file: str
    begin: int
    end: int
    limit: int
    whole: bool

    def __post_init__(self) -> None:
        self.value = None  # InputPartition's own field


def lines_of(store: pafs.FileSystem, part: Stretch) -> Iterator[tuple[int, bytes]]:
    """``(position, line)`` without line ends.

    A stretch that may begin inside a line starts one byte early and skips to the first
    line end, so a line belongs to the stretch that holds its first byte.
    """
    at = part.begin if part.whole else part.begin - 1
    skip = not part.whole
    with store.open_input_file(part.file) as log:
        read, rest = at, b""
        while at < part.end and read < part.limit:
            block = log.read_at(min(BLOCK_BYTES, part.limit - read), read)
            if not block:
                return  # cut while being read
            read += len(block)
            *whole, rest = (rest + block).split(b"\n")
            for line in whole:
                if at >= part.end:
                    return
                if not skip:
                    yield at, line
                skip = False
                at += len(line) + 1


class _TailReader(DataSourceStreamReader):
    def __init__(self, options) -> None:
        if not options.get("path"):
            raise ValueError("log_tail needs a path")
        self.path, self.suffix = options["path"], options.get("suffix", "")
        self.split = int(options.get("splitBytes", SPLIT_BYTES))
        self.from_end = options.get("startingAt", "start") == "end"

    def _ends(self) -> dict[str, int]:
        store, root = open_store(self.path)
        return {f: whole_lines(store, f, size) for f, size in sorted(log_files(store, root, self.suffix).items())}

    def initialOffset(self) -> dict:
        return self._ends() if self.from_end else {}

    def latestOffset(self) -> dict:
        return self._ends()

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        parts = []
        for file, limit in end.items():
            begin = start.get(file, 0)
            if begin > limit:  # cut or replaced by a shorter file
                begin = 0
            for at in range(begin, limit, self.split):
                parts.append(Stretch(file, at, min(at + self.split, limit), limit, at == begin))
        return parts

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        store, _ = open_store(self.path)
        places: list[int] = []
        texts: list[str] = []
        for at, line in lines_of(store, partition):
            if text := line.rstrip(b"\r").decode("utf-8", "replace"):
                places.append(at)
                texts.append(text)
            if len(places) >= BATCH_LINES:
                yield self._batch(partition.file, places, texts)
                places, texts = [], []
        if places:
            yield self._batch(partition.file, places, texts)

    @staticmethod
    def _batch(file: str, places: list[int], texts: list[str]) -> pa.RecordBatch:
        columns = [pa.array([file] * len(places)), pa.array(places, pa.int64()), pa.array(texts)]
        return pa.RecordBatch.from_arrays(columns, names=["file", "position", "line"])


class LogTail(DataSource):
    """``spark.readStream.format("log_tail")``: lines of a growing file, or of the files of a folder.

    Options: ``path``; ``suffix`` of the files in a folder; ``startingAt`` ``start`` or ``end``;
    ``splitBytes`` of a task.  ``file`` and ``position`` name a line once and for all.  Blank
    lines are skipped, a last line without its line end waits for it.  A file that became
    shorter is read anew from its start; one that vanished is forgotten.  An absent path
    is empty until it appears.
    """

    @classmethod
    def name(cls) -> str:
        return "log_tail"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _TailReader(self.options)

"""Landed JSON lines as a stream whose micro-batches end by count or time.

Spark's file sources bound a micro-batch by files or bytes.  This data source
counts messages: a micro-batch ends at ``max_messages``, or ``max_seconds``
after its first message was there, whichever comes first.  An offset is a place
in the landed files, (file number, byte), so a batch can end within a file and
the next one goes on there.

Of a backlog, a trigger takes as many full micro-batches as are there, up to
``max_batches`` and ``max_bytes`` and at most twice as many as the trigger
before it (the first: one); tasks read them side by side.  Each row has
the place of its micro-batch in the column ``part``: added to the trigger's
number it is the micro-batch's own.  For that an offset also keeps how many
micro-batches there were so far beyond one for each trigger (``extra``), and
the bound by which its trigger was cut (``messages``): planned again after a
restart, by whatever settings, a trigger has the same micro-batches.

Files get their numbers in the order in which they are found, kept in a log
beside the checkpoint (one small file each), so an offset means the same after
a restart however names and times of files compare.  The place that was planned
last is kept there too.  The driver's side reads only as far as the next batch
reaches; the messages themselves are read by the tasks.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from stratum.sources.files import _Arrow

NAME = "landed_lines"
_READ = 1 << 20
#: A trigger's micro-batches are dealt to about so many tasks.
_TASKS = 64


class LinesOf(InputPartition):
    """Whole lines: pieces (file, first byte, byte behind the last, part)."""

    def __init__(self, pieces: list[tuple[str, int, int, int]]):
        self.pieces = pieces


class LandedLines(DataSource):
    """Options: ``path`` (the landing folder, with subfolders), ``log`` (where
    file numbers and the place are kept), ``max_messages``, ``max_seconds``,
    ``max_batches`` and ``max_bytes`` (of a trigger), ``task_bytes`` (a task
    reads about so much at most)."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return "value string, part long"

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return LandedReader(self.options)


class LandedReader(DataSourceStreamReader):
    def __init__(self, options):
        self.landing, self.log = options["path"].rstrip("/"), options["log"].rstrip("/")
        self.max_messages = int(options.get("max_messages", "500"))
        self.max_seconds = float(options.get("max_seconds", "60"))
        self.max_batches = int(options.get("max_batches", "1"))
        self.max_bytes = int(options.get("max_bytes", str(1 << 30)))
        self.task_bytes = int(options.get("task_bytes", str(8 << 20)))
        self.found: list[str] = []  # by file number
        self.at: dict | None = None  # the end of the last trigger
        self.batches = 0  # in the last trigger
        self.planned: tuple[dict, list[dict]] | None = None  # its start, and where its micro-batches end
        self.waiting_since: float | None = None
        self.clock = time.monotonic

    # --- the log ---------------------------------------------------------

    def _files(self) -> _Arrow:
        return _Arrow(self.landing)

    def _logged(self) -> _Arrow:
        return _Arrow(self.log)

    def _write(self, name: str, text: str) -> None:
        """Replace a file of the log by one that is written whole."""
        log, passing = self._logged(), f"{self.log}/.{name.replace('/', '-')}-{uuid.uuid4().hex}"
        log.write(passing, text.encode())
        log.replace(passing, f"{self.log}/{name}")

    def _discover(self) -> None:
        """Number the files that have landed since: names of one look in
        alphabetical order behind those of earlier ones."""
        log = self._logged()
        if not self.found:
            for name in sorted(n for n in log.names(f"{self.log}/files") if not n.startswith(".")):
                self.found.append(log.read(f"{self.log}/files/{name}").decode())
        known = set(self.found)
        for path in sorted(self._files().files_below(self.landing)):
            if path not in known:
                self._write(f"files/{len(self.found):012d}", path)
                self.found.append(path)

    # --- offsets ---------------------------------------------------------

    def initialOffset(self) -> dict:
        return {"file": 0, "byte": 0}

    def _place(self) -> dict:
        if self.at is None:
            kept = self._logged().read(f"{self.log}/place")
            self.at = json.loads(kept) if kept else self.initialOffset()
        return self.at

    def _ahead(self, start: dict, messages: int, batches: int, size_limit: float) -> tuple[list[dict], dict | None]:
        """Where the next full micro-batches end, as many as the bounds allow;
        and the end of what has landed if lines are left there for one more."""
        ends, n, taken, number, byte = [], 0, 0, start["file"], start["byte"]
        while number < len(self.found):
            with self._files().fs.open_input_file(self._files()._path(self.found[number])) as f:
                size = f.size()
                while byte < size:
                    part = f.read_at(min(_READ, size - byte), byte)
                    lines = np.flatnonzero(np.frombuffer(part, np.uint8) == 10) + 1
                    if byte + len(part) == size and not part.endswith(b"\n"):  # a last line without its line feed
                        lines = np.append(lines, len(part))
                    for at in lines[messages - n - 1::messages].tolist():
                        ends.append({"file": number, "byte": byte + at})
                        if len(ends) == batches or taken + at >= size_limit:
                            return ends, None
                    n, byte, taken = (n + len(lines)) % messages, byte + len(part), taken + len(part)
            number, byte = number + 1, 0
        return ends, {"file": number, "byte": 0} if n else None

    def latestOffset(self) -> dict:
        start = self._place()
        self._discover()
        most = max(1, min(2 * self.batches, self.max_batches))
        ends, rest = self._ahead(start, self.max_messages, most, self.max_bytes)
        if not ends and rest is None:
            self.waiting_since = None
            return start
        now = self.clock()
        if self.waiting_since is None:
            self.waiting_since = now
        if not ends:
            if now - self.waiting_since < self.max_seconds:
                return start
            ends = [rest]
        end, extra = dict(ends[-1]), start.get("extra", 0) + len(ends) - 1
        if extra:
            end["extra"] = extra
        if len(ends) > 1:
            end["messages"] = self.max_messages
        self.at, self.waiting_since, self.planned, self.batches = end, None, (start, ends), len(ends)
        return end

    def _ends(self, start: dict, end: dict) -> list[dict]:
        """Where the micro-batches of a planned trigger end."""
        if self.planned is not None and self.planned[0] == start and self.at == end:
            return self.planned[1]
        if "messages" not in end:
            return [end]
        batches = end["extra"] - start.get("extra", 0) + 1
        return self._ahead(start, end["messages"], batches, float("inf"))[0]

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        """Planned again after a restart, the same places give the same lines."""
        if not self.found or end["file"] >= len(self.found):
            self._discover()
        self._write("place", json.dumps(end))
        ends = self._ends(start, end)
        if self.at is None or (end["file"], end["byte"]) > (self.at["file"], self.at["byte"]):
            self.at = end
        pieces, files, sizes = [], self._files(), {}
        for part, (a, b) in enumerate(zip([start, *ends], ends), start.get("extra", 0)):
            for number in range(a["file"], min(b["file"] + 1, len(self.found))):
                path = self.found[number]
                begin = a["byte"] if number == a["file"] else 0
                if number != b["file"] and number not in sizes:
                    sizes[number] = files.size(path)
                size = b["byte"] if number == b["file"] else sizes[number]
                while begin < size:
                    stop = min(begin + self.task_bytes, size)
                    if stop < size:  # up to the end of a line
                        with files.fs.open_input_file(files._path(path)) as f:
                            while stop < size and f.read_at(1, stop - 1) != b"\n":
                                near = f.read_at(min(_READ, size - stop), stop).find(b"\n")
                                stop = stop + near + 1 if near >= 0 else min(stop + _READ, size)
                    pieces.append((path, begin, stop, part))
                    begin = stop
        return [LinesOf(p) for p in self._tasks(pieces)]

    def _tasks(self, pieces: list[tuple[str, int, int, int]]) -> list[list[tuple[str, int, int, int]]]:
        """Small pieces share a task: about ``_TASKS`` tasks, of 1 MB or more."""
        total = sum(stop - begin for _, begin, stop, _ in pieces)
        most = min(self.task_bytes, max(_READ, total // _TASKS))
        out, size = [], 0
        for p in pieces:
            if not out or size + p[2] - p[1] > most:
                out.append([])
                size = 0
            out[-1].append(p)
            size += p[2] - p[1]
        return out

    def read(self, partition: LinesOf) -> Iterator[pa.RecordBatch]:
        for path, start, stop, part in partition.pieces:
            files = _Arrow(path)
            with files.fs.open_input_file(files._path(path)) as f:
                data = f.read_at(stop - start, start)
            lines = data.split(b"\n")
            if not lines[-1]:
                lines.pop()
            text = [line.removesuffix(b"\r").decode("utf-8", "replace") for line in lines]
            yield pa.RecordBatch.from_arrays([pa.array(text, pa.string()), pa.array([part] * len(text), pa.int64())],
                                             ["value", "part"])

    def commit(self, end: dict) -> None:
        """The place is kept when a batch is planned."""

"""JSON array files read by many tasks: a data source of byte ranges.

A range that starts inside an array file cannot know whether it is in a string or
how deep it is. Two passes settle that. The first sums up every range as a
function of its start: whether its quotes turn inside to outside, and by how much
its brackets raise the depth if it starts outside of a string or inside. Such
functions compose, so the few numbers of each range give the start of all. In the
second pass every range yields the elements whose opening bracket or comma it
holds, reading on past its end for the last one.

Only borders are found here; Spark parses the elements. Files must be UTF-8.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Bytes of a range, of a block read at once, and of the longest element.
RANGE_BYTES, BLOCK_BYTES, LONGEST = 64 << 20, 4 << 20, 256 << 20
LEAST_BLOCK = 4 << 10
#: Short ranges of all files together, but for one more a file: where there would be more they are
#: made longer, up to RANGE_BYTES, so that a task has more to do than to start.
MOST_RANGES = 256
#: Elements handed to Spark at once, by their bytes.
BATCH_BYTES = 4 << 20

QUOTE, SLASH, COMMA = ord('"'), ord("\\"), ord(",")
SIGN = np.zeros(256, np.int64)
SIGN[list(b"[{")], SIGN[list(b"]}")] = 1, -1
MARKED = SIGN != 0
MARKED[[QUOTE, SLASH, COMMA]] = True
SPACE = b" \t\r\n"
BOM = b"\xef\xbb\xbf"

SUMMARY = "path string, start long, flips boolean, outside long, inside long, is_array boolean"
ELEMENTS = "path string, position long, element string"


class State(NamedTuple):
    """Where an automaton stands: inside a string or not, and how many brackets are open."""

    in_string: bool = False
    depth: int = 0


@dataclass(frozen=True)
class Summary:
    """What a range does to any state: the quotes' parity, and the depth gained from either start."""

    flips: bool
    outside: int
    inside: int

    def after(self, state: State) -> State:
        return State(state.in_string ^ self.flips, state.depth + (self.inside if state.in_string else self.outside))

    def then(self, later: Summary) -> Summary:
        """One function for two neighbouring ranges."""
        a, b = (later.inside, later.outside) if self.flips else (later.outside, later.inside)
        return Summary(self.flips ^ later.flips, self.outside + a, self.inside + b)


def marks(block: bytes, escaped: bool) -> tuple[np.ndarray, np.ndarray, bool]:
    """Positions and bytes of quotes, brackets and commas; whether the byte after the block is escaped.

    Escaped quotes are left out. A byte is escaped if an odd number of backslashes
    ends just before it; ``escaped`` says so for the first one.
    """
    data = np.frombuffer(block, np.uint8)
    at = np.flatnonzero(MARKED[data])
    kinds = data[at]
    slashes = at[kinds == SLASH]
    hidden = [0] if escaped and not (len(slashes) and slashes[0] == 0) else []
    pending = False
    if len(slashes):
        first = np.concatenate([[True], np.diff(slashes) != 1])
        length = np.bincount(np.cumsum(first) - 1)
        start = slashes[first]
        odd = (length + (escaped & (start == 0))) % 2 == 1
        ends = (start + length)[odd]
        pending = bool(len(ends)) and int(ends[-1]) == len(data)
        hidden = np.concatenate([hidden, ends]).astype(np.int64)
    shown = kinds != SLASH
    if len(hidden):
        shown &= ~((kinds == QUOTE) & np.isin(at, hidden))
    return at[shown], kinds[shown], pending if len(data) else escaped


def summarize(blocks: Iterator[bytes], escaped: bool) -> Summary:
    flips, outside, inside = False, 0, 0
    for block in blocks:
        _, kinds, escaped = marks(block, escaped)
        quotes = kinds == QUOTE
        odd = (np.cumsum(quotes) + flips) % 2 == 1
        sign = SIGN[kinds]
        inside += int(sign[odd].sum())
        outside += int(sign[~odd].sum())
        flips ^= bool(quotes.sum() % 2)
    return Summary(flips, outside, inside)


def split_elements(
    blocks: Iterator[tuple[int, bytes]], end: int, state: State, escaped: bool, longest: int = LONGEST
) -> Iterator[tuple[int, bytes]]:
    """Position and text of every element whose opening bracket or comma lies before ``end``.

    ``blocks`` are (position, bytes) from the range's start to the end of the file;
    reading stops with the last element. What is not closed when the file ends is
    an element too, and so is nothing between two commas. ``[]`` has no element.
    """
    in_string, depth = state
    pieces: list[bytes] = []
    begun: int | None = None
    opened = size = 0
    for base, block in blocks:
        at, kinds, escaped = marks(block, escaped)
        quotes = kinds == QUOTE
        outside = ((np.cumsum(quotes) + in_string) % 2 == 0) & ~quotes
        in_string ^= bool(quotes.sum() % 2)
        at, kinds = at[outside], kinds[outside]
        sign = SIGN[kinds]
        after = depth + np.cumsum(sign)
        before = after - sign
        depth = int(after[-1]) if len(after) else depth
        border = ((kinds == COMMA) & (before == 1)) | ((before == 0) & (sign > 0)) | ((before == 1) & (sign < 0))
        taken = 0
        for place, kind, rise in zip(at[border].tolist(), kinds[border].tolist(), sign[border].tolist()):
            if begun is not None:
                pieces.append(block[taken:place])
                text = b"".join(pieces).strip(SPACE)
                # A closing bracket right after the opening one closes an empty array.
                if text or rise == 0 or not opened:
                    yield begun, text
            pieces, size, begun, taken = [], 0, None, place + 1
            if base + place >= end:
                return
            if rise >= 0:
                begun, opened = base + place + 1, rise
        if begun is not None:
            pieces.append(block[taken:])
            size += len(block) - taken
            if size > longest:
                raise ValueError(f"the element at byte {begun} is longer than {longest} bytes")
        elif base + len(block) >= end:
            return
    if begun is not None:
        yield begun, b"".join(pieces).strip(SPACE)


def open_file(path: str) -> pa.NativeFile:
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem().open_input_file("/" + path[5:].lstrip("/"))
    if "://" not in path:
        return fs.LocalFileSystem().open_input_file(path)
    system, name = fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", path))
    return system.open_input_file(name)


def read_blocks(file: pa.NativeFile, start: int, end: int, block: int = BLOCK_BYTES) -> Iterator[tuple[int, bytes]]:
    for at in range(start, end, block):
        yield at, file.read_at(min(block, end - at), at)


def escaped_at(file: pa.NativeFile, start: int, step: int = 1024) -> bool:
    """Whether the byte at ``start`` is escaped: backslashes are counted back from it."""
    count, at = 0, start
    while at:
        low = max(at - step, 0)
        before = file.read_at(at - low, low)
        run = len(before) - len(before.rstrip(b"\\"))
        count += run
        if run < len(before):
            break
        at = low
    return count % 2 == 1


def is_array(head: bytes) -> bool:
    return head.removeprefix(BOM).lstrip(SPACE).startswith(b"[")


@dataclass
class Range(InputPartition):
    """Bytes of a file, and the state at their start. An ``end`` of -1 stands for a file that is one record."""

    path: str
    start: int
    end: int
    size: int
    in_string: bool = False
    depth: int = 0


class RangeReader(DataSourceReader):
    """``files`` gives path and size; ``states`` the starts of a file's ranges, where they are known."""

    def __init__(self, options: dict[str, str]) -> None:
        self.files = json.loads(options["files"])
        self.states = json.loads(options.get("states", "{}"))
        self.step = int(options.get("rangebytes", RANGE_BYTES))
        self.summary = options.get("mode") == "summary"

    def partitions(self) -> list[Range]:
        found = []
        for path, size in self.files.items():
            if self.states.get(path) == "record":
                found.append(Range(path, 0, -1, size))
                continue
            known = self.states.get(path) or []
            for number, start in enumerate(range(0, size, self.step)):
                state = State(*known[number]) if number < len(known) else State()
                found.append(Range(path, start, min(start + self.step, size), size, *state))
        return found

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        with open_file(partition.path) as file:
            yield from self._summary(file, partition) if self.summary else self._elements(file, partition)

    def _summary(self, file: pa.NativeFile, part: Range) -> Iterator[pa.RecordBatch]:
        blocks = (block for _, block in read_blocks(file, part.start, part.end))
        found = summarize(blocks, escaped_at(file, part.start))
        array = part.start > 0 or is_array(file.read_at(min(part.size, 1 << 16), 0))
        columns = [[part.path], [part.start], [found.flips], [found.outside], [found.inside], [array]]
        kinds = [pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.bool_()]
        names = ["path", "start", "flips", "outside", "inside", "is_array"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    def _elements(self, file: pa.NativeFile, part: Range) -> Iterator[pa.RecordBatch]:
        if part.end < 0 or (part.start == 0 and not is_array(file.read_at(min(part.size, 1 << 16), 0))):
            text = file.read_at(part.size, 0).removeprefix(BOM).strip(SPACE)
            found = iter([(0, text)] if text else [])
        else:
            # Hardly more than the range: its last element seldom ends far behind it.
            block = min(BLOCK_BYTES, max(part.end - part.start, LEAST_BLOCK))
            blocks = read_blocks(file, part.start, part.size, block)
            state = State(part.in_string, part.depth)
            found = split_elements(blocks, part.end, state, escaped_at(file, part.start))
        rows, size = [], 0
        for position, text in found:
            rows.append((position, text.decode("utf-8", "replace")))
            size += len(text)
            if size >= BATCH_BYTES:
                yield self._batch(part.path, rows)
                rows, size = [], 0
        if rows:
            yield self._batch(part.path, rows)

    @staticmethod
    def _batch(path: str, rows: list[tuple[int, str]]) -> pa.RecordBatch:
        positions, texts = zip(*rows)
        columns = [pa.array([path] * len(rows)), pa.array(positions, pa.int64()), pa.array(texts, pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["path", "position", "element"])


class JsonArraySource(DataSource):
    """``json_array``: the elements of array files, or summaries of their ranges."""

    @classmethod
    def name(cls) -> str:
        return "json_array"

    def schema(self) -> str:
        return SUMMARY if self.options.get("mode") == "summary" else ELEMENTS

    def reader(self, schema: T.StructType) -> RangeReader:
        return RangeReader(dict(self.options))


def range_states(summaries: list) -> dict[str, list[State] | str]:
    """The state at the start of each range by file; ``record`` for files that are no array."""
    found: dict[str, list[State] | str] = {}
    state = State()
    for row in sorted(summaries, key=lambda r: (r["path"], r["start"])):
        if row["start"] == 0:
            state = State()
            found[row["path"]] = [] if row["is_array"] else "record"
        if found[row["path"]] != "record":
            found[row["path"]].append(state)
            state = Summary(row["flips"], row["outside"], row["inside"]).after(state)
    return found


def read_elements(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``path``, ``position`` (byte) and ``element`` (text) of all array files below ``path``.

    Files up to one range are read once, longer ones twice. What reaches the driver
    is the file listing and four numbers per range. A file that is no array is one
    element, so it is one task. Ranges are longer than ``range_bytes`` (up to
    ``RANGE_BYTES``) where there would be more than ``MOST_RANGES``.
    """
    spark.dataSource.register(JsonArraySource)
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    files = {row["path"]: row["length"] for row in listed.select("path", "length").collect() if row["length"]}
    if not files:
        return spark.createDataFrame([], ELEMENTS)
    range_bytes = max(range_bytes, min(RANGE_BYTES, -(-sum(files.values()) // MOST_RANGES)))
    source = spark.read.format("json_array").option("rangeBytes", range_bytes)
    long = {name: size for name, size in files.items() if size > range_bytes}
    states: dict = {}
    if long:
        summaries = source.option("mode", "summary").option("files", json.dumps(long)).load().collect()
        states = range_states(summaries)
    return (
        spark.read.format("json_array")
        .option("rangeBytes", range_bytes)
        .option("files", json.dumps(files))
        .option("states", json.dumps(states))
        .load()
    )


def read_json_array(
    spark: SparkSession, path: str, schema: T.StructType, corrupt: str, range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """The elements as rows of ``schema`` with ``corrupt`` and ``raw_file``.

    An element that does not fit keeps what parsed and is whole in ``corrupt``, alone:
    its neighbours are read as ever. Only a bracket or quote too few or too many takes
    along what follows it, as its file has no borders from there on.
    """
    whole = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    parsed = F.from_json("element", whole, {"columnNameOfCorruptRecord": corrupt}).alias("row")
    rows = read_elements(spark, path, range_bytes).select(parsed, F.col("path").alias("raw_file"))
    return rows.select("row.*", "raw_file")

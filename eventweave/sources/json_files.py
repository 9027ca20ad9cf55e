"""JSON event files of any size, cut into elements by many tasks.

A file holds one array of events, one event, or events one after another, pretty-printed or not.
It is read as text with ``}`` as the line separator, which Spark splits by bytes like any text and
which bounds every record, line breaks or none. Cutting such a stream into elements needs to know,
where a split begins, whether it is inside a string and how deep it is. That takes two passes:

1. every split of a file that has several reports its bytes, the parity of its quotes, and how much
   the depth changes if it begins outside or inside a string (one small row a split); files
   that fit one split need no such pass;
2. with these added up, each split cuts out the elements that lie in it. An element that crosses
   splits leaves a piece in each; pieces (two a split at most) are put together in file order.

Both passes are numpy over Arrow batches and hold one batch and one unfinished element. A bad
element is a row of its own; the rest of the file is read on. Compressed files are one split.
Blank elements (as in ``[1,,2]`` or after a trailing comma) are no elements.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventweave.session import work_dir

_SIGNS = np.zeros(256, bool)
_SIGNS[list(b'[]{},"')] = True
_STEP = np.zeros(256, np.int64)
_STEP[list(b"[{")], _STEP[list(b"]}")] = 1, -1
_BLANK = b" \t\r\n\v\f\xef\xbb\xbf"

ELEMENT, HEAD, TAIL, MIDDLE = 0, 1, 2, 3


def _records(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", "}").text(path).select(
        F.col("value").cast("binary").alias("value"), F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"), F.col("_metadata.file_size").alias("size"))


def _joined(column: pa.Array) -> np.ndarray:
    """The records' bytes, a ``}`` after each."""
    column = column.cast(pa.large_binary())
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    ends = offsets[1:] - offsets[0] + np.arange(n)
    out = np.full(len(data) + n, 0x7D, np.uint8)
    own = np.ones(len(out), bool)
    own[ends] = False
    out[own] = data
    return out


def _signs(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(positions of structural characters, their bytes, quotes before each: escaped ones do not count)."""
    at = np.flatnonzero(_SIGNS[data])
    sign = data[at]
    quote = np.flatnonzero(sign == 0x22)
    behind = quote[(at[quote] > 0)]
    behind = behind[data[at[behind] - 1] == 0x5C]
    if len(behind):
        plain = np.maximum.accumulate(np.where(data == 0x5C, -1, np.arange(len(data))))     # last place without a backslash
        run = at[behind] - 1 - plain[at[behind] - 1]
        gone = behind[run % 2 == 1]
        keep = np.ones(len(at), bool)
        keep[gone] = False
        at, sign = at[keep], sign[keep]
    quotes = np.cumsum(sign == 0x22) - (sign == 0x22)
    return at, sign, quotes


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], int, pa.Array]]:
    """((file, start), file size, records) of the splits of a batch, in order."""
    file, start = (np.asarray(batch.column(c)) for c in ("file", "start"))
    edges = np.flatnonzero((file[1:] != file[:-1]) | (start[1:] != start[:-1])) + 1
    for a, b in zip([0, *edges], [*edges, len(file)]):
        if b > a:
            yield (int(file[a]), int(start[a])), int(batch.column("size")[int(a)].as_py()), batch.column("value").slice(int(a), int(b - a))


def _summaries(records: DataFrame) -> DataFrame:
    """One row a split: bytes with separators, quotes modulo two, depth changes, first visible byte."""
    def run(batches):
        have: dict[tuple[int, int], list] = {}          # the splits of this task
        for batch in batches:
            for key, size, values in _runs(batch):
                own = have.setdefault(key, [size, 0, 0, 0, 0, 0])
                data = _joined(values)
                at, sign, quotes = _signs(data)
                side = (quotes + own[2]) % 2
                step = _STEP[sign]
                own[1] += len(data)
                own[3] += int(step[side == 0].sum())
                own[4] += int(step[side == 1].sum())
                own[2] = (own[2] + int((sign == 0x22).sum())) % 2
                if not own[5]:
                    text = data[:64].tobytes().lstrip(_BLANK) or data.tobytes().lstrip(_BLANK)
                    own[5] = text[0] if text else 0
        rows = [(*k, *v) for k, v in have.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(8)],
                                         names=["file", "start", "size", "bytes", "quotes", "outside", "inside", "first"])

    return records.mapInArrow(run, "file long, start long, size long, bytes long, quotes long, outside long, inside long, first long")


@dataclass
class _State:
    """Where a split begins, and whether its last record got a separator that the file lacks (None:
    the split is a whole file and finds out by itself)."""
    inside: int = 0
    depth: int = 0
    array: bool | None = None
    added: bool | None = None


def _states(rows: list) -> dict[tuple[int, int], _State]:
    """The state of every split of files with several."""
    files: dict[int, list] = {}
    for r in sorted(rows, key=lambda r: (r["file"], r["start"])):
        files.setdefault(r["file"], []).append(r)
    out = {}
    for own in files.values():
        inside, depth = 0, 0
        first = next((r["first"] for r in own if r["first"]), 0)
        size = sum(r["bytes"] for r in own)
        for i, r in enumerate(own):
            out[r["file"], r["start"]] = _State(inside, depth, first == 0x5B, i == len(own) - 1 and size > r["size"])
            depth += r["inside"] if inside else r["outside"]
            inside = (inside + r["quotes"]) % 2
    return out


def _cut(data: np.ndarray, state: _State) -> list[bytes]:
    """The pieces between the elements' borders, all but the last closed by a border; ``state``
    moves on behind the bytes."""
    at, sign, quotes = _signs(data)
    outside = (quotes + state.inside) % 2 == 0
    state.inside = (state.inside + int((sign == 0x22).sum())) % 2
    outside &= sign != 0x22
    at, sign = at[outside], sign[outside]
    after = state.depth + np.cumsum(_STEP[sign])
    before = after - _STEP[sign]
    if state.array is None:
        text = data.tobytes().lstrip(_BLANK)
        state.array = text[0] == 0x5B if text else None
    if state.array:
        border = ((sign == 0x2C) & (after == 1)) | ((sign == 0x5B) & (before == 0)) | ((sign == 0x5D) & (after == 0))
        cuts = at[border]
        ends, begins = cuts, cuts + 1                   # the border is no part of an element
    else:
        border = ((sign == 0x7D) | (sign == 0x5D)) & (after == 0)
        ends = begins = at[border] + 1
    state.depth = int(after[-1]) if len(after) else state.depth
    raw = data.tobytes()
    return [raw[a:b] for a, b in zip([0, *begins.tolist()], [*ends.tolist(), len(raw)])]


class _Split:
    """One split on its way: rows (file, start, kind, value) come out of :meth:`add` and :meth:`close`.
    The last records are held back until it is known whether they end the split."""

    def __init__(self, key: tuple[int, int], size: int, state: _State):
        self.key, self.size, self.state = key, size, state
        self.rest: list[bytes] = []
        self.headed, self.held, self.bytes = False, None, 0

    def _take(self, pieces: list[bytes]) -> list[tuple]:
        out = []
        for p in pieces[:-1]:
            out.append((*self.key, ELEMENT if self.headed else HEAD, b"".join([*self.rest, p])))
            self.rest, self.headed = [], True
        self.rest.append(pieces[-1])
        return out

    def add(self, data: np.ndarray) -> list[tuple]:
        out = self._take(_cut(self.held, self.state)) if self.held is not None else []
        self.held, self.bytes = data, self.bytes + len(data)
        return out

    def close(self) -> list[tuple]:
        added = self.state.added
        if added is None:
            added = self.bytes == self.size + 1
            if not added and self.bytes != self.size:       # compressed: an element too many is closed
                end = replace(self.state)
                _cut(self.held, end)
                added = end.depth != 0 or end.inside != 0
        data = self.held[:-1] if added else self.held
        out = self._take(_cut(data, self.state))
        return [*out, (*self.key, TAIL if self.headed else MIDDLE, b"".join(self.rest))]


def _elements(records: DataFrame, states: dict) -> DataFrame:
    """(file, start, kind, value) of every element and of the pieces of those that cross splits."""
    shared = records.sparkSession.sparkContext.broadcast(states)       # one entry a split of files with several
    names = ["file", "start", "kind", "value"]

    def rows_of(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        rows = [r for r in rows if r[2] != ELEMENT or r[3].strip(_BLANK)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.binary()))], names=names)

    def run(batches):
        known, split = shared.value, None
        for batch in batches:
            for key, size, values in _runs(batch):
                if split is None or split.key != key:
                    if split is not None:
                        yield from rows_of(split.close())
                    split = _Split(key, size, replace(known[key]) if key in known else _State())
                yield from rows_of(split.add(_joined(values)))
        if split is not None:
            yield from rows_of(split.close())

    return records.select("value", "file", "start", "size").mapInArrow(run, "file long, start long, kind int, value binary")


def _stitched(pieces: DataFrame) -> DataFrame:
    """Elements put together from their pieces, file by file in the order of the splits."""
    def run(batches):
        file, held = None, []
        for batch in batches:
            out = []
            for f, kind, value in zip(*(batch.column(c).to_pylist() for c in ("file", "kind", "value"))):
                if f != file:
                    out.append(b"".join(held))
                    file, held = f, []
                held.append(value)
                if kind == HEAD:                # a border ends the element
                    out.append(b"".join(held))
                    held = []
            out = [v for v in out if v.strip(_BLANK)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])
        if held and b"".join(held).strip(_BLANK):
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], names=["value"])

    order = F.when(F.col("kind") == HEAD, 0).otherwise(1)
    return pieces.repartition("file").sortWithinPartitions("file", "start", order).select("file", "kind", "value").mapInArrow(run, "value binary")


def _several_splits(spark: SparkSession, path: str) -> bool:
    """Whether some file may have more than one split (sizes alone are asked for)."""
    least = min(_bytes_conf(spark, "spark.sql.files.maxPartitionBytes"), _bytes_conf(spark, "spark.sql.files.openCostInBytes"))
    largest = spark.read.format("binaryFile").load(path).agg(F.max("length")).first()[0]
    return (largest or 0) > least


def _bytes_conf(spark: SparkSession, key: str) -> int:
    text = spark.conf.get(key).strip().lower()
    units = {"k": 10, "kb": 10, "m": 20, "mb": 20, "g": 30, "gb": 30, "b": 0, "": 0}
    number = text.rstrip("kmgb")
    return int(number) << units[text[len(number):]]


def json_elements(spark: SparkSession, path: str) -> DataFrame:
    """``value``: the text of every element of the JSON files at ``path``."""
    records = _records(spark, path)
    crossing = (F.col("start") > 0) | (F.col("bytes") < F.col("size"))
    states = _states(_summaries(records).where(crossing).collect()) if _several_splits(spark, path) else {}       # a row a split
    found = _elements(records, states)
    if states:              # read twice: written once
        folder = work_dir(spark, "elements")
        found.write.parquet(folder)
        found = spark.read.schema(found.schema).parquet(folder)
        found = found.where(F.col("kind") == ELEMENT).select("value").unionByName(_stitched(found.where(F.col("kind") != ELEMENT)))
    text = F.regexp_replace(F.col("value").cast("string"), "^[\\s\ufeff]+|\\s+$", "")
    return found.select(text.alias("value")).where(F.col("value") != "")

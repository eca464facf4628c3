"""Packing documents' token ids into training sequences of a fixed length."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import written
from .library import byte_level
from .segments import balanced

LENGTH = 1024
END = 0
#: Windows that each partition keeps open.
OPEN = 16
#: Partitions whose leftovers are merged by one task.
FAN_IN = 256
WIDTH = 4


class Windows:
    """Bounded-space packing: pieces go to the fullest open window that still has room for them.

    If no window has room, the fullest one is topped up with the head of the piece, and emitted, full,
    and the tail goes to the new window in its place. So every emitted window is full; what is still
    open at the end is left over. A piece is ``(document, start, ids, document's tokens)`` with ids as bytes.
    """

    def __init__(self, length: int = LENGTH, n_open: int = OPEN):
        self.length, self.open = length, [[] for _ in range(n_open)]
        self.used = [0] * n_open

    def _emit(self, i: int) -> list[tuple]:
        pieces, self.open[i], self.used[i] = self.open[i], [], 0
        return pieces

    def _append(self, i: int, piece: tuple) -> None:
        self.open[i].append(piece)
        self.used[i] += len(piece[2]) // WIDTH

    def place(self, piece: tuple) -> Iterator[list[tuple]]:
        """Emitted windows, each a list of pieces in order."""
        document, start, ids, total = piece
        size, at = len(ids) // WIDTH, 0
        while size - at >= self.length:
            yield [(document, start + at, ids[at * WIDTH : (at + self.length) * WIDTH], total)]
            at += self.length
        start, ids, size = start + at, ids[at * WIDTH :], size - at
        if not size:
            return
        fits = [(used, i) for i, used in enumerate(self.used) if used + size <= self.length]
        if not fits:
            i = max(range(len(self.used)), key=self.used.__getitem__)
            room = self.length - self.used[i]
            self._append(i, (document, start, ids[: room * WIDTH], total))
            yield self._emit(i)
            self._append(i, (document, start + room, ids[room * WIDTH :], total))
            return
        i = max(fits)[1]
        self._append(i, (document, start, ids, total))
        if self.used[i] == self.length:
            yield self._emit(i)

    def left(self) -> Iterator[list[tuple]]:
        yield from (self._emit(i) for i, used in enumerate(self.used) if used)

    def joined(self) -> Iterator[list[tuple]]:
        """What is left over, cut freely: full windows, and one that may need padding."""
        window, room = [], self.length
        for document, start, ids, total in [p for pieces in self.left() for p in pieces]:
            while ids:
                part, ids = ids[: room * WIDTH], ids[room * WIDTH :]
                window.append((document, start, part, total))
                start, room = start + len(part) // WIDTH, room - len(part) // WIDTH
                if not room:
                    yield window
                    window, room = [], self.length
        if window:
            yield window


class _Rows:
    """Collects pieces and hands them out as Arrow batches of a moderate size."""

    def __init__(self, schema: pa.Schema, turn: int):
        # Numbers of sequences: the round, the task, and a count in the task.
        self.first = (turn << 58) + (TaskContext.get().partitionId() << 36)
        self.schema, self.count, self.rows, self.bytes = schema, 0, [], 0

    def add(self, pieces: list[tuple], left: bool) -> None:
        offset = 0
        for document, start, ids, total in pieces:
            size = len(ids) // WIDTH
            self.rows.append((document, start, size, total, self.first + self.count, offset, ids, left))
            offset += size
        self.bytes += offset * WIDTH
        self.count += 1

    def batch(self, least: int = 1 << 22) -> Iterator[pa.RecordBatch]:
        if self.rows and self.bytes >= least:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*self.rows), self.schema.types)], schema=self.schema)
            self.rows, self.bytes = [], 0


def pack(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text", length: int = LENGTH, n_open: int = OPEN) -> DataFrame:
    """Pieces of ``docs`` in sequences: the id, ``start, length, doc_tokens, sequence_id, offset, ids``.

    A document's ids are those of the library for the file ``path`` without special tokens around,
    then ``END``; they are cut where a window is full, and each id lies in one piece. ``ids`` holds a
    piece's ids as little-endian unsigned 32-bit integers. Every sequence is full except one at most. A
    NULL or empty text is the document of the one id ``END``; repeated rows are packed each; an empty
    table gives no rows; other columns are left out.

    Each partition packs its rows with ``n_open`` windows. The windows left over are merged by tasks that
    take those of ``FAN_IN`` partitions each, until one task has the last of them: it never gets more
    than ``FAN_IN * n_open`` windows.
    """
    kind = docs.schema[id].dataType
    schema = T.StructType(
        [T.StructField(id, kind)]
        + [T.StructField(n, T.LongType()) for n in ("start", "length", "doc_tokens", "sequence_id", "offset")]
        + [T.StructField("ids", T.BinaryType()), T.StructField("left_over", T.BooleanType())]
    )

    def arrow_schema(key: pa.DataType) -> pa.Schema:
        names = [(f.name, pa.int64()) for f in schema.fields[1:6]]
        return pa.schema([(id, key), *names, ("ids", pa.binary()), ("left_over", pa.bool_())])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows, out, end, library = Windows(length, n_open), None, np.uint32(END).astype("<u4").tobytes(), byte_level(path)
        for batch in batches:
            out = out or _Rows(arrow_schema(batch.schema.field(0).type), 0)
            for rows in balanced(batch, "text") if batch.num_rows else ():
                for document, text in zip(rows.column(0).to_pylist(), rows.column("text").to_pylist()):
                    ids = library.ids(text or "") + end
                    for pieces in windows.place((document, 0, ids, len(ids) // WIDTH)):
                        out.add(pieces, False)
                    yield from out.batch()
        for pieces in windows.left():
            out.add(pieces, True)
        if out:
            yield from out.batch(0)

    def merge(turn: int, last: bool):
        def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            windows, out = Windows(length, n_open), None
            for batch in batches:
                out = out or _Rows(arrow_schema(batch.schema.field(0).type), turn)
                for row in zip(*(batch.column(c).to_pylist() for c in (0, 1, 6, 3))):
                    for pieces in windows.place(row):
                        out.add(pieces, False)
                yield from out.batch()
            for pieces in windows.joined() if last else windows.left():
                out.add(pieces, not last)
            if out:
                yield from out.batch(0)

        return merged

    rows = docs.select(F.col(id).alias(id), F.col(text).alias("text"))
    pieces = written(rows.mapInArrow(first, schema), "pieces")
    done, turn = pieces.where("NOT left_over"), 0
    while True:
        left, turn = pieces.where("left_over"), turn + 1
        task = F.shiftright("sequence_id", 36).bitwiseAND(F.lit((1 << 22) - 1))
        tasks = left.agg(F.countDistinct(task)).first()[0]
        if not tasks:
            break
        groups = -(-tasks // FAN_IN)
        spread = left.coalesce(1) if groups == 1 else left.repartition(groups, F.pmod(F.xxhash64(task), F.lit(groups)))
        pieces = written(spread.mapInArrow(merge(turn, groups == 1), schema), "merged")
        done = done.unionByName(pieces.where("NOT left_over"))
    return done.drop("left_over")

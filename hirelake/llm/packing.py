"""Bounded-space online packing of documents into sequences of a fixed number of tokens.

Every task keeps a fixed number of open windows. A piece goes into the window it fits best; when it
fits into none, the fullest window takes the head of the piece, is full and is emitted, and the rest of
the piece goes on. What is left in the windows of all tasks is merged at the end.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm.common import some_rows, stored
from hirelake.llm.tokens import encoder, in_lots, vocabulary

WINDOW, OPEN_WINDOWS = 4096, 32
VOCABULARY, END_ID = "word_bpe_49k.json", 2
PIECES = "doc_id long, start long, doc_tokens long, ids binary, sequence_id long, offset long"
COLUMNS = [c.split()[0] for c in PIECES.split(", ")]
ROWS_AT_ONCE = 1 << 12
# Numbers of sequences: two bits for the round, 30 for the task, 31 for the sequence in the task.
TASK_BITS, ROUND_BITS = 31, 61
LEFTOVERS_MERGED = 64  # tasks whose leftovers are merged in one task, and it leaves less than a window


class Windows:
    """The open windows of one task. Pieces are (doc_id, start, doc_tokens, ids as bytes)."""

    def __init__(self, window: int, most_open: int, first_id: int):
        self.window, self.most_open, self.next_id = window, most_open, first_id
        self.open: list[tuple[int, list]] = []  # tokens left, pieces
        self.emitted: list[tuple] = []

    def emit(self, pieces: list) -> None:
        offset = 0
        for doc_id, start, doc_tokens, ids in pieces:
            self.emitted.append((doc_id, start, doc_tokens, ids, self.next_id, offset))
            offset += len(ids) // 4
        self.next_id += 1

    def place(self, doc_id: int | None, start: int, doc_tokens: int, ids: bytes) -> None:
        while len(ids) >= 4 * self.window:  # a window of its own
            self.emit([(doc_id, start, doc_tokens, ids[: 4 * self.window])])
            ids, start = ids[4 * self.window :], start + self.window
        while ids:
            length = len(ids) // 4
            fitting = [(left, k) for k, (left, _) in enumerate(self.open) if left >= length]
            if fitting:
                left, k = min(fitting)
                pieces = self.open[k][1]
                pieces.append((doc_id, start, doc_tokens, ids))
                if left == length:
                    self.emit(pieces)
                    del self.open[k]
                else:
                    self.open[k] = (left - length, pieces)
                return
            if len(self.open) < self.most_open:
                self.open.append((self.window - length, [(doc_id, start, doc_tokens, ids)]))
                return
            left, k = min((left, k) for k, (left, _) in enumerate(self.open))
            self.emit([*self.open[k][1], (doc_id, start, doc_tokens, ids[: 4 * left])])
            del self.open[k]
            ids, start = ids[4 * left :], start + left

    def close(self) -> list:
        """Merges the open windows; what is left is less than one window."""
        pieces = [p for _, held in sorted(self.open, key=lambda w: w[0]) for p in held]
        self.open = []
        one, left = [], self.window
        for doc_id, start, doc_tokens, ids in pieces:
            while ids:
                head = ids[: 4 * left]
                one.append((doc_id, start, doc_tokens, head))
                taken = len(head) // 4
                left, start, ids = left - taken, start + taken, ids[4 * left :]
                if not left:
                    self.emit(one)
                    one, left = [], self.window
        return one

    def emit_powers(self, pieces: list) -> None:
        """Emits sequences whose lengths are powers of two, the largest first: they need no padding."""
        total = sum(len(p[3]) for p in pieces) // 4
        one, left = [], 1 << max(total.bit_length() - 1, 0)
        for doc_id, start, doc_tokens, ids in pieces:
            while ids:
                head = ids[: 4 * left]
                one.append((doc_id, start, doc_tokens, head))
                taken = len(head) // 4
                left, start, ids, total = left - taken, start + taken, ids[4 * left :], total - taken
                if not left:
                    self.emit(one)
                    one, left = [], 1 << max(total.bit_length() - 1, 0)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]
    columns = list(zip(*rows)) if rows else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], COLUMNS)


def _flushed(windows: Windows, least: int) -> Iterator[pa.RecordBatch]:
    if len(windows.emitted) >= least:
        rows, windows.emitted = windows.emitted, []
        for at in range(0, len(rows), ROWS_AT_ONCE):
            yield _batch(rows[at : at + ROWS_AT_ONCE])


def _first_id(round_: int) -> int:
    return round_ << ROUND_BITS | TaskContext.get().partitionId() << TASK_BITS


def pack(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    open_windows: int = OPEN_WINDOWS,
    vocabulary_path: str | None = None,
    end_id: int = END_ID,
) -> DataFrame:
    """Pieces of documents in sequences of at most ``window`` (a power of two) tokens.

    A document is the ids of its text (NULL and empty: none) and ``end_id``. One row per piece: doc_id,
    start (ids of the document before it), doc_tokens (with the end id), ids (little-endian unsigned
    32-bit), sequence_id and offset (place in the sequence, gapless from 0). Every id lies in exactly
    one piece. Sequences hold ``window`` tokens, or a smaller power of two for what is left at the very
    end of a task of the last merge: none needs padding. Rows that repeat, or share a number, are
    packed each; a NULL number stays NULL; other columns are ignored; no rows give no rows.

    ``vocabulary_path`` must be readable on every executor.
    """
    if window & (window - 1) or window < 1:
        raise ValueError("the window must be a power of two")
    path = vocabulary_path or vocabulary(VOCABULARY)
    end = np.array([end_id], "<u4").tobytes()

    def online(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(window, open_windows, _first_id(0))
        for whole in batches:
            for batch in some_rows(whole):
                numbers, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                for at, to in in_lots(texts):
                    for number, ids in zip(numbers[at:to], encoder(path).encode(texts[at:to])):
                        windows.place(number, 0, len(ids) // 4 + 1, ids + end)
                    yield from _flushed(windows, ROWS_AT_ONCE)
        left = windows.close()
        yield from _flushed(windows, 0)
        if left:
            yield _batch([(*piece, None, None) for piece in left])

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(window, open_windows, _first_id(1))
        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(4))):
                windows.place(*row)
            yield from _flushed(windows, ROWS_AT_ONCE)
        windows.emit_powers(windows.close())
        yield from _flushed(windows, 0)

    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    packed = stored(texts.mapInArrow(online, PIECES), "packed")
    left = packed.where("sequence_id IS NULL")
    tokens = left.agg(F.sum(F.length("ids")) / 4).first()[0] or 0
    tasks = max(1, math.ceil(tokens / (LEFTOVERS_MERGED * window)))
    rest = left.repartition(tasks).sortWithinPartitions("doc_id", "start").mapInArrow(merged, PIECES)
    return packed.where("sequence_id IS NOT NULL").unionByName(rest)

"""Periodic runs of words: squares caught online by dyadic blocks, merged into maximal runs.

Words are appended to a history. Whenever a block of 2^k words is complete, catchers guard it: one waits
for the block to come again at distances of two to three times its length, one at three to four times.
After each word there is one distance for every catcher, so a word costs one comparison of a suffix per
catcher: the last 2^k words against the guarded block. If they agree, both are extended to the left and
to the right; two equal words of q next to each other are a square of period q. A square of period q
holds a block of more than a quarter of q within its first half, so none is missed. Squares of one period
that touch are parts of one run, which grows as long as appended words agree with those q before.

Suffixes are compared by differences of prefix hashes, for all words of an append at once; every run is
then verified word by word, so a collision costs time but changes no result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelake.llm.common import some_rows, spare

LEAST_LENGTH, LEAST_EXPONENT = 6, 4
APPENDED = 1 << 16  # words at once; bounds memory, changes no result
BATCH_BYTES = 1 << 22
PRIME, BASE = np.uint64((1 << 31) - 1), 1_103_515_245  # a product of two remainders fits 64 bits
RUNS = T.ArrayType(T.StructType([T.StructField(c, T.LongType(), False) for c in ("start", "length", "period")]), False)


class Run(NamedTuple):
    start: int
    end: int
    period: int


class Catchers:
    """Finds the maximal runs of at least ``exponent`` (2 or more) periods in a growing sequence of numbers.

    ``longest`` bounds the periods that are looked for. The runs do not depend on how the sequence is
    cut into appends.
    """

    def __init__(self, longest: int, exponent: int = 2):
        self.longest, self.exponent = longest, exponent
        self.size = 0
        self.words = np.empty(1 << 10, np.int64)
        self.hashes = np.zeros(1 << 10, np.uint64)  # of prefixes: sum of word * BASE^place
        self.powers = np.ones(1, np.uint64)
        self.closed: list[Run] = []
        self.open: list[Run] = []  # reach the end and may grow

    def append(self, words: np.ndarray) -> None:
        """Takes more words: what is open grows or closes, then the catchers report new squares."""
        before = self.size
        self._grow(words)
        # By place, the runs there; one of a multiple of another's period is the same run.
        runs: dict[tuple[int, int], list[Run]] = {}
        for run in self.open:
            self._add(self._continued(run, before), runs)
        block = 1
        while block == 1 or 2 * block <= self.longest:
            for distance in (1, 2, 3) if block == 1 else (2, 3):
                starts, periods = self._caught(block, distance, before)
                for square in self._squares(starts, periods, block, [r for at in runs.values() for r in at]):
                    for run in self._verified(square):
                        self._add(run, runs)
            block *= 2
        self.open = [r for at in runs.values() for r in at if r.end == self.size]
        self.closed += [r for at in runs.values() for r in at if r.end < self.size and self._long(r)]

    def runs(self) -> list[Run]:
        """The runs up to here, by start and period."""
        found = [*self.closed, *(r for r in self.open if self._long(r))]
        return sorted(found, key=lambda r: (r.start, r.period))

    @staticmethod
    def _add(run: Run, runs: dict[tuple[int, int], list[Run]]) -> None:
        there = runs.setdefault((run.start, run.end), [])
        if all(run.period % r.period for r in there):
            there.append(run)

    def _long(self, run: Run) -> bool:
        return run.end - run.start >= self.exponent * run.period

    def _grow(self, words: np.ndarray) -> None:
        size = self.size + len(words)
        while len(self.powers) <= size:
            step = np.uint64(pow(BASE, len(self.powers), int(PRIME)))
            self.powers = np.r_[self.powers, _remainder(self.powers * step)]
        while len(self.hashes) <= size:
            self.hashes, self.words = np.r_[self.hashes, self.hashes], np.r_[self.words, self.words]
        digits = (words.astype(np.int64) % int(PRIME)).astype(np.uint64)
        placed = _remainder(digits * self.powers[self.size : size])
        self.hashes[self.size + 1 : size + 1] = (self.hashes[self.size] + np.cumsum(placed)) % PRIME
        self.words[self.size : size] = words
        self.size = size

    def _continued(self, run: Run, at: int) -> Run:
        """An open run, as far as the words from ``at`` on agree with those a period before."""
        differs = self.words[at : self.size] != self.words[at - run.period : self.size - run.period]
        return run._replace(end=at + int(differs.argmax()) if differs.any() else self.size)

    def _caught(self, block: int, distance: int, before: int) -> tuple[np.ndarray, np.ndarray]:
        """Guarded blocks that came again at the end of a prefix: their starts and distances."""
        ends = np.arange(max(before + 1, (distance + 1) * block), self.size + 1)
        periods = distance * block + (ends & (block - 1))
        real = periods <= self.longest
        if not real.all():
            ends, periods = ends[real], periods[real]
        starts = ends - periods - block  # a multiple of the block's length
        same = self._alike(starts, starts + block, ends - block, ends, self.powers[periods])
        return starts[same], periods[same]

    def _squares(self, starts: np.ndarray, periods: np.ndarray, block: int, runs: list[Run]) -> list[Run]:
        """How far the words around caught blocks agree, where that is a run or may become one."""
        # A block and its copy within one run of a period up to the block's length lie a multiple of that
        # period apart: this is no other run.
        short = np.array(sorted(r for r in runs if r.period <= block), np.int64).reshape(-1, 3)
        if len(short) and len(starts):
            at = np.searchsorted(short[:, 0], starts, side="right") - 1
            reach = np.maximum.accumulate(short[:, 1])
            other = (at < 0) | (reach[np.maximum(at, 0)] < starts + periods + block)
            starts, periods = starts[other], periods[other]
        if not len(starts):
            return []
        right = self._agree(starts, periods, block, self.size - starts - periods, forward=True)
        left = self._agree(starts, periods, 0, starts, forward=False)
        begins, ends = starts - left, starts + right + periods
        enough = (ends == self.size) | (ends - begins >= self.exponent * periods)
        found = np.unique(np.stack([periods, begins, ends])[:, enough], axis=1).T.tolist()
        return [Run(begin, end, period) for period, begin, end in found]

    def _alike(self, a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray, powers: np.ndarray) -> np.ndarray:
        """Whether the hashes of the words between a and b and between c and d agree, c - a places apart."""
        near = self.hashes[b] + PRIME - self.hashes[a]
        far = self.hashes[d] + PRIME - self.hashes[c]
        return _remainder(_remainder(near) * powers) == _remainder(far)

    def _agree(
        self, starts: np.ndarray, periods: np.ndarray, least: int, most: np.ndarray, forward: bool
    ) -> np.ndarray:
        """How many words after (before) each start equal those a period later, by binary search."""
        low, high, powers = np.full(len(starts), least, np.int64), most + 1, self.powers[periods]
        sign = 1 if forward else -1
        while (high - low > 1).any():
            middle = (low + high) // 2
            same = self._alike(starts, starts + sign * middle, starts + periods, starts + periods + sign * middle, powers)
            low, high = np.where(same, middle, low), np.where(same, high, middle)
        return low

    def _verified(self, square: Run) -> Iterator[Run]:
        """The stretches of it whose words do agree: all of it, unless hashes collided."""
        start, end, period = square
        same = self.words[start : end - period] == self.words[start + period : end]
        edges = np.flatnonzero(np.diff(np.r_[False, same, False])).reshape(-1, 2).tolist()
        for first, last in edges:
            run = Run(start + first, start + last + period, period)
            if run.end == self.size or self._long(run):
                yield run


def _remainder(x: np.ndarray) -> np.ndarray:
    """x modulo PRIME, for x below 2^62: what lies above 31 bits counts once more."""
    x = (x & PRIME) + (x >> np.uint64(31))
    return np.minimum(x, x - PRIME)  # below zero the difference wraps around


def _words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Number of words of each text, and all words; a NULL has none."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    values = lists.flatten()
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    real = pc.not_equal(values, "").to_numpy(zero_copy_only=False)
    if not real.all():  # before leading and after trailing white space
        text = np.repeat(np.arange(len(counts)), counts)
        counts = np.bincount(text[real], minlength=len(counts))
        values = values.filter(pa.array(real))
    return counts, values


def _batch_runs(counts: np.ndarray, words: pa.Array, least: int, exponent: int) -> np.ndarray:
    """Rows (text, start, end, period) of a batch's runs, by text, start and period."""
    codes = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    # Between texts a number of its own, so that nothing goes across.
    ends = np.cumsum(counts)
    sequence = np.insert(codes, ends, -1 - np.arange(len(counts)))
    catchers = Catchers(int(counts.max(initial=0)) // exponent, exponent)
    for at in range(0, len(sequence), APPENDED):
        catchers.append(sequence[at : at + APPENDED])
    runs = np.array(catchers.runs(), np.int64).reshape(-1, 3)
    runs = runs[runs[:, 1] - runs[:, 0] >= least]
    firsts = ends - counts + np.arange(len(counts))
    text = np.searchsorted(firsts, runs[:, 0], side="right") - 1
    runs[:, :2] -= firsts[text][:, None]
    return np.column_stack([text, runs])


def _run_column(runs: np.ndarray, texts: int) -> pa.Array:
    offsets = np.searchsorted(runs[:, 0], np.arange(texts + 1)).astype(np.int32)
    fields = [("start", runs[:, 1]), ("length", runs[:, 2] - runs[:, 1]), ("period", runs[:, 3])]
    structs = pa.StructArray.from_arrays(
        [pa.array(v, pa.int64()) for _, v in fields], fields=[pa.field(n, pa.int64(), False) for n, _ in fields]
    )
    return pa.ListArray.from_arrays(
        pa.array(offsets), structs, type=pa.list_(pa.field("element", structs.type, False))
    )


def _collapsed(counts: np.ndarray, words: pa.Array, runs: np.ndarray) -> pa.Array:
    """The texts without the words that a run repeats, joined by single blanks."""
    before = np.r_[0, np.cumsum(counts)]
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, before[runs[:, 0]] + runs[:, 1] + runs[:, 3], 1)
    np.add.at(change, before[runs[:, 0]] + runs[:, 2], -1)
    kept = np.cumsum(change[:-1]) == 0
    offsets = np.r_[0, np.cumsum(kept)][before].astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(offsets), words if kept.all() else words.filter(pa.array(kept)))
    return pc.binary_join(lists, " ")


def with_runs(
    docs: DataFrame,
    text: str = "text",
    names: Sequence[str] = ("runs", "collapsed"),
    least: int = LEAST_LENGTH,
    exponent: int = LEAST_EXPONENT,
    keep_text: bool = True,
) -> DataFrame:
    """Adds the periodic runs of words of ``text``, and the text without their repetitions.

    Words are what blanks and the control characters 9 to 13 separate, numbered from 0. A run is a
    stretch with a smallest period of q words, at least ``least`` words and ``exponent`` (2 or more)
    periods long, that no neighbouring word extends. The first column lists (start, length, period), by
    start and period; the second joins by single blanks the words that no run contains after its first q.
    NULL, empty and blank texts have no runs and an empty second column. Rows keep their other columns,
    repeats included; columns of the same names are replaced. Nothing is shuffled; texts of any length
    are taken whole, in appends of a bounded number of words.
    """
    replaced = {n.lower() for n in names}
    kept = [c for c in docs.columns if c.lower() not in replaced and (keep_text or c != text)]
    inner = spare([*kept, *names], "_in")
    fields = [T.StructField(names[0], RUNS), T.StructField(names[1], T.StringType())]
    schema = T.StructType([*(docs.schema[c] for c in kept), *fields])

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in some_rows(whole, BATCH_BYTES):
                counts, words = _words(batch.column(inner))
                runs = _batch_runs(counts, words, least, exponent)
                added = [_run_column(runs, len(counts)), _collapsed(counts, words, runs)]
                columns = [batch.column(c) for c in kept] + added
                yield pa.RecordBatch.from_arrays(columns, [*kept, *names])

    return docs.select(*kept, F.col(text).alias(inner)).mapInArrow(found, schema)

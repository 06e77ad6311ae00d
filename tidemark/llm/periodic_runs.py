"""Runs of repeated words in a text, by catching squares online over completed power-of-two blocks.

A run is a stretch of words with smallest period ``q`` (words ``q`` apart are equal) that is at least
``max(least, 2 q)`` long and that no neighbouring word extends. It begins with a square, ``q`` words twice,
and so it holds a whole block ``[j B, (j + 1) B)``, for a power of two ``B`` near ``q / 2``, together with the
same words ``q`` later. So each completed block is a catcher: it watches for itself at the distances of its
level, ``2 B - 1`` to ``4 B - 2`` words on, for ``B`` from 4. Shorter periods have ``least`` words to show
themselves: the blocks of 4 also watch 1 to 5 words on, and those of 2 watch 6.

``Catchers.append`` takes the next words, one or many. The hashes of all windows that they complete come by
doubling from level to level and are compared with the catchers in reach. What is caught at distance ``p`` is
compared backwards from its block and forwards behind it; where the words end first, every appended word
takes the comparison further. As soon as it is as long as ``p`` it has passed a square, and all squares that
it passes merge into one run. A catch inside a run whose period divides ``p`` is that run again and goes.

Cases: null, empty and blank texts have no words, no runs and an empty collapsed text. Words are compared as
they are, of any length. Each row is judged by itself, so repeated rows and null ids do not matter; an empty
table gives an empty result. A very long text takes memory and time in proportion to its words (times the
number of levels). Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import GOLDEN, bytes_of, cut, mix

#: Length of a run at least.
LEAST = 12
#: Words appended at once, and hashes compared at once.
APPEND, COMPARE = 1 << 16, 1 << 20


class _Growing:
    """An array with room to grow; ``values`` is what it holds."""

    def __init__(self, dtype: type, first: list | None = None):
        self._room = np.zeros(64, dtype)
        self.size = 0
        if first:
            self.extend(np.array(first, dtype))

    @property
    def values(self) -> np.ndarray:
        return self._room[: self.size]

    def extend(self, more: np.ndarray) -> None:
        needed = self.size + len(more)
        if needed > len(self._room):
            room = np.zeros(max(needed, 2 * len(self._room)), self._room.dtype)
            room[: self.size] = self.values
            self._room = room
        self._room[self.size : needed] = more
        self.size = needed


class Catchers:
    """The runs of a growing sequence of numbered words."""

    def __init__(self, least: int = LEAST):
        if least < 12:
            raise ValueError("shorter runs than 12 words would need catchers at other distances")
        self.least = least
        self._words = _Growing(np.int64)
        #: Level ``e`` holds the hashes of words ``i`` to ``i + 2^e - 1``, for every ``i``.
        self._windows = [_Growing(np.uint64)]
        #: (distance, start) to the place up to which words are compared, where the end of the words stopped it.
        self._open: dict[tuple[int, int], int] = {}
        #: Distance to the stretch that was compared last at it.
        self._compared: dict[int, tuple[int, int]] = {}
        #: (distance, start) to the number of a run; number 0 is none.
        self._number: dict[tuple[int, int], int] = {}
        self._end, self._period = _Growing(np.int64, [0]), _Growing(np.int64, [1])
        #: For each word the number of a run over it, of that which ends last.
        self._over = _Growing(np.int64)

    def append(self, words: np.ndarray) -> None:
        self._words.extend(words)
        self._over.extend(np.zeros(len(words), np.int64))
        waiting, self._open = self._open, {}
        for (p, start), at in waiting.items():
            self._forward(p, start, at)
        seen = self._grow()
        levels = [(2, 1, 5), (1, 6, 6)] + [(e, (2 << e) - 1, (4 << e) - 2) for e in range(2, len(seen))]
        for level, nearest, farthest in levels:
            if level < len(seen):
                self._catch(level, nearest, farthest, seen[level])

    def runs(self) -> list[tuple[int, int, int]]:
        """(start, length, period) of every run of the words so far, by start, then period."""
        shortest: dict[tuple[int, int], int] = {}
        for (p, start), number in self._number.items():
            span = start, int(self._end.values[number])
            shortest[span] = min(p, shortest.get(span, p))
        return sorted(((s, e - s, p) for (s, e), p in shortest.items()), key=lambda run: (run[0], run[2]))

    def _grow(self) -> list[int]:
        """Bring the hashes of all levels up to date; for each level how many there were before."""
        n = self._words.size
        seen = [self._windows[0].size]
        with np.errstate(over="ignore"):
            fresh = self._words.values[seen[0] :].astype(np.uint64)
            self._windows[0].extend(mix(fresh * GOLDEN + np.uint64(1)))
            level = 1
            while n >= self.least and (1 << level) <= max(4, (n + 2) // 4):
                if level == len(self._windows):
                    self._windows.append(_Growing(np.uint64))
                half, below, known = 1 << (level - 1), self._windows[level - 1].values, self._windows[level].size
                stop = n - 2 * half + 1
                self._windows[level].extend(mix(below[known:stop] * GOLDEN + below[known + half : stop + half]))
                seen.append(known)
                level += 1
        return seen

    def _catch(self, level: int, nearest: int, farthest: int, seen: int) -> None:
        """Compare the blocks of a level with the windows from number ``seen`` on."""
        size, windows = 1 << level, self._windows[level].values
        first = max(0, (seen - farthest) // size)
        count = (len(windows) - 1 - nearest) // size + 1
        rows = max(1, COMPARE // (farthest - nearest + 1))
        reach = np.arange(nearest, farthest + 1)
        for row in range(first, count, rows):
            starts = np.arange(row, min(row + rows, count)) * size
            at = starts[:, None] + reach
            same = windows[np.minimum(at, len(windows) - 1)] == windows[starts][:, None]
            block, distance = np.nonzero(same)
            if not len(block):
                continue
            valid = (at[block, distance] >= seen) & (at[block, distance] < len(windows))
            start, p = starts[block[valid]], reach[distance[valid]]
            fresh = ~self._known(start, p, size)
            self._follow(start[fresh], p[fresh], size)

    def _known(self, start: np.ndarray, p: np.ndarray, size: int) -> np.ndarray:
        """Whether a catch lies inside a run whose period divides the distance."""
        over = self._over.values[start]
        return (start + p + size <= self._end.values[over]) & (p % self._period.values[over] == 0)

    def _follow(self, start: np.ndarray, p: np.ndarray, size: int) -> None:
        """Compare from each catch in both directions, shorter distances first, a stretch once."""
        order = np.lexsort((start, p))
        start, p = start[order], p[order]
        bounds = np.flatnonzero(np.diff(p)) + 1
        for begun, same in zip(np.split(start, bounds), np.split(p, bounds), strict=True):
            if not len(begun):
                continue
            distance = int(same[0])
            begun = begun[~self._known(begun, same, size)]
            while len(begun):
                block = int(begun[0])
                low, high = self._compared.get(distance, (0, 0))
                if not low <= block < high:
                    self._forward(distance, self._back(distance, block), block + size)
                    _, high = self._compared[distance]
                begun = begun[np.searchsorted(begun, high) :]

    def _back(self, p: int, at: int) -> int:
        """The first word from which on, up to ``at``, words ``p`` apart are equal."""
        words, step = self._words.values, 32
        while at:
            low = max(0, at - step)
            differ = np.flatnonzero(words[low:at] != words[low + p : at + p])
            if len(differ):
                return low + int(differ[-1]) + 1
            at, step = low, 2 * step
        return 0

    def _forward(self, p: int, start: int, at: int) -> None:
        """Compare words ``p`` apart from ``at`` on; equal ones reach back to ``start``."""
        words, step = self._words.values, 32
        stop = len(words) - p
        while at < stop:
            high = min(stop, at + step)
            differ = np.flatnonzero(words[at:high] != words[at + p : high + p])
            if len(differ):
                at += int(differ[0])
                break
            at, step = high, 2 * step
        if at == stop:
            self._open[p, start] = at
        self._compared[p] = start, at
        if at - start >= p and at + p - start >= self.least:
            self._note(p, start, at + p)

    def _note(self, p: int, start: int, end: int) -> None:
        number = self._number.get((p, start))
        if number is None:
            number = self._number[p, start] = self._end.size
            self._end.extend(np.array([end]))
            self._period.extend(np.array([p]))
            low = start
        else:
            low = int(self._end.values[number])  # words before it carry the number or a run that ended later
            self._end.values[number] = end
        over = self._over.values[low:end]
        over[self._end.values[over] < end] = number


def text_runs(words: list[bytes], least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of ``words``."""
    numbers: dict[bytes, int] = {}
    numbered = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    catchers = Catchers(least)
    for begin in range(0, len(words), APPEND):
        catchers.append(numbered[begin : begin + APPEND])
    return catchers.runs()


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words but those that a run holds behind its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
    return b" ".join([words[i] for i in kept.tolist()])


_RUNS = "doc_id {id}, n_words BIGINT, runs ARRAY<STRUCT<start: BIGINT, length: BIGINT, period: BIGINT>>, collapsed STRING"


def find_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``doc_id``, ``n_words``, ``runs`` (by start, then period) and ``collapsed`` text of every row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut(batches, "text"):
            split = [(t or b"").split() for t in bytes_of(batch.column(1))]  # at the six ASCII spaces
            found = [text_runs(words, least) for words in split]
            flat = np.array([run for runs in found for run in runs], np.int64).reshape(-1, 3)
            offsets = np.cumsum([0, *map(len, found)])
            fields = [pa.array(flat[:, k]) for k in range(3)]
            runs = pa.ListArray.from_arrays(
                pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(fields, ["start", "length", "period"])
            )
            collapsed = pa.array(map(collapse, split, found), pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(map(len, split), pa.int64()), runs, collapsed],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    return docs.select("doc_id", "text").mapInArrow(work, _RUNS.format(id=docs.schema["doc_id"].dataType.simpleString()))


def longest(runs: Column) -> Column:
    """The run of greatest length; among equals that of the smallest start, then period. Null if there is none."""
    return F.array_max(
        F.transform(runs, lambda r: F.struct(r.length.alias("length"), (-r.start).alias("s"), (-r.period).alias("p"))))


def planted(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``; one text in ten repeats some of its words up to its end.

    With ``h`` the CRC-32 of the decimal id and ``g = h div 10``: if ``h mod 10`` is 0, the text has ``n`` words,
    ``a = g mod n`` and ``p = 1 + (n - a) div (3 + g mod 8)``, each word ``i`` from ``a`` on becomes word
    ``a + (i - a) mod p``. Other texts, and those with a null id, stay.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    n = F.size(words)
    g = F.floor(h / 10)
    a = F.pmod(g, n).cast("int")
    p = (1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))).cast("int")
    pattern = F.slice(words, a + 1, p)
    tail = F.slice(F.flatten(F.array_repeat(pattern, F.ceil((n - a) / p).cast("int"))), F.lit(1), n - a)
    text = F.array_join(F.concat(F.slice(words, F.lit(1), a), tail), " ")
    return docs.select("doc_id", F.when((h % 10 == 0) & (n > 0), text).otherwise(F.col("text")).alias("text"))

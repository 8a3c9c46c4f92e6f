"""Sum-of-squares packing of token streams into windows, with hardly any padding.

Documents are encoded and ended with an end id. What fills whole windows of ``capacity``
tokens is cut off first; the rest of a document, shorter than a window, is an item. Items
are placed online, as they come: of all fill levels that have room, and a new window, the
one is chosen that leaves the sum over levels of (windows at that level) squared least;
of equals, the fullest. A level array holds these counts, so a choice costs a pass over
``capacity`` numbers, whatever has been placed. Windows that fill up are passed on at once.

Every task packs the rows it reads, with a level array of its own; nothing is shuffled,
and windows that are still open in a task are at most ``MAX_OPEN``. Beyond that, and at
the end, open windows are settled: the emptiest are cut up to fill the fullest. One window
may be left, and it is cut into windows whose lengths are powers of two, which need no
padding. Open windows at such a level are passed on as they are.

Sequences are numbered by task and order, so a task that is run again gives the same.

Defined cases. Null text: empty, the end id alone. Equal rows and rows that share an id, or
have none, are placed one by one; ids pass through unchanged. Very long texts are encoded
whole and cut. Other columns of the input are left out, so their names cannot clash. An
empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from lakebook.llm.packing import END_ID, WORD_BPE, id_and_text, token_groups
from lakebook.llm.shared import releasing

CAPACITY = 2048
#: Windows that a task keeps open, of at most ``capacity`` ids each.
MAX_OPEN = 4096
#: Pieces of closed windows that a task gathers before it passes them on.
ROWS_AT_ONCE = 10_000


@dataclass
class Piece:
    """Tokens of a document from ``start`` on; ``doc`` names it, with all its tokens counted."""

    doc: int | None
    doc_tokens: int
    start: int
    ids: bytes

    def __len__(self) -> int:
        return len(self.ids) // 4

    def cut(self, at: int) -> tuple[Piece, Piece]:
        return (
            Piece(self.doc, self.doc_tokens, self.start, self.ids[: 4 * at]),
            Piece(self.doc, self.doc_tokens, self.start + at, self.ids[4 * at :]),
        )


Window = list[Piece]


def is_power_of_two(n: int) -> bool:
    return n > 0 and n & (n - 1) == 0


def split_at(window: Window, at: int) -> tuple[Window, Window]:
    """The first ``at`` tokens and the others; at most one piece is cut."""
    left, right, held = [], [], 0
    for piece in window:
        room = at - held
        if len(piece) <= room:
            left.append(piece)
        elif room <= 0:
            right.append(piece)
        else:
            first, second = piece.cut(room)
            left.append(first)
            right.append(second)
        held += len(piece)
    return left, right


class Levels:
    """Open windows by how many tokens they hold."""

    def __init__(self, capacity: int = CAPACITY, max_open: int = MAX_OPEN) -> None:
        self.capacity, self.max_open = capacity, max_open
        #: Windows at each level; full and empty ones do not count.
        self.count = np.zeros(capacity + 1, dtype=np.int64)
        self.open: list[list[Window]] = [[] for _ in range(capacity + 1)]
        self.windows = 0

    def choose(self, size: int) -> int:
        """The level, 0 for a new window, where ``size`` tokens make the sum of squares least.

        Moving a window from level h to h + size changes the sum by 2 (n[h + size] - n[h] + 1),
        by 1 - 2 n[h] if that fills it, and a new one by 1 + 2 n[size].
        """
        here = self.count[1 : self.capacity - size + 1]
        change = 2 * (self.count[size + 1 : self.capacity + 1] - here) + 2
        change[-1:] -= 1
        change[here == 0] = np.iinfo(np.int64).max
        if len(change):
            level = len(change) - int(change[::-1].argmin())
            if self.count[level] and change[level - 1] <= 2 * self.count[size] + 1:
                return level
        return 0

    def _push(self, level: int, window: Window) -> None:
        self.open[level].append(window)
        self.count[level] += 1
        self.windows += 1

    def _pop(self, level: int) -> Window:
        self.count[level] -= 1
        self.windows -= 1
        return self.open[level].pop()

    def place(self, piece: Piece) -> Iterator[Window]:
        """Put a piece shorter than a window somewhere; what fills up comes back."""
        level = self.choose(len(piece))
        window = self._pop(level) if level else []
        window.append(piece)
        if level + len(piece) == self.capacity:
            yield window
        else:
            self._push(level + len(piece), window)
        if self.windows > self.max_open:
            yield from self.settle()

    def settle(self) -> Iterator[Window]:
        """Fill the fullest windows with what the emptiest hold, until at most one is open."""
        ranked = [level for level in range(self.capacity, 0, -1) for _ in self.open[level]]
        windows = [self._pop(level) for level in ranked]
        first, last = 0, len(windows) - 1
        while first < last:
            window, room = windows[first], self.capacity - ranked[first]
            moved, windows[last] = split_at(windows[last], room)
            got = sum(map(len, moved))
            window += moved
            ranked[first] += got
            ranked[last] -= got
            if not ranked[last]:
                last -= 1
            if ranked[first] == self.capacity:
                yield window
                first += 1
        if first == last:
            if ranked[first] == self.capacity:
                yield windows[first]
            else:
                self._push(ranked[first], windows[first])

    def finish(self) -> Iterator[Window]:
        """All that is open, without padding: powers of two, and one window cut into such."""
        for level in range(1, self.capacity):
            while is_power_of_two(level) and self.open[level]:
                yield self._pop(level)
        yield from self.settle()
        for level in range(1, self.capacity):
            while self.open[level]:
                window, left = self._pop(level), level
                while left:
                    size = 1 << (left.bit_length() - 1)
                    part, window = split_at(window, size)
                    yield part
                    left -= size


ROWS = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, sequence_length long"
)


def _rows(window: Window, number: int, with_ids: bool) -> Iterator[tuple]:
    offset, total = 0, sum(map(len, window))
    for p in window:
        yield (
            p.doc, p.start, len(p), zlib.crc32(p.ids), p.doc_tokens, number, offset, total,
            *([p.ids] if with_ids else []),
        )
        offset += len(p)


def _placed(path: str, capacity: int, end_id: int, with_ids: bool, max_open: int):
    names = [part.split()[0] for part in ROWS.split(", ")] + (["ids"] if with_ids else [])
    kinds = [pa.int64()] * 8 + ([pa.binary()] if with_ids else [])
    schema = pa.schema(list(zip(names, kinds, strict=True)))

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[Window]:
        levels = Levels(capacity, max_open)
        for doc_ids, ids, ends in token_groups(batches, path, end_id):
            data, at = ids.tobytes(), 0
            for doc, end in zip(doc_ids.to_pylist(), ends.tolist(), strict=True):
                size = end - at
                whole = size - size % capacity
                for start in range(0, whole, capacity):
                    yield [Piece(doc, size, start, data[4 * (at + start) : 4 * (at + start + capacity)])]
                if whole < size:
                    yield from levels.place(Piece(doc, size, whole, data[4 * (at + whole) : 4 * end]))
                at = end
        yield from levels.finish()

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, held = TaskContext.get().partitionId() << 40, []
        for number, window in enumerate(windows(batches), first):
            held.extend(_rows(window, number, with_ids))
            if len(held) >= ROWS_AT_ONCE:
                yield batch_of(held)
                held = []
        if held:
            yield batch_of(held)

    return releasing(run)


def pack_windows(
    frame: DataFrame, id_col: str = "doc_id", text: str = "text", path: str = WORD_BPE,
    capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False, max_open: int = MAX_OPEN,
) -> DataFrame:
    """Every piece of every document with its place; with ``with_ids`` also its ids.

    ``sequence_length`` counts the tokens of the piece's sequence: ``capacity`` or a power
    of two. ``doc_tokens`` counts those of the document, its end id included.
    """
    kinds = ROWS + (", ids binary" if with_ids else "")
    return id_and_text(frame, id_col, text).mapInArrow(_placed(path, capacity, end_id, with_ids, max_open), kinds)

"""Operator 5: packing token sequences by best-fit decreasing.

Each task packs the documents of its own partition, so nothing is shuffled and a task that runs again gives the same sequences. Documents are cut
into full windows first; what is left of each, longest first, goes to the open window with the least room that holds it, found in a segment tree
indexed by remaining capacity. Windows that stay under `full` go back to the pool of the next chunk. If there are more than MOST_OPEN of them, and at
the end of a partition, the fullest are filled with what the emptiest hold, whose documents are cut where a window is full; the last window of a
partition is cut into sequences whose lengths are powers of two, which need no padding.

Null and empty texts are one id long (the end id); doc_id may be null or repeated; very long texts only take more windows; other columns are not
read; an empty table gives an empty table. Memory: the ids of one chunk of texts and of MOST_OPEN windows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .tokenize import word_bpe

#: Windows that may stay open from one chunk to the next.
MOST_OPEN = 256
SCHEMA = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class RoomTree:
    """Open windows by remaining capacity: a segment tree whose leaves are capacities and whose nodes count windows."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.at: list[list[int]] = [[] for _ in range(self.leaves)]

    def put(self, window: int, room: int) -> None:
        self.at[room].append(window)
        node = room + self.leaves
        while node:
            self.count[node] += 1
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """The open window with the least room of at least need, taken out, and its room."""
        count, node = self.count, need + self.leaves
        if not count[node]:
            while node > 1 and (node & 1 or not count[node + 1]):  # up until a subtree to the right has one
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = node * 2 if count[node * 2] else node * 2 + 1
        room = node - self.leaves
        while node:
            count[node] -= 1
            node >>= 1
        return self.at[room].pop(), room


Piece = tuple[Any, int, int, bytes]  # document, start, the document's ids in all, ids of the piece


def best_fit_decreasing(pieces: list[Piece], capacity: int) -> list[list[Piece]]:
    """Windows of pieces, none of which is longer than capacity."""
    windows: list[list[Piece]] = []
    tree = RoomTree(capacity)
    for p in sorted(pieces, key=lambda p: -len(p[3])):  # stable: ties stay in input order
        n = len(p[3]) // 4
        found = tree.take(n)
        if found is None:
            windows.append([p])
            at, room = len(windows) - 1, capacity
        else:
            at, room = found
            windows[at].append(p)
        if room > n:
            tree.put(at, room - n)
    return windows


def filled(windows: list[list[Piece]], capacity: int) -> tuple[list[list[Piece]], list[Piece]]:
    """Full windows, and the pieces that are left, fewer ids than one window: the fullest windows take what the emptiest hold."""
    size = lambda w: sum(len(p[3]) for p in w) // 4
    order = sorted(windows, key=size)
    out, spare = [], []  # spare: pieces of the emptiest window in hand
    while order:
        window = order.pop()
        left = capacity - size(window)
        while left and (spare or order):
            if not spare:
                spare = list(reversed(order.pop(0)))
            doc, start, total, ids = spare.pop()
            n = min(left, len(ids) // 4)
            window.append((doc, start, total, ids[: 4 * n]))
            left -= n
            if 4 * n < len(ids):
                spare.append((doc, start + n, total, ids[4 * n :]))
        if left:
            return out, window
        out.append(window)
        if spare and not order:
            order, spare = [list(reversed(spare))], []
    return out, []


def powers(window: list[Piece]) -> Iterator[list[Piece]]:
    """The same ids as windows whose lengths are powers of two, largest first."""
    left = sum(len(p[3]) for p in window) // 4
    rest = list(reversed(window))
    while left:
        want = 1 << (left.bit_length() - 1)
        left -= want
        out = []
        while want:
            doc, start, total, ids = rest.pop()
            n = min(want, len(ids) // 4)
            out.append((doc, start, total, ids[: 4 * n]))
            if 4 * n < len(ids):
                rest.append((doc, start + n, total, ids[4 * n :]))
            want -= n
        yield out


def pack(docs: DataFrame, vocabulary: str, capacity: int = 4096, end_id: int = 2, full: float = 0.97, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    common.ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    end = end_id.to_bytes(4, "little")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe(vocabulary)
        common.keeps("word_bpe", word_bpe.cache_clear)
        id_type = None
        names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        sequence = TaskContext.get().partitionId() << 32
        pool: list[Piece] = []

        def batch_of(windows: list[list[Piece]]) -> pa.RecordBatch:
            nonlocal sequence
            cols: list[list] = [[] for _ in names]
            for w in windows:
                offset = 0
                for doc, start, total, ids in w:
                    n = len(ids) // 4
                    for c, v in zip(cols, (doc, start, n, zlib.crc32(ids), total, sequence, offset), strict=True):
                        c.append(v)
                    offset += n
                sequence += 1
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [id_type] + [pa.int64()] * 6, strict=True)], names)

        for batch in batches:
            id_type = batch.schema.field(0).type
            for part in common.chunks(batch, most=4 << 20):
                done = []
                for doc, ids in zip(part.column(0).to_pylist(), bpe.ids([t or "" for t in part.column(1).to_pylist()]), strict=True):
                    ids += end
                    total, whole = len(ids) // 4, len(ids) // 4 // capacity * capacity
                    done += [[(doc, s, total, ids[4 * s : 4 * (s + capacity)])] for s in range(0, whole, capacity)]
                    if whole < total:
                        pool.append((doc, whole, total, ids[4 * whole :]))
                windows = best_fit_decreasing(pool, capacity)
                least = 4 * capacity * full
                closed = [w for w in windows if sum(len(p[3]) for p in w) >= least]
                open_ = [w for w in windows if sum(len(p[3]) for p in w) < least]
                if len(open_) > MOST_OPEN:
                    more, pool = filled(open_, capacity)
                    closed += more
                else:
                    pool = [p for w in open_ for p in w]
                yield batch_of(done + closed)
        if pool:
            closed, rest = filled(best_fit_decreasing(pool, capacity), capacity)
            yield batch_of([*closed, *powers(rest)])

    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(common.lean(rows, "word_bpe"), f"id {kind}, {SCHEMA}")
    return out.withColumnRenamed("id", id_col)

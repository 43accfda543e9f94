"""Time-forward processing of a forest: totals travel from children to parents through a priority queue.

Nodes arrive in reverse level order (deepest first, then by key), sorted outside memory by
Spark. Each node takes from the queue the messages addressed to it and puts one for its parent
there; the queue writes sorted runs to unnamed scratch files of the task when it holds too
many messages. Nothing reads these files after the task, and a lost task starts anew.
"""

from __future__ import annotations

import heapq
import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

QUEUE_MESSAGES = 200_000
BLOCK_MESSAGES = 4_096
BATCH_ROWS = 10_000

#: A node: place (negative depth, two halves of the key), its parent's two halves, whether its parent is elsewhere,
#: its least member, members, and what it brings: children, leaves and saved bytes known already.
NODE = ("level", "p1", "p2", "q1", "q2", "top", "conv_id", "n_convs", "n_children", "n_leaves", "saved")
#: A finished node; ``parent`` is null for one whose parent is elsewhere.
DONE = ("depth", "p1", "p2", "q1", "q2", "conv_id", "parent", "n_convs", "n_children", "n_leaves", "saved")
DONE_SCHEMA = ", ".join(f"{c} long" for c in DONE)


class SpillingQueue:
    """A priority queue of equally long tuples of 64-bit numbers that keeps at most ``limit`` of them in memory."""

    def __init__(self, limit: int = QUEUE_MESSAGES):
        self.limit, self.heap, self.heads, self.files = limit, [], [], []

    def push(self, message: tuple) -> None:
        heapq.heappush(self.heap, message)
        if len(self.heap) > self.limit:
            self._spill()

    def _spill(self) -> None:
        self.heap.sort()
        file = tempfile.TemporaryFile()
        file.write(np.array(self.heap, dtype=np.int64).tobytes())
        run = self._read(file, len(self.heap[0]))
        self.heap = []
        self.files.append(file)
        heapq.heappush(self.heads, (next(run), len(self.files), run))

    @staticmethod
    def _read(file, width: int) -> Iterator[tuple]:
        at, step = 0, BLOCK_MESSAGES * width * 8
        while True:
            file.seek(at)
            data = file.read(step)
            if not data:
                file.close()
                return
            at += len(data)
            yield from map(tuple, np.frombuffer(data, dtype=np.int64).reshape(-1, width).tolist())

    def least(self) -> tuple | None:
        if self.heads and (not self.heap or self.heads[0][0] < self.heap[0]):
            return self.heads[0][0]
        return self.heap[0] if self.heap else None

    def pop(self) -> tuple:
        if self.heads and (not self.heap or self.heads[0][0] < self.heap[0]):
            message, at, run = self.heads[0]
            following = next(run, None)
            if following is None:
                heapq.heappop(self.heads)
            else:
                heapq.heapreplace(self.heads, (following, at, run))
            return message
        return heapq.heappop(self.heap)


def totals(nodes: Iterable[tuple], limit: int = QUEUE_MESSAGES) -> Iterator[tuple]:
    """``DONE`` tuples of ``NODE`` tuples in reverse level order. A node is finished when its parent takes its
    message, so that the parent's least member is known; a node whose parent is elsewhere is finished at once."""
    queue = SpillingQueue(limit)
    for level, p1, p2, q1, q2, top, conv_id, n_convs, n_children, n_leaves, saved in nodes:
        place = (level, p1, p2)
        while (message := queue.least()) is not None and message[:3] == place:
            _, _, _, c1, c2, child, members, kids, leaves, bytes_ = queue.pop()
            n_children += 1
            n_leaves += leaves
            saved += bytes_
            yield 1 - level, c1, c2, p1, p2, child, conv_id, members, kids, leaves, bytes_
        if n_children == 0:
            n_leaves = 1
        if top:
            yield -level, p1, p2, q1, q2, conv_id, None, n_convs, n_children, n_leaves, saved
        else:
            queue.push((level + 1, q1, q2, p1, p2, conv_id, n_convs, n_children, n_leaves, saved))
    if queue.least() is not None:
        raise RuntimeError(f"no node takes the message {queue.least()}")


def totals_in_batches(batches: Iterator[pa.RecordBatch], limit: int = QUEUE_MESSAGES) -> Iterator[pa.RecordBatch]:
    """``totals`` over the record batches of a partition."""
    nodes = (row for b in batches for row in zip(*[b.column(i).to_pylist() for i in range(len(NODE))]))
    held: list[tuple] = []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*held)], list(DONE))

    for row in totals(nodes, limit):
        held.append(row)
        if len(held) >= BATCH_ROWS:
            yield batch()
            held = []
    if held:
        yield batch()

"""Joining open ways inside a task: small helpers without Spark.

The module is pickled by value with the task that uses it, so executors need
no copy of the package.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

RING_COLUMNS = ("ring_slot", "pos", "reversed", "status", "ring_first", "ring_last")


def ring_joiner(group: list[str], max_gap: int):
    """The ``mapInArrow`` function for rows sorted by group and slot."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, group):
            yield from with_rings(table, group, max_gap).to_batches()

    return run


def whole_groups(batches: Iterator[pa.RecordBatch], group: list[str]) -> Iterator[pa.Table]:
    """Regroup sorted batches so that no group is cut in two."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        starts = _group_starts(batch, group)
        if held and not _same_group(held[-1], batch, group):
            yield pa.Table.from_batches(held)
            held = []
        if len(starts) > 1:
            cut = starts[-1]
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = [batch.slice(cut)]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def _group_starts(rows, group: list[str]) -> list[int]:
    change = np.zeros(rows.num_rows, dtype=bool)
    change[0] = True
    for name in group:
        values = np.asarray(rows.column(name))
        change[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(change).tolist()


def _same_group(before, after, group: list[str]) -> bool:
    return all(before.column(n)[before.num_rows - 1] == after.column(n)[0] for n in group)


def with_rings(table: pa.Table, group: list[str], max_gap: int) -> pa.Table:
    """Add the ring columns: the open ways of each group, joined."""
    slot, first, last, count = [np.asarray(table.column(c))
                                for c in ("slot", "first", "last", "n_points")]
    ring_slot, pos = slot.copy(), np.zeros(len(slot), dtype=np.int64)
    flipped = np.zeros(len(slot), dtype=bool)
    status = np.full(len(slot), "closed", dtype=object)
    ring_first, ring_last = first.copy(), last.copy()
    starts = _group_starts(table, group)
    for lo, hi in zip(starts, [*starts[1:], len(slot)]):
        for head, tail, size, is_ring, path in grow_chains(
                first[lo:hi].tolist(), last[lo:hi].tolist(), count[lo:hi].tolist()):
            rows = [lo + way for way, _ in path]
            ring_slot[rows] = slot[rows[0]]
            pos[rows] = range(len(rows))
            flipped[rows] = [turned for _, turned in path]
            ring_first[rows], ring_last[rows] = head, tail
            if not is_ring:
                near = size >= 3 and _near(head, tail, max_gap)
                status[rows] = "gap_closed" if near else "discarded"
    added = (ring_slot, pos, flipped, pa.array(status, type=pa.string()), ring_first, ring_last)
    for name, values in zip(RING_COLUMNS, added):
        table = table.append_column(name, pa.array(values))
    return table


def _near(a: int, b: int, max_gap: int) -> bool:
    def split(point):
        return point >> 32, ((point & 0xFFFFFFFF) ^ 0x80000000) - 0x80000000

    (ax, ay), (bx, by) = split(a), split(b)
    return abs(ax - bx) < max_gap and abs(ay - by) < max_gap


def grow_chains(first: list[int], last: list[int], count: list[int]):
    """Join the open ways of one group, given in slot order.

    In slot order, each way grows at its tail by the lowest-slot chain that
    touches it there, until it closes or nothing touches. Joining never adds
    an end point, so a chain that is stuck stays stuck, and one pass is enough.
    Yields (head, tail, size, closed, [(way, flipped), ...]) per chain.
    """
    tail, size = list(last), list(count)
    absorbed: list[list[tuple[int, bool]]] = [[] for _ in first]
    is_open = [True] * len(first)
    roots = [True] * len(first)
    touching: dict[int, list[int]] = defaultdict(list)
    for way, (a, b) in enumerate(zip(first, last)):
        touching[a].append(way)
        if a != b:
            touching[b].append(way)

    def partner(chain: int, at: int):
        heap, own = touching[at], False
        found = None
        while heap and found is None:
            other = heap[0]
            if other != chain and is_open[other] and at in (first[other], tail[other]):
                found = other
            else:
                own |= other == chain
                heapq.heappop(heap)
        if own:
            heapq.heappush(heap, chain)
        return found

    for chain in range(len(first)):
        while is_open[chain]:
            at = tail[chain]
            other = partner(chain, at)
            if other is None:
                break
            flipped = first[other] != at
            absorbed[chain].append((other, flipped))
            is_open[other] = roots[other] = False
            tail[chain] = first[other] if flipped else tail[other]
            size[chain] += size[other] - 1
            heapq.heappush(touching[tail[chain]], chain)
            is_open[chain] = not (size[chain] >= 4 and tail[chain] == first[chain])

    for chain, root in enumerate(roots):
        if root:
            yield (first[chain], tail[chain], size[chain], not is_open[chain],
                   _travel(chain, absorbed))


def _travel(chain: int, absorbed) -> list[tuple[int, bool]]:
    """Ways of a chain in travel order, unfolding absorbed chains without recursion."""
    path, stack = [], [(chain, False, True)]
    while stack:
        way, flipped, unfold = stack.pop()
        if not unfold:
            path.append((way, flipped))
            continue
        steps = [(way, flipped, False)]
        steps += [(sub, turn != flipped, True) for sub, turn in absorbed[way]]
        stack.extend(steps if flipped else reversed(steps))
    return path

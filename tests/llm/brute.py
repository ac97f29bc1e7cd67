"""Plain versions of operators that several test files compare with."""

import heapq
from dataclasses import dataclass

from tarnbeck.llm.mixing import quotas


def brute_windows(rows, window):
    first = {}
    split = [(i, [w.decode() for w in (t or "").encode().split()]) for i, t in rows]
    for i, words in split:
        for j in range(len(words) - window + 1):
            key = tuple(words[j : j + window])
            rank = (i is None, i or 0)
            first[key] = min(first.get(key, rank), rank)
    out = []
    for i, words in split:
        gone = set()
        for j in range(len(words) - window + 1):
            if first[tuple(words[j : j + window])] < (i is None, i or 0):
                gone.update(range(j, j + window))
        kept = [w for k, w in enumerate(words) if k not in gone]
        out.append((i, len(words), len(gone), " ".join(kept)))
    return out


def one_period(quota, period):
    """The slots of each source by earliest deadline first; quotas sum to the period."""
    order = list(quota)
    waiting = [(0, i, 0) for i in range(len(order))]  # release, source, block
    heapq.heapify(waiting)
    ready = []  # deadline, source, block
    slots = {s: [] for s in order}
    for slot in range(period):
        while waiting and waiting[0][0] <= slot:
            _, i, k = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(k + 1) * period // quota[order[i]]), i, k))
        _, i, k = heapq.heappop(ready)
        slots[order[i]].append(slot)
        if k + 1 < quota[order[i]]:
            heapq.heappush(waiting, ((k + 1) * period // quota[order[i]], i, k + 1))
    return slots


@dataclass
class Phase:
    """From `start` on, while the same sources have blocks left."""

    start: int
    quota: dict
    slots: dict
    first_block: dict


def phases(blocks, weights, period):
    """One phase for each set of sources that still have blocks."""
    left = {s: n for s, n in blocks.items() if n}
    done = dict.fromkeys(left, 0)
    found, start = [], 0
    while left:
        mine = {s: weights[s] for s in left}
        quota = quotas(mine if sum(mine.values()) > 0 else dict.fromkeys(left, 1.0), period)
        slots = one_period(quota, period)
        found.append(Phase(start, quota, slots, {s: done[s] for s in left}))
        # The first slot that some source could not fill ends the phase.
        length = min(left[s] // quota[s] * period + slots[s][left[s] % quota[s]] for s in left)
        for s in list(left):
            used = length // period * quota[s] + sum(slot < length % period for slot in slots[s])
            done[s] += used
            left[s] -= used
            if not left[s]:
                del left[s]
        start += length
    return found

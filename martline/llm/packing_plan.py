"""Packing plans over length counts: which lengths share a sequence.

Lengths are whole numbers up to the capacity, so the number of pieces of each
length, whatever the corpus, is a table of at most ``capacity`` rows, and so
are the sequences by room left. Both plans below work on such counts alone; the
places they give out are ranks, which the pieces then take by their own rank.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Configurations are optimised until no other could save more than this share.
TOLERANCE = 1e-3


@dataclass(frozen=True)
class Group:
    """Ranks ``first`` to ``last`` (exclusive) of the large pieces by falling
    length; ``size`` is the length of the first of them."""
    first: int
    last: int
    size: int


def linear_groups(counts: np.ndarray, least: int, groups: int) -> list[Group]:
    """Equal-cardinality groups of the pieces longer than ``least``, by falling
    length; ``counts[n]`` is the number of pieces of length n. A boundary
    within equal lengths moves to their end, so a group holds whole lengths,
    and a length with a group's share by itself is a group of its own: at most
    twice ``groups`` in all."""
    lengths = np.flatnonzero(counts)[::-1]
    lengths = lengths[lengths > least]
    ends = np.cumsum(counts[lengths]).tolist()
    if not ends:
        return []
    share = max(1, -(-ends[-1] // groups))
    out, first, size = [], 0, 0
    for i, (length, end) in enumerate(zip(lengths.tolist(), ends, strict=True)):
        size = size or length
        following = int(counts[lengths[i + 1]]) if i + 1 < len(ends) else share
        if end - first >= share or following >= share:
            out.append(Group(first, end, size))
            first, size = end, 0
    return out


def _best(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(value, configuration) of the most valuable configuration with each
    size, any number of each: worth of so many pieces at most by room."""
    order = np.argsort(sizes, kind="stable")
    small, value = sizes[order], values[order]
    top = np.maximum.accumulate(value)
    at = np.maximum.accumulate(np.where(value >= top, np.arange(len(value)), 0))
    upto = np.searchsorted(small, np.arange(capacity + 1), "right")
    fits = (upto > 0) & (top[upto - 1] > 0)
    worth = [np.zeros(capacity + 1), np.where(fits, top[upto - 1], 0)]
    pick = [np.full(capacity + 1, -1), np.where(fits, at[upto - 1], -1)]
    most = capacity // int(small[0])
    rooms = np.arange(capacity + 1)[None, :] - small[:, None]
    for _ in range(2, most):
        got = np.where(rooms >= 0, value[:, None] + worth[-1][np.maximum(rooms, 0)], -1)
        best = got.argmax(axis=0)
        got = got[best, np.arange(capacity + 1)]
        better = got > worth[-1] + 1e-12
        worth.append(np.where(better, got, worth[-1]))
        pick.append(np.where(better, best, -1))
    m = len(sizes)
    configs, room = np.zeros((m, m), np.int64), capacity - small
    total = value + worth[most - 1][room]
    configs[np.arange(m), order] = 1
    for k in range(most - 1, 0, -1):
        i = pick[k][room]
        used = np.flatnonzero(i >= 0)
        np.add.at(configs, (used, order[i[used]]), 1)
        room[used] -= small[i[used]]
    return total, configs


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int,
                   tolerance: float = TOLERANCE) -> list[tuple[np.ndarray, int]]:
    """(pieces of each size in a sequence, number of such sequences), covering
    ``demand`` exactly in few sequences: the linear programme over all
    configurations by column generation, rounded down; what is left, less than
    a sequence for each size, by best fit."""
    m = len(sizes)
    if not m:
        return []
    configs = np.diag(capacity // sizes)
    inverse = np.diag(1 / np.diag(configs))
    x = demand / np.diag(configs)
    pool = np.zeros((0, m))
    while True:
        price = inverse.sum(axis=0)
        worth = pool @ price
        best = int(worth.argmax()) if len(worth) else 0
        if not len(worth) or worth[best] <= 1 + tolerance:
            worth, fresh = _best(sizes, price, capacity)
            if worth.max() <= 1 + tolerance:
                break
            pool = np.unique(fresh, axis=0).astype(float)
            worth = pool @ price
            best = int(worth.argmax())
        config = pool[best]
        step = inverse @ config
        ratio = np.full(m, np.inf)
        np.divide(x, step, out=ratio, where=step > 1e-9)
        out = int(ratio.argmin())
        theta = ratio[out]
        x = np.maximum(x - theta * step, 0)
        x[out] = theta
        row = inverse[out] / step[out]
        inverse -= np.outer(step, row)
        inverse[out] = row
        configs[out] = config
    plan, left = [], demand.astype(np.int64).copy()
    for config, times in zip(configs, x, strict=True):
        used = config > 0
        times = min(int(times + 1e-6), int((left[used] // config[used]).min()))
        if times:
            plan.append((config, times))
            left -= config * times
    rest = np.repeat(np.arange(m), left)
    rooms: list[int] = []
    held: list[np.ndarray] = []
    for i in rest[np.argsort(-sizes[rest], kind="stable")]:
        size = int(sizes[i])
        fits = [(room, k) for k, room in enumerate(rooms) if room >= size]
        if fits:
            room, k = min(fits)
        else:
            k = len(rooms)
            rooms.append(capacity)
            held.append(np.zeros(m, np.int64))
        rooms[k] -= size
        held[k][i] += 1
    same: dict[bytes, int] = {}
    for h in held:
        same[h.tobytes()] = same.get(h.tobytes(), 0) + 1
    return plan + [(np.frombuffer(k, np.int64), n) for k, n in same.items()]


@dataclass(frozen=True)
class Fill:
    """Pieces ``first`` to ``last`` (exclusive, by rank) of length ``size`` go,
    ``each`` to a sequence (the last one may get fewer), to the sequences that
    had ``room`` left, from rank ``at`` on."""
    size: int
    first: int
    last: int
    room: int
    at: int
    each: int


def best_fit(counts: np.ndarray, least: int, rooms: np.ndarray, capacity: int) -> tuple[list[Fill], int]:
    """Best fit of the pieces of up to ``least``, longest first, into sequences
    given by room left (``rooms[r]``: how many); (fills, number of new
    sequences, which stand at the end of those with the whole capacity left).

    Sequences are taken as runs of equal room: of the runs with room for the
    size the one with the least room is filled, each sequence with as many
    pieces as fit, as best fit one by one would do."""
    # Runs by the room now left: (original room, first rank, number).
    now: dict[int, list[tuple[int, int, int]]] = {
        r: [(r, 0, int(n))] for r, n in enumerate(rooms.tolist()) if n}
    fills, opened = [], int(rooms[capacity])
    for size in range(least, 0, -1):
        left, rank = int(counts[size]), 0
        if not left:
            continue
        for room in sorted(r for r in now if r >= size):
            if not left:
                break
            each, keep = room // size, []
            for origin, at, n in now.pop(room):
                whole = min(n, left // each)
                if whole:
                    fills.append(Fill(size, rank, rank + whole * each, origin, at, each))
                    now.setdefault(room - each * size, []).append((origin, at, whole))
                    rank, left = rank + whole * each, left - whole * each
                    at, n = at + whole, n - whole
                if n and left and left < each:
                    fills.append(Fill(size, rank, rank + left, origin, at, each))
                    now.setdefault(room - left * size, []).append((origin, at, 1))
                    rank, left = rank + left, 0
                    at, n = at + 1, n - 1
                if n:
                    keep.append((origin, at, n))
            if keep:
                now.setdefault(room, []).extend(keep)
        if left:
            each = capacity // size
            n = -(-left // each)
            fills.append(Fill(size, rank, rank + left, capacity, opened, each))
            whole, rest = left // each, left % each
            if whole:
                now.setdefault(capacity - each * size, []).append((capacity, opened, whole))
            if rest:
                now.setdefault(capacity - rest * size, []).append((capacity, opened + whole, 1))
            opened += n
    return fills, opened - int(rooms[capacity])

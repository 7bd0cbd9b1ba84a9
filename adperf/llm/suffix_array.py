"""Two-stage suffix sorting of bytes, in numpy.

Suffixes that are smaller than their successor are sorted directly; the others
are induced from them by a scan over the buckets of first bytes. Only suffixes at
wanted places, and those that they are induced from, are sorted, and only to a
given depth: suffixes that agree so far stand side by side, in any order.
"""

from __future__ import annotations

import numpy as np


def _big_words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as a number in the order of bytes. data has eight bytes more than there are places."""
    n = len(data) - 7
    out = np.zeros(n, np.uint64)
    for i in range(8):
        out = (out << np.uint64(8)) | data[i:n + i]
    return out


def smaller_than_next(data: np.ndarray) -> np.ndarray:
    """For each place, whether its suffix is smaller than the next one (the last one counts as smaller)."""
    n = len(data)
    rises = np.ones(n, bool)
    rises[:-1] = data[:-1] < data[1:]
    run_end = np.arange(n)  # the last place of the run of equal bytes that a place is in
    run_end[:-1][data[:-1] == data[1:]] = n
    run_end = np.minimum.accumulate(run_end[::-1])[::-1]
    return rises[np.minimum(run_end, n - 1)]


def _sorted_directly(words: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """places in the order of their suffixes' first ``depth`` bytes, refined word by word where they are still equal."""
    order = places[np.argsort(words[places], kind="stable")]
    key = words[order]
    group = np.concatenate(([0], np.cumsum(key[1:] != key[:-1]))) if len(order) else np.zeros(0, np.int64)
    at = np.arange(len(order))  # the slots of suffixes that are not alone in their group
    for shift in range(8, depth, 8):
        new = np.ones(len(group), bool)
        new[1:] = group[1:] != group[:-1]
        alone = new & np.concatenate((new[1:], [True])) if len(group) else new
        at, group = at[~alone], group[~alone]
        if not len(at):
            break
        key = words[np.minimum(order[at] + shift, len(words) - 1)]
        by = np.lexsort((key, group))
        order[at] = order[at][by]
        key, group = key[by], group[by]
        group = np.concatenate(([0], np.cumsum((group[1:] != group[:-1]) | (key[1:] != key[:-1]))))
    return order


def two_stage(data: np.ndarray, wanted: np.ndarray, depth: int) -> np.ndarray:
    """The wanted places in the order of their suffixes (to ``depth`` bytes). data ends with depth + 8 spare bytes."""
    small = smaller_than_next(data)
    n = len(data)
    active = np.zeros(n, bool)
    active[wanted] = True
    # A larger suffix is induced from its successor; so successors are sorted too, up to the next smaller one.
    edge = wanted
    while len(edge := edge[~small[edge]]):
        edge = edge + 1
        edge = edge[~active[edge]]
        active[edge] = True
    direct = np.flatnonzero(active & small)
    direct = _sorted_directly(_big_words(data), direct, depth + 8)
    first = data[direct]
    ends = np.searchsorted(first, np.arange(257))  # sorted, so the first bytes ascend
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    larger = active & ~small
    out: list[np.ndarray] = []
    for c in range(256):
        own = [x for x in induced[c] if len(x)]
        done = own
        while own:  # those with a run of c in front stand in the same bucket
            again = np.concatenate(own) - 1
            again = again[again >= 0]
            again = again[larger[again] & (data[again] == c)]
            own = [again] if len(again) else []
            done = done + own
        bucket = np.concatenate([*done, direct[ends[c]:ends[c + 1]]]) if done or ends[c + 1] > ends[c] else None
        if bucket is None:
            continue
        out.append(bucket)
        before = bucket - 1
        before = before[before >= 0]
        before = before[larger[before] & (data[before] > c)]
        lead = data[before]
        by = np.argsort(lead, kind="stable")
        before, lead = before[by], lead[by]
        cuts = np.concatenate(([0], np.flatnonzero(lead[1:] != lead[:-1]) + 1, [len(lead)])) if len(lead) else []
        for s, e in zip(cuts, cuts[1:], strict=False):
            induced[lead[s]].append(before[s:e])
    order = np.concatenate(out) if out else np.zeros(0, np.int64)
    mask = np.zeros(n, bool)
    mask[wanted] = True
    return order[mask[order]]


def common_prefixes(data: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Length, up to ``depth``, of the common prefix of each suffix in order with the one before (0 for the first)."""
    out = np.zeros(len(order), np.int64)
    words = _big_words(data)
    alive = np.arange(1, len(order))
    for shift in range(0, depth, 8):
        a, b = words[order[alive - 1] + shift], words[order[alive] + shift]
        same = a == b
        differing = (a ^ b)[~same]
        # Equal leading bytes: the highest differing bit tells.
        lead = 7 - (np.frexp(differing.astype(np.float64))[1] - 1) // 8
        top = differing >> np.uint64(56)
        lead = np.where(top != 0, 0, np.clip(lead, 0, 7))
        out[alive[~same]] = np.minimum(shift + lead, depth)
        alive = alive[same]
        if not len(alive):
            return out
    out[alive] = depth
    return out


def repeated(data: np.ndarray, wanted: np.ndarray, depth: int) -> np.ndarray:
    """Those wanted places whose first ``depth`` bytes stand at another wanted place too (ascending)."""
    spare = np.concatenate((data, np.zeros(depth + 16, np.uint8)))
    order = two_stage(spare, wanted, depth)
    long = common_prefixes(spare, order, depth) >= depth
    both = long | np.concatenate((long[1:], [False]))
    return np.sort(order[both])

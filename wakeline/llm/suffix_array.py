"""Suffix arrays by induced sorting, and permuted common prefixes, in numpy.

Suffixes are classified as S (smaller than their right neighbour) or L; the leftmost S
suffixes of each run (LMS) are sorted by sorting their substrings; all others are induced
from them in two linear sweeps over the buckets of first characters. A bucket's
suffixes are handled as one batch, and so are the ones they induce, so the small alphabet
of bytes needs few array operations.

Where LMS substrings repeat, their names form a shorter string that is sorted recursively:
pairs of neighbouring names are named, then pairs of pairs, until all names differ. (The
reduced alphabet is as large as the string, and bucket sweeps over it would handle one
suffix at a time; renaming pairs is a sort of whole arrays, of only those that still tie.)
"""

from __future__ import annotations

import numpy as np

def classify(s: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than the one that starts one later (the last: True)."""
    n = len(s)
    differ = np.append(s[:-1] != s[1:], True)
    less = np.append(s[:-1] < s[1:], True)
    at = np.where(differ, np.arange(n), n)
    decides = np.minimum.accumulate(at[::-1])[::-1]
    return less[decides]


def _deal(j: np.ndarray, c: np.ndarray, queue: list[list[np.ndarray]]) -> None:
    """Append the suffixes ``j`` with first characters ``c`` to their buckets' queues, in order."""
    if not len(j):
        return
    order = np.argsort(c, kind="stable")
    j, c = j[order], c[order]
    cut = np.flatnonzero(c[1:] != c[:-1]) + 1
    for part, name in zip(np.split(j, cut), c[np.append(0, cut)].tolist()):
        queue[name].append(part)


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def _induce(s: np.ndarray, smaller: np.ndarray, lms: np.ndarray, sigma: int) -> np.ndarray:
    order = np.argsort(s[lms], kind="stable")
    seeds = lms[order]
    bound = np.searchsorted(s[seeds], np.arange(sigma + 1))
    queue: list[list[np.ndarray]] = [[] for _ in range(sigma)]
    l_part: list[np.ndarray] = []
    for c in range(sigma):
        parts, batch = [], _joined(queue[c])
        queue[c] = []
        while len(batch):
            parts.append(batch)
            j = batch[batch > 0] - 1
            j = j[~smaller[j]]
            cj = s[j]
            here = cj == c
            _deal(j[~here], cj[~here], queue)
            batch = j[here]
        l_part.append(_joined(parts))
        j = seeds[bound[c]: bound[c + 1]]
        j = j[j > 0] - 1
        _deal(j, s[j], queue)
    queue = [[] for _ in range(sigma)]
    s_part: list[np.ndarray] = [np.zeros(0, np.int64)] * sigma
    for c in range(sigma - 1, -1, -1):
        parts, batch = [], _joined(queue[c])
        queue[c] = []
        while len(batch):
            parts.append(batch)
            j = batch[batch > 0] - 1
            j = j[smaller[j]]
            cj = s[j]
            here = cj == c
            below = cj < c
            _deal(j[below], cj[below], queue)
            batch = j[here]
        s_part[c] = _joined(parts)[::-1]
        j = l_part[c][::-1]
        j = j[j > 0] - 1
        j = j[smaller[j]]
        _deal(j, s[j], queue)
    s_part[0] = np.array([len(s) - 1])
    return np.concatenate([p for pair in zip(l_part, s_part) for p in pair])


def _names(s: np.ndarray, smaller: np.ndarray, lms: np.ndarray, ranked: np.ndarray) -> np.ndarray:
    """Ranks of the LMS substrings, equal ones alike; by position in ``lms``."""
    length = np.empty(len(s), np.int64)
    length[lms[:-1]] = np.diff(lms) + 1
    length[lms[-1]] = 1
    a, b = ranked[:-1], ranked[1:]
    same = length[a] == length[b]
    active = np.flatnonzero(same)
    k = 0
    while len(active):
        x, y = a[active] + k, b[active] + k
        equal = (s[x] == s[y]) & (smaller[x] == smaller[y])
        same[active[~equal]] = False
        k += 1
        active = active[equal]
        active = active[length[a[active]] > k]
    name = np.empty(len(s), np.int64)
    name[ranked] = np.concatenate([[0], np.cumsum(~same)])
    return name[lms]


def sort_names(names: np.ndarray) -> np.ndarray:
    """Suffix order of a string of names whose last one is its only smallest."""
    n = len(names)
    sa = np.argsort(names, kind="stable")
    sorted_names = names[sa]
    new = np.append(True, sorted_names[1:] != sorted_names[:-1])
    rank = np.empty(n, np.int64)
    rank[sa] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    slots = np.arange(n)
    step = 1
    while True:
        alone = new & np.append(new[1:], True)
        slots, new = slots[~alone], new[~alone]
        if not len(slots):
            return sa
        items = sa[slots]
        first, second = rank[items], rank[items + step]  # a tied suffix never reaches the end
        order = np.lexsort((second, first))
        items, first, second = items[order], first[order], second[order]
        sa[slots] = items
        new = np.append(True, (first[1:] != first[:-1]) | (second[1:] != second[:-1]))
        rank[items] = slots[np.maximum.accumulate(np.where(new, np.arange(len(slots)), 0))]
        step *= 2


def suffix_array(s: np.ndarray, sigma: int) -> np.ndarray:
    """Start positions of the suffixes of ``s`` in order.

    ``s`` holds whole numbers below ``sigma`` (a small alphabet) and ends with its only 0.
    """
    s = s.astype(np.uint16)
    if len(s) == 1:
        return np.zeros(1, np.int64)
    smaller = classify(s)
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    first = _induce(s, smaller, lms, sigma)
    is_lms = np.zeros(len(s), bool)
    is_lms[lms] = True
    ranked = first[is_lms[first]]
    names = _names(s, smaller, lms, ranked)
    n_names = int(names.max()) + 1
    if n_names < len(lms):
        lms_order = lms[sort_names(names)]
    else:
        lms_order = ranked
    return _induce(s, smaller, lms_order, sigma)


def permuted_common_prefixes(data: np.ndarray, sa: np.ndarray, cap: int) -> np.ndarray:
    """By text position: bytes shared with the suffix before it in the array, up to ``cap``.

    ``data`` is one byte per position; past its end all bytes differ. Eight bytes are
    compared at a time, for those positions only that still agree.
    """
    n = len(data)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    padded = np.concatenate([data, np.zeros(cap + 16, np.uint8)]).astype(np.uint64)
    word = padded[:-1] | (padded[1:] << np.uint64(8))
    word = word[:-2] | (word[2:] << np.uint64(16))
    word = word[:-4] | (word[4:] << np.uint64(32))
    common = np.zeros(n, np.int64)
    active = np.flatnonzero(before >= 0)
    k = 0
    while k < cap and len(active):
        x = word[active + k] ^ word[before[active] + k]
        equal = x == 0
        low = x[~equal]
        low = low & (~low + np.uint64(1))  # lowest set bit
        common[active[~equal]] = k + (np.log2(low.astype(np.float64)).astype(np.int64) >> 3)
        active = active[equal]
        k += 8
        common[active] = k
    room = n - np.maximum(before, np.arange(n))
    return np.minimum(common, np.minimum(room, cap))

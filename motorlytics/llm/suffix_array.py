"""Suffix arrays by induced sorting, and permuted common prefixes, for one shard of text.

The steps are those of induced sorting: classify suffixes as smaller or larger than the next, sort the leftmost smaller
ones (by their substrings, and recursively by the names of these), and induce all others in two linear scans. A scan goes in
runs of the array: all suffixes of a run are induced at once, up to the first place that the run itself would fill.
"""

from __future__ import annotations

import numpy as np

LEAST_RUN, MOST_RUN = 32, 1 << 18


def classified(s: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than the one after it; the last is."""
    rise = np.sign(s[1:] - s[:-1])
    n = len(s)
    settled = np.minimum.accumulate(np.where(rise != 0, np.arange(n - 1), n - 1)[::-1])[::-1]
    return np.append(np.append(rise, 1)[settled] > 0, True)


def ranked(chars: np.ndarray) -> np.ndarray:
    """For each char its number among equal ones before it."""
    n = len(chars)
    order = chars.argsort(kind="stable")
    ordered = chars[order]
    begin = np.arange(n)
    begin[1:][ordered[1:] == ordered[:-1]] = 0
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n) - np.maximum.accumulate(begin)
    return rank


def induced(s: np.ndarray, small: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The suffix array, given the leftmost smaller suffixes in their order (or their substrings' order, given any)."""
    n = len(s)
    ends = np.cumsum(sizes)
    heads, tails = ends - sizes, ends.copy()
    narrow = s.astype(np.uint16) if len(sizes) <= 1 << 16 else s
    sa = np.full(n, -1, np.int64)
    sa[ends[s[first]] - np.bincount(s[first], minlength=len(sizes))[s[first]] + ranked(narrow[first])] = first

    at, run = 0, LEAST_RUN
    while at < n:
        stop = min(n, at + run)
        here = sa[at:stop]
        source = (here > 0).nonzero()[0]
        before = here[source] - 1
        larger = (~small[before]).nonzero()[0]
        cut = stop
        if len(larger):
            source, before = source[larger], before[larger]
            chars = s[before]
            target = heads[chars] + ranked(narrow[before])
            cut = min(stop, int(target.min()))
            if cut < stop:
                now = int(source.searchsorted(cut - at))
                before, target, chars = before[:now], target[:now], chars[:now]
            sa[target] = before
            heads[chars] = target + 1  # of equal chars the last counts
        run = min(MOST_RUN, 2 * run) if cut == stop else max(LEAST_RUN, 2 * (cut - at))
        at = cut

    filled = sa >= 0
    filled[filled] = small[sa[filled]]
    filled[0] = False
    sa[filled] = -1
    at, run = n, LEAST_RUN
    while at > 0:
        stop = max(0, at - run)
        here = sa[stop:at][::-1]
        source = (here > 0).nonzero()[0]
        before = here[source] - 1
        smaller = small[before].nonzero()[0]
        cut = stop
        if len(smaller):
            source, before = source[smaller], before[smaller]
            chars = s[before]
            target = tails[chars] - 1 - ranked(narrow[before])
            cut = max(stop, int(target.max()) + 1)
            if cut > stop:
                now = int(source.searchsorted(at - cut))
                before, target, chars = before[:now], target[:now], chars[:now]
            sa[target] = before
            tails[chars] = target
        run = min(MOST_RUN, 2 * run) if cut == stop else max(LEAST_RUN, 2 * (at - cut))
        at = cut
    return sa


def sorted_suffixes(s: np.ndarray, n_chars: int) -> np.ndarray:
    """Suffix array of a string that ends in its only 0."""
    n = len(s)
    if n < 3:
        return np.arange(n)[::-1].copy()
    small = classified(s)
    leftmost = np.zeros(n, bool)
    leftmost[1:] = small[1:] & ~small[:-1]
    first = np.flatnonzero(leftmost)
    sizes = np.bincount(s, minlength=n_chars)
    sa = induced(s, small, first, sizes)
    order = sa[leftmost[sa]]
    length = np.zeros(n, np.int64)
    length[first] = np.diff(np.append(first, n - 1)) + 1
    same = np.flatnonzero(length[order[1:]] == length[order[:-1]])
    if len(same):  # equal substrings get one name
        a, b, size = order[same], order[same + 1], length[order[same]]
        begin = np.cumsum(size) - size
        step = np.arange(int(size.sum())) - np.repeat(begin, size)
        alike = np.logical_and.reduceat(s[np.repeat(a, size) + step] == s[np.repeat(b, size) + step], begin)
        same = same[alike]
    new = np.ones(len(order), np.int64)
    new[same + 1] = 0
    names = np.cumsum(new) - 1
    if names[-1] + 1 < len(order):
        named = np.empty(n, np.int64)
        named[order] = names
        order = first[sorted_suffixes(named[first], int(names[-1]) + 1)]
    return induced(s, small, order, sizes)


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of a byte array in order."""
    if not len(text):
        return np.zeros(0, np.int64)
    return sorted_suffixes(np.append(text.astype(np.int64) + 1, 0), 257)[1:]


def common_prefixes(text: np.ndarray, sa: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """By place in the text: the length of the prefix that its suffix shares with the one before it in order, and the place
    of that one (-1: none).

    Only where the characters before the two differ (or there are none) is text compared; elsewhere the length is that of
    the place before less one.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    place = np.arange(n)
    follows = (place > 0) & (before > 0)
    follows[follows] = text[place[follows] - 1] == text[before[follows] - 1]
    start = np.flatnonzero(~follows)
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    eight = np.zeros(n + 1, np.uint64)
    for i in range(8):
        eight |= padded[i : n + 1 + i].astype(np.uint64) << np.uint64(8 * i)
    shared = np.zeros(n, np.int64)
    at = start[before[start] >= 0]
    while len(at):
        a, b = at + shared[at], before[at] + shared[at]
        differs = eight[np.minimum(a, n)] ^ eight[np.minimum(b, n)]
        low = differs & (~differs + np.uint64(1))
        step = np.where(differs == 0, 8, np.bitwise_count(low - np.uint64(1)).astype(np.int64) // 8)
        shared[at] = np.minimum(shared[at] + step, n - np.maximum(at, before[at]))
        at = at[(differs == 0) & (shared[at] + np.maximum(at, before[at]) < n)]
    origin = np.maximum.accumulate(np.where(follows, 0, place))
    return shared[origin] - (place - origin), before

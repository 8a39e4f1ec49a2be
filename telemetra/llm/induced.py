"""Suffix arrays by induced sorting and capped permuted common prefixes, in whole-array numpy steps.

Where only some suffixes are wanted, the others are left out of the induction; the substrings between leftmost smaller
positions, which tell the order that it starts from, are named for the whole text.
"""

from __future__ import annotations

import numpy as np

#: Largest alphabet that is sorted bucket by bucket; names beyond it are ranked by doubling.
MOST_BUCKETS = 1024


def s_types(s: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one (the end counts as smallest)."""
    rising = np.zeros(len(s), bool)
    rising[:-1] = s[:-1] < s[1:]
    equal = np.flatnonzero(s[:-1] == s[1:])
    if len(equal):  # as the last of its run of equal characters
        last = np.flatnonzero(np.append(np.diff(equal) > 1, True))
        rising[equal] = np.repeat(rising[equal[last] + 1], np.diff(last, prepend=-1))
    return rising


def _deal(sa, at, items, chars, step):
    """Puts items behind (step 1) or before (-1) the pointers of their characters' buckets, keeping their order."""
    order = np.argsort(chars, kind="stable")  # buckets are few: a radix sort
    chars = chars[order]
    new = np.flatnonzero(np.append(True, chars[1:] != chars[:-1]))
    n = np.diff(np.append(new, len(chars)))
    own = chars[new]
    sa[np.repeat(at[own] - step * new, n) + step * np.arange(len(chars))] = items[order]
    at[own] += step * n


def induce(s: np.ndarray, rising: np.ndarray, part: np.ndarray, seeds: np.ndarray, size: int) -> np.ndarray:
    """Order of the suffixes of ``part``, induced from the leftmost smaller suffixes that follow its stretches, in their
    given order. A stretch of ``part`` ends before such a suffix or at the end of the text."""
    n, none = len(s), np.iinfo(s.dtype).max
    buckets = np.concatenate([[0], np.cumsum(np.bincount(s[part], minlength=size))])
    sa = np.zeros(buckets[-1], np.int32 if n < 1 << 31 else np.int64)
    larger, smaller = np.full(n, none, s.dtype), np.full(n, none, s.dtype)  # character before a suffix, if it is to be placed and of that type
    before = s[:-1]
    np.copyto(larger[1:], before, where=part[:-1] & ~rising[:-1])
    np.copyto(smaller[1:], before, where=part[:-1] & rising[:-1])

    def give(items: np.ndarray, chars: np.ndarray, at: np.ndarray, step: int) -> None:
        chars = chars[items]
        here = np.flatnonzero(chars != none)
        if len(here):
            _deal(sa, at, items[here] - 1, chars[here], step)

    placed = seeds[np.argsort(s[seeds], kind="stable")].astype(sa.dtype)
    cuts = np.concatenate([[0], np.cumsum(np.bincount(s[seeds], minlength=size))])
    head = buckets[:-1].copy()
    if n and part[n - 1]:
        sa[head[s[n - 1]]] = n - 1  # induced by the end of the text
        head[s[n - 1]] += 1
    for c in range(size):
        lo = buckets[c]
        while lo < head[c]:  # entries that this bucket gives itself come in waves
            lo, hi = head[c], lo
            give(sa[hi:lo], larger, head, 1)
        if cuts[c] < cuts[c + 1]:
            give(placed[cuts[c]:cuts[c + 1]], larger, head, 1)
    tail = buckets[1:] - 1  # L suffixes fill the buckets up to head
    for c in range(size - 1, -1, -1):
        hi = buckets[c + 1] - 1
        while hi > tail[c]:
            hi, lo = tail[c], hi
            give(sa[hi + 1:lo + 1][::-1], smaller, tail, -1)
        if buckets[c] < head[c]:
            give(sa[buckets[c]:head[c]][::-1], smaller, tail, -1)
    return sa


def by_doubling(names: np.ndarray, depth: int, wanted: np.ndarray) -> np.ndarray:
    """Order of the ``wanted`` suffixes (their starts) of a text of ranks, at least by their first ``depth`` ranks."""
    n, rank, k = len(names), names, 1
    while True:  # ranks by k names become ranks by as many times k as fit into a number
        wide = (int(rank.max()) + 1).bit_length()
        times = min(64 // wide, max(2, -(-depth // k)))
        ahead = np.zeros(n + times * k, np.uint64)
        ahead[:n] = rank
        ahead[:n] += np.uint64(1)
        last = times * k >= min(depth, n)
        key = np.zeros(len(wanted) if last else n, np.uint64)
        for j in range(times):
            key <<= np.uint64(wide)
            key |= ahead[wanted + j * k] if last else ahead[j * k:j * k + n]
        order = np.argsort(key)  # ties get the same rank
        if last:
            return wanted[order]
        new = np.append(False, np.diff(key[order]) != 0)
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new)
        k *= times
        if new[1:].all():
            return wanted[np.argsort(rank[wanted])]


def suffix_array(s: np.ndarray, depth: int | None = None, wanted: np.ndarray | None = None) -> np.ndarray:
    """Starts of all suffixes in order (an end sorts first); with ``depth``, by at least that many first characters;
    with ``wanted``, a mark for each start, of those only: no others are sorted but what their order is induced from."""
    n = len(s)
    depth = n if depth is None else depth
    wanted = np.ones(n, bool) if wanted is None else wanted
    if n < 2 or not wanted.any():
        return np.flatnonzero(wanted)
    size = int(s.max()) + 1
    if size > MOST_BUCKETS:
        return by_doubling(s, depth, np.flatnonzero(wanted))
    s = s.astype(np.uint8 if size < 255 else np.uint16)
    rising = s_types(s)
    lms = np.flatnonzero(rising[1:] & ~rising[:-1]) + 1
    # from a wanted suffix up to the next leftmost smaller one each is induced by its successor
    edges = np.concatenate([[0], lms, [n]])
    total = np.concatenate([[0], np.cumsum(wanted, dtype=np.int32 if n < 1 << 31 else np.int64)])
    part = total[1:] > np.repeat(total[edges[:-1]], np.diff(edges))
    seeds = lms[:0]
    if len(lms):
        sown = total[edges[1:-1]] > total[edges[:-2]]  # those after a stretch that holds a wanted suffix
        names = name(s, lms, size)
        # a name stands for two characters at least, and one more follows the last name
        seeds = lms[suffix_array(names, max(1, depth // 2), sown)]
    sa = induce(s, rising, part, seeds, size)
    return sa[wanted[sa]]


def name(s: np.ndarray, lms: np.ndarray, size: int) -> np.ndarray:
    """Ranks of the substrings from each leftmost smaller position to the next (equal ones share a rank). Characters are
    compared several at a time, as a number; what has ended counts as larger than what goes on, as its last character is
    of the smaller type there and of the larger type where it goes on."""
    n, wide = len(s), (size + 1).bit_length()
    per = 64 // wide
    code = np.zeros(n + per + 1, s.dtype)  # 0 is the end of the text
    code[:n] = s
    code[:n] += 1
    length = np.diff(lms, append=n) + 1
    ended = np.array([(1 << wide * (per - k)) - 1 for k in range(per + 1)], np.uint64)

    def chars(which: np.ndarray | slice, k: int) -> np.ndarray:
        at, left = np.minimum(lms[which] + k, n), np.clip(length[which] - k, 0, per)
        key = np.zeros(len(at), np.uint64)
        for j in range(per):
            key <<= np.uint64(wide)
            key |= code[at + j]
        return key | ended[left]

    key = chars(slice(None), 0)
    order = np.argsort(key)
    key = key[order]
    new = np.append(True, key[1:] != key[:-1])
    at, k = np.arange(len(order)), per  # places in order that may be tied
    while True:
        first = np.flatnonzero(new[at])
        number = np.diff(np.append(first, len(at)))
        open_ = (number > 1) & (np.maximum.reduceat(length[order[at]], first) > k)
        at = at[np.repeat(open_, number)]
        if not len(at):
            break
        group, which = np.cumsum(new[at]), order[at]
        key = chars(which, k)
        by = np.lexsort((key, group))
        order[at], key = which[by], key[by]
        new[at[1:]] |= key[1:] != key[:-1]
        k += per
    names = np.empty(len(lms), np.int64)
    names[order] = np.cumsum(new) - 1
    return names


def common_prefixes(data: np.ndarray, sa: np.ndarray, most: int) -> np.ndarray:
    """Permuted common prefixes: for each start in ``sa`` the bytes it shares with the start before it in order,
    capped at ``most``, in the order of the text (0 for starts that ``sa`` lacks)."""
    plcp = np.zeros(len(data), np.int32)
    a, b = sa[1:], sa[:-1]
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    word = np.ndarray((len(data),), "<u8", padded, strides=(1,))
    room, k = np.minimum(most, len(data) - np.maximum(a, b)), 0
    while len(a):
        odd = word[a + k] ^ word[b + k]
        differ = odd != 0
        low = odd[differ] & (~odd[differ] + np.uint64(1))
        equal = np.log2(low.astype(np.float64)).astype(np.int32) // 8
        plcp[a[differ]] = np.minimum(k + equal, room[differ])
        k += 8
        full = ~differ & (room <= k)
        plcp[a[full]] = room[full]
        more = ~differ & (room > k)
        a, b, room = a[more], b[more], room[more]
    return plcp

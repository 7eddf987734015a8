"""Suffix arrays by induced sorting, in array operations.

The textbook's scan places one suffix at a time. Here a whole run of buckets
is scanned at once whenever nothing in it induces into it: where a bucket can
induce to is known from the text alone (the characters before its suffixes).
A bucket that induces into itself holds runs of one character; all suffixes of
a run are placed at once, since how far each is from the run's end gives their
order. The same holds at every level of the recursion, whatever its alphabet.
"""

from __future__ import annotations

import numpy as np

FEW = 64


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Suffix array of ``s``; its last character must be 0 and occur only there."""
    s = np.asarray(s, np.int32)
    n = len(s)
    if n <= 2:
        return np.arange(n)[::-1].copy()
    small = _types(s)
    lms = (np.nonzero(small[1:] & ~small[:-1])[0] + 1).astype(np.int32)
    buckets = _Buckets(s, small)
    order = buckets.induce(lms)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    by_substring = order[is_lms[order]]
    names = _names(s, lms, by_substring)
    name_of = np.empty(n, np.int32)
    name_of[by_substring] = names
    reduced = name_of[lms]
    if names[-1] + 1 < len(lms):
        by_suffix = lms[suffix_array(reduced)]
    else:
        by_suffix = by_substring  # all names differ
    return buckets.induce(by_suffix)


def _types(s: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than the next one (the last counts as smaller)."""
    n = len(s)
    differs = np.append(s[:-1] != s[1:], True)
    # the next place where neighbours differ decides a run of equal characters
    grows = np.append(s[:-1] < s[1:], True)
    place = np.nonzero(differs)[0]
    return np.repeat(grows[place], np.diff(place, prepend=-1))


def _names(s: np.ndarray, lms: np.ndarray, by_substring: np.ndarray) -> np.ndarray:
    """Names of the sorted LMS substrings: equal substrings share one."""
    length = np.ones(len(s), np.int64)
    length[lms[:-1]] = np.diff(lms) + 1  # up to and with the next LMS character
    a, b = by_substring[:-1], by_substring[1:]
    same = length[a] == length[b]
    live = np.nonzero(same)[0]
    d = 0
    while len(live) > FEW:
        live = live[length[a[live]] > d]
        differ = s[a[live] + d] != s[b[live] + d]
        same[live[differ]] = False
        live = live[~differ]
        d += 1
    for i in live.tolist():  # the few that are left may be long
        x, y, size = int(a[i]), int(b[i]), int(length[a[i]])
        same[i] = np.array_equal(s[x + d:x + size], s[y + d:y + size])
    return np.concatenate(([0], np.cumsum(~same)))


class _Buckets:
    """A text's buckets: suffixes of one first character, large ones first."""

    def __init__(self, s: np.ndarray, small: np.ndarray):
        self.s, self.small = s, small
        size = int(s.max()) + 1
        counts = np.bincount(s, minlength=size)
        self.ends = np.cumsum(counts)
        self.starts = self.ends - counts
        self.n_large = np.bincount(s[~small], minlength=size)
        # where each bucket induces to: nearest large (small) character before its suffixes
        before, at, is_small = s[:-1], s[1:], small[:-1]
        self.large_to = np.full(size, size)
        np.minimum.at(self.large_to, at[~is_small], before[~is_small])
        self.small_to = np.full(size, -1)
        np.maximum.at(self.small_to, at[is_small], before[is_small])
        self.up, self.down = self._runs(), self._runs_down()
        new = np.append(True, s[1:] != s[:-1])
        self.run_start = np.nonzero(new)[0][np.cumsum(new) - 1].astype(np.int32)

    def _runs(self) -> list[tuple[int, int]]:
        # a run ends before the first bucket that any from its first one on induces to
        reach = np.minimum.accumulate(self.large_to[::-1])[::-1].tolist()
        out, c, size = [], 0, len(self.starts)
        while c < size:
            end = max(c + 1, reach[c])
            out.append((c, end))
            c = end
        return out

    def _runs_down(self) -> list[tuple[int, int]]:
        reach = np.maximum.accumulate(self.small_to).tolist()
        out, c = [], len(self.starts) - 1
        while c >= 0:
            end = min(c - 1, reach[c])
            out.append((end + 1, c + 1))
            c = end
        return out

    def induce(self, lms: np.ndarray) -> np.ndarray:
        """Sort all suffixes from the order of the LMS ones."""
        s, sa = self.s, np.full(len(self.s), -1, np.int32)
        chars = s[lms]
        by = np.argsort(chars, kind="stable")
        last = np.searchsorted(chars[by], np.arange(len(self.ends)), "right")
        sa[self.ends[chars[by]] - last[chars[by]] + np.arange(len(lms))] = lms[by]
        head = self.starts.copy()
        for lo, hi in self.up:
            if self.large_to[lo] == lo:
                at = int(self.starts[lo])
                part = self._unrolled(sa[at:head[lo]])
                head[lo] = at + len(part)
                sa[at:head[lo]] = part
                self._put_large(sa, part, head, lo)
                self._put_large(sa, sa[self.starts[lo] + self.n_large[lo]:self.ends[lo]], head)
            else:
                self._put_large(sa, sa[self.starts[lo]:self.ends[hi - 1]], head)
        sa[self._small_places()] = -1
        tail = self.ends.copy()
        for lo, hi in self.down:
            if self.small_to[lo] == lo:
                at = int(self.ends[lo])
                part = self._unrolled(sa[tail[lo]:at][::-1])[::-1]
                tail[lo] = at - len(part)
                sa[tail[lo]:at] = part
                self._put_small(sa, part, tail, lo)
                self._put_small(sa, sa[self.starts[lo]:self.starts[lo] + self.n_large[lo]], tail)
            else:
                self._put_small(sa, sa[self.starts[lo]:self.ends[hi - 1]], tail)
        sa[0] = len(s) - 1
        return sa

    def _small_places(self) -> np.ndarray:
        mark = np.zeros(len(self.s) + 1, np.int64)
        np.add.at(mark, self.starts + self.n_large, 1)
        np.add.at(mark, self.ends, -1)
        return np.cumsum(mark[:-1]) > 0

    def _unrolled(self, ends: np.ndarray) -> np.ndarray:
        """All suffixes in the runs that end at ``ends``, the nearest to the end first, then in that order."""
        size = ends - self.run_start[ends] + 1
        if not len(ends) or size.max() == 1:
            return ends.copy()
        back = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        return (np.repeat(ends, size) - back)[np.argsort(back, kind="stable")].astype(ends.dtype)

    def _put_large(self, sa: np.ndarray, scanned: np.ndarray, head: np.ndarray, done: int = -1) -> None:
        j = scanned[scanned > 0] - 1
        j = j[~self.small[j]]
        if done >= 0:
            j = j[self.s[j] != done]
        if len(j):
            by, chars, first, counts = _grouped(self.s[j])
            sa[np.repeat(head[chars] - first, counts) + np.arange(len(j))] = j[by]
            head[chars] += counts

    def _put_small(self, sa: np.ndarray, scanned: np.ndarray, tail: np.ndarray, done: int = -1) -> None:
        j = scanned[::-1]
        j = j[j > 0] - 1
        j = j[self.small[j]]
        if done >= 0:
            j = j[self.s[j] != done]
        if len(j):
            by, chars, first, counts = _grouped(self.s[j])
            sa[np.repeat(tail[chars] - 1 + first, counts) - np.arange(len(j))] = j[by]
            tail[chars] -= counts


def _grouped(chars: np.ndarray):
    """Stable order by character; each character, its first place and its count."""
    by = np.argsort(chars.astype(np.uint16) if chars.max() < 1 << 16 else chars, kind="stable")
    chars = chars[by]
    new = np.empty(len(chars), bool)
    new[0] = True
    np.not_equal(chars[1:], chars[:-1], out=new[1:])
    first = np.nonzero(new)[0]
    counts = np.empty_like(first)
    counts[:-1], counts[-1] = first[1:] - first[:-1], len(chars) - first[-1]
    return by, chars[first], first, counts


def common_prefixes(s: np.ndarray, sa: np.ndarray, most: int) -> np.ndarray:
    """Permuted common prefixes: for each position, how much its suffix shares
    with the one before it in ``sa``, up to ``most`` (0 for the first).

    Eight characters (below 2 ** 8), else four (below 2 ** 16) are compared at a
    time. The last one, 0, occurs once, so no comparison runs past the end.
    """
    n = len(s)
    lanes = 8 if s.max() < 1 << 8 else 4
    bits = 64 // lanes
    padded = np.zeros(n + most + 2 * lanes, f"<u{bits // 8}")
    padded[:n] = s
    data = padded.tobytes()
    many = np.empty(n + most, np.uint64)
    for lane in range(lanes):
        at = many[lane::lanes]
        at[:] = np.frombuffer(data, "<u8", len(at), lane * bits // 8)
    out = np.zeros(n, np.int64)
    live, other = sa[1:].astype(np.int64), sa[:-1].astype(np.int64)
    for d in range(0, most, lanes):
        differ = many[live + d] ^ many[other + d]
        same = differ == 0
        stop = differ[~same]
        stop &= ~stop + np.uint64(1)  # the lowest bit that differs tells the lane
        shared = sum((stop >> np.uint64(bits * k) > 0).astype(np.int64) for k in range(1, lanes))
        out[live[~same]] = np.minimum(d + shared, most)
        live, other = live[same], other[same]
        if not len(live):
            break
    out[live] = most
    return out

"""Per-stream DGIM folds (small helpers run inside Spark tasks).

Both folds are sequential by nature: bucket boundaries depend on the whole
history of a stream.  Spark distributes them by stream key; inside a task
the rows of one key arrive sorted by sequence number and are folded in a
streaming way with O(log N) state, so a key is never gathered in memory.

As written
    Every 1 appends a bucket of size 1; while there are at least three
    buckets and the third- and second-newest are equal they merge; from the
    N-th bit on the oldest bucket is dropped on every bit whatever its age,
    and the estimate adds ``2^i`` for the i-th dropped bucket.  The buckets
    other than the newest are always the binary digits of their sum, so the
    state is ``(rest, newest, discarded)``: dropping the oldest bucket
    removes the highest set bit of ``rest`` (or the newest bucket when
    ``rest`` is 0).

Published (Datar, Gionis, Indyk, Motwani)
    Buckets carry their end position; the oldest is dropped once it ends
    N or more positions ago; a 1 appends a bucket of size 1, and whenever
    three buckets share a size the two oldest of them merge (cascading);
    the estimate is the total minus half the oldest bucket.

    There are one or two buckets of each size up to the oldest, so the sizes are
    the digits 1 and 2 of the bijective base-2 numeral of their total, and the
    buckets hold the last ``total`` ones without a gap.  The whole state is
    therefore one number, the total (``follow_totals``): a one adds 1, and the
    oldest bucket's size leaves when the newest one in it is N positions old.
    With ``c`` ones among the last N bits the total is between ``c`` and
    ``2 c - 1``, so a block of a stream can be folded for every total it may start
    with, before the blocks in front of it are known.
"""

from __future__ import annotations

import numpy as np

WINDOW_N = 24  # fixed value: the reference's window size N
QUERY_K = 20   # fixed value: the reference's declared (unused) query length K


def highest_power(x: int) -> int:
    return 1 << (x.bit_length() - 1) if x > 0 else 0


class AsWritten:
    __slots__ = ("n", "t", "ones", "rest", "newest", "discarded")

    def __init__(self, n: int = WINDOW_N, t: int = 0, ones: int = 0, rest: int = 0,
                 newest: int = 0, discarded: int = 0):
        self.n, self.t, self.ones = n, t, ones
        self.rest, self.newest, self.discarded = rest, newest, discarded

    def step(self, bit: int) -> None:
        self.t += 1
        if bit == 1:
            self.ones += 1
            if self.newest:
                self.rest += 1
            else:
                self.newest = 1
        if self.t >= self.n and (self.rest or self.newest):
            if self.rest:
                self.rest -= highest_power(self.rest)
            else:
                self.newest = 0
            self.discarded += 1

    def buckets(self) -> list[int]:
        out = [1 << b for b in range(self.rest.bit_length() - 1, -1, -1) if self.rest >> b & 1]
        return out + ([1] if self.newest else [])

    def estimate(self) -> float:
        """``rest + newest + 2^discarded - 1``; infinite past the DOUBLE range
        (``discarded`` itself stays exact)."""
        power = 2.0 ** self.discarded if self.discarded < 1024 else float("inf")
        return float(self.rest + self.newest) + (power - 1.0)

    def state(self) -> tuple:
        return (self.t, self.ones, self.rest, self.newest, self.discarded)


class Published:
    __slots__ = ("n", "t", "sizes", "ends")

    def __init__(self, n: int = WINDOW_N, t: int = 0, sizes=None, ends=None):
        self.n, self.t = n, t
        self.sizes = list(sizes or [])   # oldest first
        self.ends = list(ends or [])

    def step(self, bit: int) -> None:
        self.t += 1
        if self.sizes and self.ends[0] <= self.t - self.n:
            del self.sizes[0]
            del self.ends[0]
        if bit != 1:
            return
        self.sizes.append(1)
        self.ends.append(self.t)
        size = 1
        while True:
            idx = [i for i, s in enumerate(self.sizes) if s == size]
            if len(idx) < 3:
                break
            a, b = idx[0], idx[1]
            self.sizes[a:b + 1] = [2 * size]
            self.ends[a:b + 1] = [self.ends[b]]
            size *= 2

    def estimate(self) -> int:
        if not self.sizes:
            return 0
        return sum(self.sizes) - self.sizes[0] // 2


def oldest_size(total: np.ndarray) -> np.ndarray:
    """Size of the oldest bucket when the buckets hold ``total`` ones."""
    digits = np.frexp((total + 1).astype(np.float64))[1] - 1  # floor(log2(total + 1))
    return np.where(total > 0, 1 << np.maximum(digits - 1, 0), 0)


def possible_totals(recent: int) -> list[int]:
    """The totals that a stream with ``recent`` ones among its last N bits may
    have: all these ones are in buckets, and so is the oldest bucket's newest."""
    return [t for t in range(recent, max(2 * recent, 1)) if t - highest_power((t + 1) >> 1) < max(recent, 1)]


def follow_totals(bits: np.ndarray, begin: np.ndarray, end: np.ndarray, totals: np.ndarray, n: int,
                  after: np.ndarray | None = None) -> np.ndarray:
    """Totals after the bits ``begin[i]:end[i]`` of each block i, from each of
    ``totals[i]`` at its start; all blocks go forward together.

    ``bits`` holds the blocks end to end, each after (up to) the ``n`` bits
    before it.  ``after`` receives the total after each bit, for one start."""
    ones = np.append(np.flatnonzero(bits), -n - 1)  # the last is never hit
    before = np.append(0, np.cumsum(bits, dtype=np.int64))
    order = np.argsort(begin - end, kind="stable")  # longest first
    now, length = begin[order].copy(), (end - begin)[order]
    state = totals[order].astype(np.int64)
    size = oldest_size(np.arange(2 * n + int(totals.max(initial=0)) + 2))
    for step in range(int(length.max(initial=0))):
        active = int(np.searchsorted(-length, -step, side="left"))
        here, part = now[:active], state[:active]
        oldest = size[part]
        newest_in_it = ones[before[here][:, None] - part + oldest - 1]
        part -= oldest * (newest_in_it == (here - n)[:, None])
        part += bits[here][:, None]
        if after is not None:
            after[here] = part[:, 0]
        here += 1
    out = np.empty_like(state)
    out[order] = state
    return out


def suffix_totals(bits: np.ndarray, at: np.ndarray, totals: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The query for the last ``k`` bits at the places ``at`` of ``bits`` (each
    bit included): total of the buckets that end among them, and the size of the
    oldest such bucket, read off the bucket list from its newest end."""
    ones = np.append(np.flatnonzero(bits), -k - 1)
    until = np.cumsum(bits, dtype=np.int64)[at]
    found, oldest = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    left, size = totals.astype(np.int64), 1
    while (left > 0).any():  # the digits of the numeral: 1 when odd, else 2
        digit = np.where(left > 0, 2 - left % 2, 0)
        for nth in (1, 2):
            inside = (digit >= nth) & (ones[until - found - 1] > at - k) & (found + size <= totals)
            found += size * inside
            oldest = np.where(inside, size, oldest)
        left, size = (left - digit) // 2, 2 * size
    return found, oldest


class Totals:
    """The published rule for one stream in bounded state: bits seen, total and
    the last N bits."""
    __slots__ = ("n", "t", "total", "recent")

    def __init__(self, n: int = WINDOW_N, t: int = 0, total: int = 0, recent: bytes = b""):
        self.n, self.t, self.total = n, t, total
        self.recent = np.frombuffer(recent, np.uint8)  # the last N bits, a byte each

    def feed(self, bits: np.ndarray) -> np.ndarray:
        """Totals after each of ``bits``."""
        held = len(self.recent)
        every = np.concatenate([self.recent, bits.astype(np.uint8)])
        ones, seen = np.flatnonzero(every).tolist(), int(self.recent.sum())
        out, total, n = [], self.total, self.n
        for i, bit in enumerate(every[held:].tolist(), held):
            if total:
                oldest = 1 << (total + 1).bit_length() - 2
                if ones[seen - total + oldest - 1] == i - n:
                    total -= oldest
            total += bit
            seen += bit
            out.append(total)
        self.t, self.total, self.recent = self.t + len(bits), total, every[-n:]
        return np.array(out, np.int64)


def buckets_of(total: np.ndarray) -> np.ndarray:
    """Number of buckets that hold ``total`` ones."""
    digits = np.frexp((total + 1).astype(np.float64))[1] - 1
    above = total + 1 - (1 << digits)
    return digits + np.bitwise_count(above.astype(np.uint64)).astype(np.int64)

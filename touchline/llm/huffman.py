"""Canonical, length-limited Huffman coding of whole-number ids, vectorised over blocks.

A code book is an array of (id, length); codes follow from the lengths. A block is coded on its own: its bits, and the
number of bits of every run of ``RUN`` ids, so that decoding can start at any run and follows all runs side by side.
"""

from __future__ import annotations

import numpy as np

LIMIT = 18  # longest code in bits
RUN = 32


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Lengths of at most ``limit`` bits with the least total for the counts (package-merge); one id gets one bit."""
    n = len(counts)
    if n > 1 << limit:
        raise ValueError(f"{n} ids don't fit into codes of {limit} bits")
    if n <= 1:
        return np.ones(n, np.int64)
    order = np.argsort(counts, kind="stable")
    leaves = np.asarray(counts, np.float64)[order]
    is_leaf, values, flags = [], leaves, np.ones(n, bool)
    for _ in range(limit):
        is_leaf.append(flags)
        both = np.concatenate([leaves, values[: len(values) // 2 * 2].reshape(-1, 2).sum(axis=1)])
        place = np.argsort(both, kind="stable")
        values, flags = both[place], place < n
    lengths = np.zeros(n, np.int64)
    needed = 2 * n - 2
    for flags in reversed(is_leaf):
        taken = int(flags[:needed].sum())
        lengths[:taken] += 1
        needed = 2 * (needed - taken)
    out = np.empty(n, np.int64)
    out[order] = lengths
    return out


class Book:
    """The codes of ids, in order of (length, id)."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, limit: int = LIMIT):
        order = np.lexsort((ids, lengths))
        self.ids, self.lengths, self.limit = ids[order].astype(np.uint32), lengths[order].astype(np.int64), limit
        # The code of an id is the number of limit-bit strings below it, cut to its length.
        share = np.left_shift(1, limit - self.lengths)
        first = np.cumsum(share) - share
        self.codes = np.right_shift(first, limit - self.lengths)
        size = int(self.ids.max()) + 1 if len(ids) else 0
        self.code_of, self.length_of = np.zeros(size, np.uint64), np.zeros(size, np.int64)
        self.code_of[self.ids], self.length_of[self.ids] = self.codes.astype(np.uint64), self.lengths
        self.table_id = np.zeros(1 << limit, np.uint32)
        self.table_length = np.ones(1 << limit, np.uint32)
        self.table_id[: share.sum()] = np.repeat(self.ids, share)
        self.table_length[: share.sum()] = np.repeat(self.lengths, share)

    def encode(self, ids: np.ndarray) -> tuple[bytes, bytes]:
        """The bits of a block, and as uint16 the number of bits of each of its runs."""
        if not len(ids):
            return b"", b""
        lengths = self.length_of[ids]
        ends = np.cumsum(lengths)
        starts = ends - lengths
        # A code starts in one 32-bit word and may go on in the next; every word has a start, as codes are shorter.
        at = starts >> 5
        shifted = self.code_of[ids] << (64 - (starts & 31) - lengths).astype(np.uint64)
        pairs = np.add.reduceat(shifted, np.flatnonzero(np.diff(at, prepend=-1)))
        words = np.zeros(len(pairs) + 1, np.uint64)
        words[:-1] = pairs >> np.uint64(32)
        words[1:] += pairs & np.uint64(0xFFFFFFFF)
        runs = np.diff(ends[np.minimum(np.arange(RUN - 1, len(ids) + RUN - 1, RUN), len(ids) - 1)], prepend=0)
        bits = words.astype(">u4").tobytes()[: (int(ends[-1]) + 7) // 8]
        return bits, runs.astype("<u2").tobytes()

    def decode(self, bits: bytes, runs: bytes, count: int) -> np.ndarray:
        """The ids of a block of ``count`` ids."""
        if not count:
            return np.zeros(0, np.uint32)
        raw = np.frombuffer(bits + b"\0\0\0\0", np.uint8).astype(np.uint32)
        windows = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]
        sizes = np.frombuffer(runs, "<u2").astype(np.uint32)
        at = np.cumsum(sizes, dtype=np.uint32) - sizes
        out = np.empty((len(sizes), RUN), np.uint32)
        drop, mask = np.uint32(32 - self.limit), np.uint32((1 << self.limit) - 1)
        last = np.uint32(len(windows) - 1)
        for step in range(RUN):
            entry = (windows[np.minimum(at >> 3, last)] >> (drop - (at & 7))) & mask
            out[:, step] = self.table_id[entry]
            at += self.table_length[entry]
        return out.reshape(-1)[:count]

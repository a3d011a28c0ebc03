"""Sorted sets of offsets in containers, for picking the k-th member.

Offsets are parted by their upper 48 bits; the lower 16 of one part are held in
the smallest of three forms: an array of members, a bitmap of 65,536 bits, or
runs of neighbours. Cumulative cardinalities say which container holds the
k-th member; it is then looked up inside that container only.
"""

from __future__ import annotations

import struct

import numpy as np

ARRAY, BITMAP, RUNS = range(3)
BITMAP_BYTES = 1 << 13
HEAD = struct.Struct("<qBI")


def container(low: np.ndarray) -> tuple[int, np.ndarray]:
    """The smallest form of sorted distinct 16-bit numbers: kind and payload."""
    breaks = np.flatnonzero(np.diff(low) != 1) + 1
    if 4 * (len(breaks) + 1) < min(2 * len(low), BITMAP_BYTES):
        starts = low[np.concatenate([[0], breaks])]
        ends = low[np.concatenate([breaks - 1, [len(low) - 1]])]
        return RUNS, np.concatenate([starts, ends - starts]).astype("<u2")
    if 2 * len(low) <= BITMAP_BYTES:
        return ARRAY, low.astype("<u2")
    bits = np.zeros(1 << 16, np.uint8)
    bits[low] = 1
    return BITMAP, np.packbits(bits, bitorder="little").view("<u8")


def select_in(kind: int, payload: np.ndarray, k: int) -> int:
    """Member number ``k`` (from 0) of one container."""
    if kind == ARRAY:
        return int(payload[k])
    if kind == RUNS:
        starts, more = payload.reshape(2, -1).astype(np.int64)
        ends = np.cumsum(more + 1)
        run = int(np.searchsorted(ends, k, side="right"))
        return int(starts[run] + k - (ends[run] - more[run] - 1))
    ends = np.cumsum(np.bitwise_count(payload), dtype=np.int64)
    word = int(np.searchsorted(ends, k, side="right"))
    before = int(ends[word - 1]) if word else 0
    inside = np.flatnonzero(np.unpackbits(payload[word : word + 1].view(np.uint8), bitorder="little"))
    return 64 * word + int(inside[k - before])


class BoundarySet:
    """A set of offsets; ``select(k)`` is the k-th smallest."""

    def __init__(self, keys: list[int], containers: list[tuple[int, np.ndarray]], counts: list[int]):
        self.keys, self.containers, self.counts = keys, containers, counts
        self.ends = np.cumsum(np.array(counts, np.int64))

    @classmethod
    def of(cls, offsets: np.ndarray) -> BoundarySet:
        """From sorted distinct offsets from 0 on."""
        if not len(offsets):
            return cls([], [], [])
        high = offsets >> 16
        cuts = [0, *(np.flatnonzero(high[1:] != high[:-1]) + 1).tolist(), len(offsets)]
        parts = [(a, b) for a, b in zip(cuts, cuts[1:])]
        return cls(
            [int(high[a]) for a, _ in parts], [container(offsets[a:b] & 0xFFFF) for a, b in parts], [b - a for a, b in parts]
        )

    def __len__(self) -> int:
        return int(self.ends[-1]) if len(self.ends) else 0

    def select(self, k: int) -> int:
        if not 0 <= k < len(self):
            raise IndexError(k)
        at = int(np.searchsorted(self.ends, k, side="right"))
        before = int(self.ends[at - 1]) if at else 0
        return (self.keys[at] << 16) + select_in(*self.containers[at], k - before)

    def to_bytes(self) -> bytes:
        """All heads (part, kind, cardinality), then all payloads."""
        heads = [HEAD.pack(key, kind, n) for key, (kind, _), n in zip(self.keys, self.containers, self.counts)]
        sizes = np.array([p.nbytes for _, p in self.containers], "<u4").tobytes()
        return b"".join([struct.pack("<I", len(heads)), *heads, sizes, *(p.tobytes() for _, p in self.containers)])

    @classmethod
    def from_bytes(cls, data: bytes) -> BoundarySet:
        (n,) = struct.unpack_from("<I", data)
        heads = [HEAD.unpack_from(data, 4 + i * HEAD.size) for i in range(n)]
        at = 4 + n * HEAD.size
        sizes = np.frombuffer(data, "<u4", n, at)
        at += 4 * n
        containers = []
        for (_, kind, _), size in zip(heads, sizes.tolist()):
            containers.append((kind, np.frombuffer(data[at : at + size], "<u8" if kind == BITMAP else "<u2")))
            at += size
        return cls([h[0] for h in heads], containers, [h[2] for h in heads])

"""A minimal perfect hash function by levels of collision-free bits, built and asked with whole arrays."""

from __future__ import annotations

import numpy as np

from ._common import mix64

#: Bits a key that is still to be placed, on each level.
GAMMA = 2
LEVELS = 40


class MinimalPerfectHash:
    """Maps n distinct 16-byte keys to 0 … n-1. Other keys get any slot or -1, so answers must be checked.

    On each level every key left is hashed to a bit; bits that exactly one key hits belong to that key, the others go
    on to the next level. A key's slot is the number of set bits before its own. Keys left after the last level are
    listed; equal keys, which always are, raise an error.
    """

    def __init__(self, keys: np.ndarray):
        left, self.n = keys, len(keys)
        self.levels: list[tuple[np.ndarray, int]] = []
        base = 0
        for level in range(LEVELS):
            if not len(left):
                break
            size = max(64, GAMMA * len(left))
            at = self.place(left, level, size)
            hits = np.bincount(at, minlength=size)
            alone = hits == 1
            ranks = np.where(alone, base + np.cumsum(alone) - 1, -1).astype(np.int32)
            self.levels.append((ranks, size))
            base += int(alone.sum())
            left = left[~alone[at]]
        self.rest = {bytes(k): base + i for i, k in enumerate(left.view("S16").ravel().tolist())} if len(left) else {}
        if len(self.rest) < len(left):
            raise ValueError("keys are not distinct")

    @staticmethod
    def place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        seed = np.uint64((level * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64))
        return (mix64(mix64(keys[:, 0] ^ seed) + keys[:, 1]) % np.uint64(size)).astype(np.int64)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, np.int64)
        rest = np.arange(len(keys))
        for level, (ranks, size) in enumerate(self.levels):
            got = ranks[self.place(keys[rest], level, size)]
            out[rest] = got
            rest = rest[got < 0]
            if not len(rest):
                return out
        if self.rest:
            for i in rest.tolist():
                out[i] = self.rest.get(keys[i].tobytes().rstrip(b"\0"), -1)
        return out


def digest_keys(digests: np.ndarray) -> np.ndarray:
    """The first 16 bytes of 32-byte digests (an array of shape (n, 32)) as two integers."""
    return np.ascontiguousarray(digests[:, :16]).view(np.uint64).reshape(-1, 2)

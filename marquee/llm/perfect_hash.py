"""A minimal perfect hash of 64-bit keys with stored fingerprints."""

from __future__ import annotations

import io

import numpy as np

# Bits per key in a level; more makes fewer levels and a larger index.
SLACK = 2.0
LEVELS = 48


def mixed(keys: np.ndarray, salt: int) -> np.ndarray:
    """Well spread 64-bit numbers, others for each salt."""
    x = keys.astype(np.uint64) + np.uint64((salt + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


class PerfectHash:
    """Distinct keys to 0 .. n-1 in constant time.

    Level by level, keys that fall alone on a bit of a level keep it; the others try the next
    level. A key's slot is the number of bits set before its own. Unknown keys mostly fall on
    no bit, and those that do are told by the fingerprint.
    """

    def __init__(self, levels: list[np.ndarray], prints: np.ndarray):
        self.levels, self.prints = levels, prints
        counts = [int(x.sum()) for x in levels]
        self.before = np.cumsum([0, *counts])
        self.ranks = [np.cumsum(x, dtype=np.int64) - x for x in levels]

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        left, levels = keys.astype(np.uint64), []
        while len(left):
            if len(levels) == LEVELS:
                raise ValueError("keys must be distinct")
            size = max(int(len(left) * SLACK), 64)
            at = (mixed(left, len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            left = left[~alone[at]]
        made = cls(levels, np.zeros(len(keys), np.uint32))
        made.prints[made._slots(keys.astype(np.uint64))] = cls.fingerprint(keys)
        return made

    @staticmethod
    def fingerprint(keys: np.ndarray) -> np.ndarray:
        return (mixed(keys, 255) >> np.uint64(32)).astype(np.uint32)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        slots = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for k, bits in enumerate(self.levels):
            at = (mixed(keys[left], k) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[at]
            slots[left[hit]] = self.before[k] + self.ranks[k][at[hit]]
            left = left[~hit]
        return slots

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, or -1 where its fingerprint is not the stored one."""
        keys = keys.astype(np.uint64)
        slots = self._slots(keys)
        known = slots >= 0
        known[known] = self.prints[slots[known]] == self.fingerprint(keys[known])
        return np.where(known, slots, -1)

    def pack(self, **values: np.ndarray) -> bytes:
        """The index as bytes, with arrays of values by slot."""
        out = io.BytesIO()
        np.savez(out, sizes=np.array([len(x) for x in self.levels], np.int64), prints=self.prints,
                 bits=np.concatenate([np.packbits(x) for x in self.levels] or [np.zeros(0, np.uint8)]),
                 **{f"by_slot_{k}": v for k, v in values.items()})
        return out.getvalue()

    @classmethod
    def unpack(cls, data: bytes) -> tuple[PerfectHash, dict[str, np.ndarray]]:
        with np.load(io.BytesIO(data)) as held:
            levels, at = [], 0
            for size in held["sizes"]:
                end = at + (size + 7) // 8
                levels.append(np.unpackbits(held["bits"][at:end], count=size).astype(bool))
                at = end
            values = {k[8:]: held[k] for k in held.files if k.startswith("by_slot_")}
            return cls(levels, held["prints"]), values

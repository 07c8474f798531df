"""Static binary-fuse filter over 64-bit keys (Graf and Lemire, 2022): three
positions in consecutive segments, 8-bit fingerprints, false positives 1/256."""

from __future__ import annotations

import struct

import numpy as np


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser (multiply and shift) of the seeded keys."""
    h = keys + np.uint64(seed)
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return h ^ (h >> np.uint64(33))


class FuseFilter:
    def __init__(self, seed: int, segment: int, segments: int, table: np.ndarray):
        self.seed, self.segment, self.segments, self.table = seed, segment, segments, table

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(keys x 3 positions in three consecutive segments, fingerprints)."""
        h = _mix(keys, self.seed)
        start = ((h >> np.uint64(32)) * np.uint64(self.segments) >> np.uint64(32)).astype(np.int64)
        mask = np.uint64(self.segment - 1)
        g = _mix(h, 0x9E3779B97F4A7C15)
        within = [(g >> np.uint64(s) & mask).astype(np.int64) for s in (0, 20, 40)]
        places = np.stack([(start + k) * self.segment + w for k, w in enumerate(within)], axis=1)
        return places, (h & np.uint64(255) ^ (g >> np.uint64(56))).astype(np.uint8)

    @classmethod
    def build(cls, keys: np.ndarray) -> "FuseFilter":
        """Keys must be distinct. Peels, round by round, all keys that are alone
        at one of their positions; another seed is tried if some remain."""
        n = len(keys)
        segment = 1 << max(2, min(18, int(np.log(max(n, 2)) / np.log(3.33) + 2.25)))
        size = n * max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 3)))
        segments = max(1, int(np.ceil(size / segment)) - 2)
        for seed in range(1, 1000):
            f = cls(seed * 0x2545F4914F6CDD1D & (1 << 64) - 1, segment, segments, np.zeros((segments + 2) * segment, dtype=np.uint8))
            places, prints = f._places(keys)
            if (rounds := f._peel(places)) is not None:
                for who, at in reversed(rounds):
                    own = places[who]
                    value = prints[who].copy()
                    for k in range(3):
                        value ^= np.where(own[:, k] == at, 0, f.table[own[:, k]]).astype(np.uint8)
                    f.table[at] = value
                return f
        raise RuntimeError("the keys are not distinct")

    def _peel(self, places: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]] | None:
        slots = len(self.table)
        count = np.bincount(places.ravel(), minlength=slots)
        key_xor = np.zeros(slots, dtype=np.int64)
        ids = np.arange(len(places))
        for k in range(3):
            np.bitwise_xor.at(key_xor, places[:, k], ids)
        rounds, left = [], len(places)
        free = np.flatnonzero(count == 1)
        while len(free):
            who, first = np.unique(key_xor[free], return_index=True)
            at = free[first]
            rounds.append((who, at))
            left -= len(who)
            touched = places[who].ravel()
            np.subtract.at(count, touched, 1)
            np.bitwise_xor.at(key_xor, touched, np.repeat(who, 3))
            touched = np.unique(touched)
            free = touched[count[touched] == 1]
        return rounds if left == 0 else None

    def contains(self, keys: np.ndarray) -> np.ndarray:
        places, prints = self._places(keys)
        return self.table[places[:, 0]] ^ self.table[places[:, 1]] ^ self.table[places[:, 2]] == prints

    def to_bytes(self) -> bytes:
        return struct.pack("<QQQ", self.seed, self.segment, self.segments) + self.table.tobytes()

    @classmethod
    def from_bytes(cls, b: bytes) -> "FuseFilter":
        return cls(*struct.unpack_from("<QQQ", b), np.frombuffer(b, dtype=np.uint8, offset=24))

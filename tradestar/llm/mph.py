"""Minimal perfect hash of 64-bit keys: levels of bits, each key owns a bit of the first level where no other key fell on it.

A level keeps its bits and, for every ``BLOCK`` of them, the number of set bits before
it, so that a key's slot is read from one block of each level it passes.
"""

from __future__ import annotations

import numpy as np

SPREAD = 1.5
#: Bits for which a level counts the set bits before them.
BLOCK = 512


def mix(keys, seed: int):
    """64-bit finaliser over keys and seed."""
    x = np.asarray(keys).astype(np.int64).view(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & (2**64 - 1))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def fingerprint(keys):
    return mix(keys, 1_000_003).astype(np.uint32)


def build(keys) -> list:
    """Levels as (number of bits, packed bits in whole blocks, set bits before each block over all levels) for distinct keys."""
    levels, left, before = [], np.asarray(keys, dtype=np.int64), 0
    while len(left):
        width = max(8, int(len(left) * SPREAD))
        at = (mix(left, len(levels)) % np.uint64(width)).astype(np.int64)
        alone = np.bincount(at, minlength=-(-width // BLOCK) * BLOCK) == 1
        set_bits = alone.reshape(-1, BLOCK).sum(axis=1)
        levels.append((width, np.packbits(alone), (before + np.cumsum(set_bits) - set_bits).astype("<u8")))
        left, before = left[~alone[at]], before + int(set_bits.sum())
    return levels


def slots(levels, keys):
    """Slot of each key, from 0 without gaps over the keys the levels were built from; -1 or any slot for another key."""
    keys = np.asarray(keys, dtype=np.int64)
    out, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
    for seed, (width, packed, ranks) in enumerate(levels):
        at = (mix(keys[left], seed) % np.uint64(width)).astype(np.int64)
        mine = packed[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1 == 1
        at = at[mine]
        block = np.unpackbits(packed.reshape(-1, BLOCK // 8)[at // BLOCK], axis=1)
        block[np.arange(BLOCK) >= (at % BLOCK)[:, None]] = 0
        out[left[mine]] = ranks[at // BLOCK].astype(np.int64) + block.sum(axis=1, dtype=np.int64)
        left = left[~mine]
    return out

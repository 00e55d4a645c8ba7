"""Bloom filters in blocks, merged block by block on the executors.

A key falls into one block and sets two bits there. Tasks send the keys of a block as pairs of bit
positions, so what is shuffled follows the number of distinct keys and not the size of the filter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Bits of a block; positions in it fit in 16 bits.
BLOCK_BITS = 1 << 16


def places(hashes: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block of each 64-bit hash, and its two bit positions in the block as (n, 2)."""
    block = (hashes >> np.uint64(32)) % np.uint64(blocks)
    bits = np.empty((len(hashes), 2), "<u2")
    bits[:, 0] = hashes & np.uint64(0xFFFF)
    bits[:, 1] = (hashes >> np.uint64(16)) & np.uint64(0xFFFF)
    return block.astype(np.int64), bits


def key_rows(once: np.ndarray, often: np.ndarray, blocks: int) -> pa.RecordBatch:
    """Keys of a task by block: those it has in one document, those it has in several."""
    hashes = np.concatenate([once, often])
    repeats = np.zeros(len(hashes), bool)
    repeats[len(once) :] = True
    block, bits = places(hashes, blocks)
    order = np.lexsort((repeats, block))
    block, bits, repeats = block[order], bits[order], repeats[order]
    heads = np.flatnonzero(np.r_[True, block[1:] != block[:-1]]) if len(block) else np.zeros(0, int)
    tails = np.r_[heads[1:], len(block)].astype(int) if len(block) else heads
    middles = [a + int(np.searchsorted(repeats[a:b], True)) for a, b in zip(heads, tails)]
    return pa.RecordBatch.from_pydict(
        {
            "block": pa.array(block[heads], pa.int32()),
            "once": pa.array([bits[a:m].tobytes() for a, m in zip(heads, middles)], pa.binary()),
            "often": pa.array([bits[m:b].tobytes() for m, b in zip(middles, tails)], pa.binary()),
        }
    )


KEY_ROWS = "block int, once binary, often binary"


def _twice_seen(group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fold the keys of one block, batch by batch, into a once-seen and a twice-seen filter; return
    the second."""
    seen, again, block = np.zeros(BLOCK_BITS, bool), np.zeros(BLOCK_BITS, bool), 0
    for batch in group:
        block = batch.column(0)[0].as_py()
        for once, often in zip(batch.column(1), batch.column(2)):
            a = np.frombuffer(once.as_py(), "<u2").reshape(-1, 2)
            b = np.frombuffer(often.as_py(), "<u2").reshape(-1, 2)
            again[a[seen[a].all(axis=1)]] = True
            again[b] = True
            seen[a] = seen[b] = True
    if again.any():
        yield pa.RecordBatch.from_pydict(
            {
                "block": pa.array([block], pa.int32()),
                "bits": pa.array([np.packbits(again).tobytes()], pa.binary()),
            }
        )


def twice_filter(keys: DataFrame, blocks: int) -> np.ndarray:
    """Bits of the twice-seen filter, `blocks` x 8 KB, whatever the number of keys."""
    folded = keys.groupBy("block").applyInArrow(_twice_seen, "block int, bits binary")
    bits = np.zeros((blocks, BLOCK_BITS // 8), np.uint8)
    for row in folded.toLocalIterator():
        bits[row["block"]] = np.frombuffer(row["bits"], np.uint8)
    return bits


def may_contain(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    block, places_ = places(hashes, len(bits))
    found = np.ones(len(hashes), bool)
    for i in range(2):
        at = places_[:, i].astype(np.int64)
        found &= (bits[block, at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
    return found

"""Votes of hashes on the bits of a fingerprint, shared by the SimHash operators."""

from __future__ import annotations

import numpy as np

#: Row b holds the bits of the byte b, lowest first.
BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.float64)


def set_weights(hashes: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
    """For each bit, the summed weight of the hashes that have it set.

    ``hashes`` is rows x words of uint64.  Each byte column is counted by value
    first, so the work per hash is one count per byte and not one per bit.
    """
    rows = np.ascontiguousarray(hashes).view(np.uint8).reshape(len(hashes), -1)
    columns = rows.shape[1]
    flat = (rows + np.arange(columns, dtype=np.int32) * 256).ravel()
    repeated = None if weights is None else np.repeat(weights, columns)
    counts = np.bincount(flat, repeated, minlength=columns * 256).reshape(columns, 256)
    return (counts @ BYTE_BITS).ravel()


def packed(bits: np.ndarray) -> bytes:
    return np.packbits(bits, bitorder="little").tobytes()

"""Sorted keys and their values in compressed chunks, one for each batch and bucket."""

from __future__ import annotations

import numpy as np
import pandas as pd


def squeeze(values: np.ndarray) -> bytes:
    """Whole numbers below 2**32 as byte planes."""
    import zstandard

    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def squeeze_keys(keys: np.ndarray) -> bytes:
    """Ascending 64-bit keys as the byte planes of their differences."""
    import zstandard

    steps = np.diff(keys, prepend=np.uint64(0))
    planes = np.ascontiguousarray(steps.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unsqueeze_keys(raw: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(8, -1)
    with np.errstate(over="ignore"):
        return np.cumsum(np.ascontiguousarray(planes.T).reshape(-1).view("<u8"), dtype=np.uint64)


def unsqueeze(raw: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view("<u4").astype(np.int64)


def gather(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """(distinct keys, their summed counts, place of every chunk entry among them, chunk lengths)."""
    keys = [unsqueeze_keys(x) for x in rows["keys"]]
    counts = np.concatenate([unsqueeze(x) for x in rows["counts"]])
    distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
    return distinct, np.bincount(place, counts, len(distinct)).astype(np.int64), place, [len(k) for k in keys]

"""A batch of texts as one flat array of bytes, with words and their hashes found column-wise."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from pairloom.llm.common import mix64

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15 | 1


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, np.uint64)
    if n:
        out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


class FlatTexts:
    """``data``: all bytes; text i is ``data[bounds[i]:bounds[i + 1]]``; words by ``starts``, ``ends``, ``owner``.

    Words never reach over the end of a text. ``hashes`` are 64-bit hashes of the words' bytes.
    """

    def __init__(self, texts: pa.Array, lower: bool = False):
        texts = texts.cast(pa.large_binary())
        n = len(texts)
        offsets = np.zeros(1, np.int64)
        if n:
            offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
        body = texts.buffers()[2]
        body = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
        self.data = body[offsets[0] : offsets[-1]]
        if lower:
            capital = (self.data >= 65) & (self.data <= 90)
            self.data = self.data + capital.astype(np.uint8) * np.uint8(32)
        self.bounds = (offsets - offsets[0]).astype(np.int64)
        self.space = _SPACE[self.data]
        inside = ~self.space
        first = inside.copy()
        first[1:] &= self.space[:-1]
        at = self.bounds[:-1][self.bounds[:-1] < self.bounds[1:]]
        first[at] = inside[at]
        last = inside.copy()
        last[:-1] &= self.space[1:]
        at = self.bounds[1:][self.bounds[:-1] < self.bounds[1:]] - 1
        last[at] = inside[at]
        self.starts, self.ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.owner = np.searchsorted(self.bounds, self.starts, side="right") - 1
        self.words = np.bincount(self.owner, minlength=n).astype(np.int64)
        self._hashes = None

    def __len__(self) -> int:
        return len(self.bounds) - 1

    @property
    def hashes(self) -> np.ndarray:
        if self._hashes is None:
            lengths = self.ends - self.starts
            if not len(lengths):
                self._hashes = np.zeros(0, np.uint64)
                return self._hashes
            inside = np.flatnonzero(~self.space)
            place = inside - np.repeat(self.starts, lengths)
            with np.errstate(over="ignore"):
                terms = (self.data[inside].astype(np.uint64) + np.uint64(1)) * _powers(int(lengths.max()))[place]
            at = np.cumsum(lengths) - lengths
            self._hashes = mix64(np.add.reduceat(terms, at) ^ (lengths.astype(np.uint64) << np.uint64(40)))
        return self._hashes

    def per_text(self, values: np.ndarray) -> np.ndarray:
        """Sums of a per-byte array over each text."""
        total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
        return total[self.bounds[1:]] - total[self.bounds[:-1]]

    def runs(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hashes, text, first word) of all runs of ``width`` words within a text."""
        n = max(len(self.owner) - width + 1, 0)
        at = np.flatnonzero(self.owner[:n] == self.owner[width - 1 :][:n])
        out = mix64(self.hashes[at])
        with np.errstate(over="ignore"):
            for k in range(1, width):
                out = mix64(out * np.uint64(3) + self.hashes[at + k])
        return out, self.owner[at], at

"""Words of Arrow text columns as numpy arrays, for functions that run inside tasks.

Texts are handled as UTF-8 bytes; a word is a run of bytes that a table maps to
something other than 0. Words get 64-bit hashes, so that no Python object is
made per word. A batch is cut into pieces of bounded size; one document is never
cut, but its words are hashed piece by piece.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Bytes of text handled at once, unless one document has more.
PIECE = 1 << 20
# Bytes hashed at once.
_STRETCH = 1 << 19

_WHITE = b"\x20\x09\x0a\x0b\x0c\x0d"
_MASK = (1 << 64) - 1


def _table(separators: bytes, lower: bool) -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    if lower:
        table[65:91] += 32
    table[list(separators)] = 0
    return table


# Words between white space, upper case kept or not; and runs of ASCII letters,
# digits and everything beyond ASCII. A zero byte inside a word counts as 1.
SPACED = _table(_WHITE, lower=False)
SPACED[0] = 1
SPACED_LOWER = _table(_WHITE, lower=True)
SPACED_LOWER[0] = 1
ALNUM_LOWER = _table(bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]), lower=True)

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, _MASK, 256, dtype=np.uint64)
_BASE = int(_rng.integers(1, _MASK, dtype=np.uint64)) | 1
_STEP = np.uint64(int(_rng.integers(1, _MASK, dtype=np.uint64)) | 1)
_powers: dict[str, np.ndarray] = {}


def _powers_of(base: int, name: str, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        steps = np.full(max(n, _STRETCH + 1), base, dtype=np.uint64)
        steps[0] = 1
        have = _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (a bijection)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


class Words:
    """Words of some documents in order: hashes, and where each document's begin.

    ``bounds`` has one entry more than there are documents; document ``d`` owns
    the words ``bounds[d]:bounds[d + 1]``. ``starts`` and ``ends`` are byte
    positions in ``data``.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, table: np.ndarray):
        self.data, self.offsets = data, offsets
        mapped = table[data]
        inside = mapped != 0
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        filled = offsets[:-1] < offsets[1:]
        heads, tails = offsets[:-1][filled], offsets[1:][filled] - 1
        first[heads] = inside[heads]
        last[tails] = inside[tails]
        self.starts = np.flatnonzero(first)
        self.ends = np.flatnonzero(last) + 1
        self.bounds = np.searchsorted(self.starts, offsets)
        self.mapped = mapped

    def __len__(self) -> int:
        return len(self.starts)

    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def documents(self) -> np.ndarray:
        """The document of each word."""
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts())

    def places(self) -> np.ndarray:
        """The position of each word in its document."""
        return np.arange(len(self)) - np.repeat(self.bounds[:-1], self.counts())

    def hashes(self) -> np.ndarray:
        out = np.empty(len(self), dtype=np.uint64)
        at = 0
        while at < len(self):
            upto = max(at + 1, int(np.searchsorted(self.ends, self.starts[at] + _STRETCH)))
            lo, hi = int(self.starts[at]), int(self.ends[upto - 1])
            powers = _powers_of(_BASE, "up", hi - lo)
            total = np.zeros(hi - lo + 1, dtype=np.uint64)
            np.cumsum(_BYTE[self.mapped[lo:hi]] * powers, out=total[1:])
            starts, ends = self.starts[at:upto] - lo, self.ends[at:upto] - lo
            down = _powers_of(pow(_BASE, -1, 1 << 64), "down", hi - lo)
            out[at:upto] = (total[ends] - total[starts]) * down[starts]
            at = upto
        return mix(out)


def rolling(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each ``k`` consecutive words (as if all belonged together)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    total = hashes[:n].copy()
    for j in range(1, k):
        total *= _STEP
        total += hashes[j : j + n]
    return mix(total)


def window_mask(bounds: np.ndarray, k: int, n: int) -> np.ndarray:
    """Which of the ``n`` starts leave room for ``k`` words in their document."""
    room = np.ones(max(n, 0), dtype=bool)
    if k > 1 and n > 0:
        counts = np.diff(bounds)
        last = bounds[1:]
        for j in range(1, k):
            at = last[counts >= j] - j
            room[at[at < n]] = False
    return room


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.empty(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    kind = np.int64 if wide else np.int32
    at = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, dtype=np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def pieces(batch: pa.RecordBatch, text: str, size: int = PIECE) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut a batch into runs of rows with at most ``size`` bytes of text (or one row)."""
    data, offsets = column_bytes(batch.column(text))
    at, n = 0, batch.num_rows
    while at < n:
        upto = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1)
        lo, hi = offsets[at], offsets[upto]
        yield batch.slice(at, upto - at), data[lo:hi], offsets[at : upto + 1] - lo
        at = upto


def id_array(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)

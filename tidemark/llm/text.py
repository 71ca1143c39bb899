"""Words and hashes of many texts at once, as numpy arrays over one buffer of UTF-8 bytes.

Texts are laid one after another with a newline behind each. Hashes are polynomials modulo 2^64 over random values per byte,
taken from running sums, then mixed; so each costs the same however long its word or window is.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes hashed in one go; bounds the temporary arrays, not the texts.
BLOCK = 1 << 18
BASE, BASE_INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
OTHER, OTHER_INVERSE = 0xD1342543DE82EF95, pow(0xD1342543DE82EF95, -1, 1 << 64)
SPACES = (0x20, *range(0x09, 0x0E))

_tables: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    have = _tables.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, BLOCK + 1), base, np.uint64)
        steps[0] = 1
        have = _tables[base] = np.cumprod(steps)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits, one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_values() -> np.ndarray:
    """One 64-bit value per byte, from a rule."""
    return mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(BASE))


def spans(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int, inverse: int) -> np.ndarray:
    """Polynomial hash of values[start:end] for each span; equal content gives equal hashes wherever it lies."""
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(base, len(values)), out=total[1:])
    return (total[ends] - total[starts]) * powers(inverse, len(values) + 1)[starts]


def rolling(values: np.ndarray, width: int, base: int = BASE, inverse: int = BASE_INVERSE) -> np.ndarray:
    """Hash of every run of `width` values, in blocks; position i covers values[i:i+width]."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.empty(n, np.uint64)
    for at in range(0, n, BLOCK):
        upto = min(n, at + BLOCK)
        part = values[at : upto + width - 1]
        first = np.arange(upto - at)
        out[at:upto] = spans(part, first, first + width, base, inverse)
    return mix(out)


def lay(texts: Sequence[str | None] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, starts): all texts as UTF-8, a newline behind each; text i is bytes[starts[i] : starts[i+1]-1]. Null is empty."""
    if isinstance(texts, (pa.Array, pa.ChunkedArray)):
        return _lay_column(texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts)
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    starts = np.zeros(len(raw) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in raw], out=starts[1:])
    raw.append(b"")
    return np.frombuffer(b"\n".join(raw), np.uint8), starts


def _lay_column(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """`lay` without a Python string per text."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False) + 1, out=starts[1:])
    texts = pa.concat_arrays([texts, pa.array([b""], pa.large_binary())])
    whole = pc.binary_join(pa.LargeListArray.from_arrays([0, len(texts)], texts), pa.scalar(b"\n", pa.large_binary()))
    return np.frombuffer(whole[0].as_buffer(), np.uint8), starts


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z as a-z, all other bytes as they are."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def hash_spans(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each ascending span of bytes and its length, in blocks; not mixed yet."""
    values, out, at, n = byte_values(), np.empty(len(begin), np.uint64), 0, len(begin)
    while at < n:
        # spans up to a block of bytes, one at least
        upto = max(at + 1, int(np.searchsorted(end, begin[at] + BLOCK, "right")))
        low = begin[at]
        part = values[data[low : end[upto - 1]]]
        out[at:upto] = spans(part, begin[at:upto] - low, end[at:upto] - low, BASE, BASE_INVERSE)
        at = upto
    return mix(out) + (end - begin).astype(np.uint64)


class Words:
    """The words of laid-out texts: byte range and hash of each, and the range of words of each text."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, hashed: bool = True, gaps: Sequence[int] = SPACES):
        gap = np.zeros(256, bool)
        gap[list(gaps)] = True
        inside = np.zeros(len(data) + 2, bool)
        np.logical_not(gap[data], out=inside[1:-1])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        small = np.int32 if len(data) < 1 << 31 else np.int64
        self.data, self.starts = data, starts
        self.begin, self.end = edges[0::2].astype(small), edges[1::2].astype(small)
        del edges, inside
        self.first = np.searchsorted(self.begin, starts)  # words of text i: first[i] .. first[i+1]-1
        if hashed:
            self.hash = mix(hash_spans(data, self.begin, self.end))

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash, start): every run of `width` words within one text, by the index of its first word."""
        hashes = rolling(self.hash, width)
        kind = self.begin.dtype
        room = np.repeat(self.first[1:].astype(kind), self.counts())[: len(hashes)]
        room -= np.arange(len(hashes), dtype=kind)
        start = np.flatnonzero(room >= width)
        return hashes[start], start

    def text_of(self, i: int, keep: np.ndarray | None = None) -> bytes:
        """The words of text i that are kept, joined by one space."""
        a, b = self.first[i], self.first[i + 1]
        at = np.arange(a, b) if keep is None else a + np.flatnonzero(keep[a:b])
        raw = self.data[self.starts[i] : self.starts[i + 1]].tobytes()
        low = self.starts[i]
        return b" ".join([raw[x:y] for x, y in zip((self.begin[at] - low).tolist(), (self.end[at] - low).tolist())])


def covered(start: np.ndarray, width: int, n: int) -> np.ndarray:
    """Mask over n places of those inside any [start, start+width)."""
    change = np.zeros(n + 1, np.int32)
    np.add.at(change, start, 1)
    np.add.at(change, start + width, -1)
    return np.cumsum(change[:n]) > 0

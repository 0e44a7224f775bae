"""Words of whole texts as 64-bit hashes, computed on Arrow's own byte buffers with numpy.

A word's hash is a polynomial over its bytes (a random 64-bit value per byte value,
an odd base, arithmetic modulo 2^64), read off running sums, then mixed.  Nothing is
done per word or per character in Python; texts are taken in slices of about
``SLICE_BYTES`` so that the temporary arrays stay small whatever the batch holds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 21


def _byte_values() -> np.ndarray:
    v = np.random.default_rng(20240601).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
    v[65:91] = v[97:123]  # A-Z count as a-z
    return v


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply), element by element."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class WordHasher:
    """``sep``: byte values that separate words (256 booleans)."""

    def __init__(self, sep: np.ndarray):
        self.sep, self.val = sep, _byte_values()
        self._grow(1)

    def _grow(self, n: int) -> None:
        base = np.uint64(0x9E3779B97F4A7C15)
        inv = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
        self.pow = np.cumprod(np.full(n, base), dtype=np.uint64)
        self.inv = np.cumprod(np.full(n, inv), dtype=np.uint64)

    def words(self, data: np.ndarray, offsets: np.ndarray):
        """``(hash, start, end, first)``: hash and byte range of every word; ``first[d]``:
        index of document d's first word (``first`` has one entry more than documents)."""
        n = len(data)
        if n == 0:
            z = np.zeros(0, np.int64)
            return np.zeros(0, np.uint64), z, z, np.zeros(len(offsets), np.int64)
        if len(self.pow) < n:
            self._grow(n)
        word = ~self.sep[data]
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        begins = word.copy()
        begins[1:] &= ~word[:-1] | edge[1:n]
        stops = word.copy()
        stops[:-1] &= ~word[1:] | edge[1:n]
        s = np.flatnonzero(begins)
        e = np.flatnonzero(stops) + 1
        c = np.zeros(n + 1, np.uint64)
        np.cumsum(self.val[data] * self.pow[:n], out=c[1:])
        h = mix((c[e] - c[s]) * self.inv[s] + (e - s).astype(np.uint64))
        return h, s, e, np.searchsorted(s, offsets)


WHITE_SPACE = np.zeros(256, bool)
WHITE_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, bytes, offsets)`` of consecutive rows of a string column, at most
    ``limit`` bytes unless one text alone is longer.  Null texts are empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    off = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(off, off[at] + limit, "right")) - 1)
        yield at, to, data[off[at] : off[to]], off[at : to + 1] - off[at]
        at = to


def batch_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def list_array(values: pa.Array, counts: np.ndarray) -> pa.ListArray:
    off = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=off[1:])
    return pa.ListArray.from_arrays(pa.array(off), values)


def shingles(h: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words inside a document, and the document of each.
    A document of fewer words has its whole sequence as one run; one of no words none."""
    lens = np.diff(first)
    doc = np.repeat(np.arange(len(lens)), lens)
    mult = [np.uint64(x) for x in np.random.default_rng(size).integers(1, 1 << 63, size, dtype=np.uint64) | np.uint64(1)]
    short = lens < size
    keep = np.arange(len(h)) + size <= first[1:][doc]
    at = np.flatnonzero(keep)
    out = np.zeros(len(at), np.uint64)
    for k in range(size):
        out += h[at + k] * mult[k]
    out, doc = mix(out), doc[at]
    if short.any():
        few = np.flatnonzero(short & (lens > 0))
        if len(few):
            whole = np.zeros(len(few), np.uint64)
            for k in range(size - 1):
                has = lens[few] > k
                whole[has] += h[first[:-1][few[has]] + k] * mult[k]
            whole = mix(whole + lens[few].astype(np.uint64))
            out, doc = np.concatenate([out, whole]), np.concatenate([doc, few])
            order = np.argsort(doc, kind="stable")
            out, doc = out[order], doc[order]
    return out, doc

"""Vectorised text kernels over Arrow string columns.

Words are maximal runs of bytes other than ASCII white space (0x20, 0x09-0x0D),
which is the same as runs of code points other than these. A word's 64-bit hash
is a polynomial in its bytes modulo 2**64, taken from prefix sums for all words
of a block at once, then mixed. Blocks are cut at white space, so memory is
bounded by the block size and the longest single word, not by the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20
_U = np.uint64
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_P = _U(0x9E3779B97F4A7C15)
_PINV = _U(pow(int(_P), -1, 2**64))
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_pow: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_pow[0]) < n:
        m = max(n, BLOCK + 65536)
        with np.errstate(over="ignore"):
            _pow[0] = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(m, _P, np.uint64))])
            _pow[1] = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(m, _PINV, np.uint64))])
    return _pow[0], _pow[1]


def released(run):  # noqa: ANN001, ANN201
    """The same task function; when it ends, the worker gives the memory it has freed back to the system.

    A worker serves many tasks, and what the allocators keep between them counts against its executor.
    """

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                import ctypes

                ctypes.CDLL("libc.so.6").malloc_trim(0)
            except (OSError, AttributeError):  # another C library
                pass

    return go


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
        return h ^ (h >> _U(31))


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and row offsets of a string column; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = column.buffers()
    o = np.frombuffer(offs, kind)[column.offset : column.offset + n + 1].astype(np.int64)
    b = np.frombuffer(data, np.uint8)[o[0] : o[-1]] if data is not None else np.zeros(0, np.uint8)
    return b, o - o[0]


def blocks(data: np.ndarray, offsets: np.ndarray, size: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Byte ranges of about ``size`` that end at a text's end or at white space."""
    at, end = 0, len(data)
    while at < end:
        to = min(at + size, end)
        if to < end:
            k = int(np.searchsorted(offsets, to, "right")) - 1
            if offsets[k] > at:
                to = int(offsets[k])
            else:
                stop = int(offsets[k + 1])
                while to < stop:
                    gap = np.flatnonzero(SPACE[data[to : min(to + 65536, stop)]])
                    if len(gap):
                        to += int(gap[0])
                        break
                    to = min(to + 65536, stop)
        yield at, to
        at = to


def hash_spans(piece: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The 64-bit hashes of byte ranges of one block."""
    up, down = _powers(len(piece) + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(_BYTE[piece] * up[: len(piece)], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = False, table: np.ndarray | None = None, space: np.ndarray | None = None, hashed: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end, row and hash of every word, in order.

    lower: A-Z count as a-z. table: bytes are looked up there first. space: which
    of the looked-up bytes separate words (ASCII white space if None).
    """
    sep = SPACE if space is None else space
    n = len(offsets) - 1
    s_all, e_all, h_all = [], [], []
    for a, z in blocks(data, offsets):
        piece = data[a:z]
        if table is not None:
            piece = table[piece]
        elif lower:
            piece = _LOWER[piece]
        blank = sep[piece]
        first = np.zeros(z - a, bool)
        lo, hi = np.searchsorted(offsets, [a, z])
        first[offsets[lo:hi][offsets[lo:hi] < z] - a] = True
        first[0] = True
        solid = ~blank
        start = solid.copy()
        start[1:] &= blank[:-1] | first[1:]
        end = solid
        end[:-1] &= blank[1:] | first[1:]
        s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
        s_all.append(s + a)
        e_all.append(e + a)
        if hashed:
            h_all.append(hash_spans(piece, s, e))
    cat = lambda x, t: np.concatenate(x) if x else np.zeros(0, t)
    s = cat(s_all, np.int64)
    row = np.searchsorted(offsets[1:], s, "right") if n else np.zeros(0, np.int64)
    return s, cat(e_all, np.int64), row, cat(h_all, np.uint64)


def shingles(hashes: np.ndarray, rows: np.ndarray, n_rows: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash and row of every run of ``width`` words; a shorter text's words are one run."""
    with np.errstate(over="ignore"):
        m = len(hashes)
        count = np.bincount(rows, minlength=n_rows)
        first = np.concatenate([[0], np.cumsum(count)])[:-1]
        if m >= width:
            acc = np.zeros(m - width + 1, np.uint64)
            for k in range(width):
                acc = acc * _P + hashes[k : m - width + 1 + k]
            ok = rows[: m - width + 1] == rows[width - 1 :]
            out, where = mix(acc[ok]), rows[: m - width + 1][ok]
        else:
            out, where = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        short = np.flatnonzero((count > 0) & (count < width))
        if len(short):
            extra = np.empty(len(short), np.uint64)
            for i, r in enumerate(short):
                h = _U(int(count[r]))
                for v in hashes[first[r] : first[r] + count[r]]:
                    h = h * _P + v
                extra[i] = h
            out = np.concatenate([out, mix(mix(extra))])
            where = np.concatenate([where, short])
        return out, where


def row_sets(hashes: np.ndarray, rows: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes of each row, ascending within it, and the rows' offsets."""
    order = np.lexsort((hashes, rows))
    h, r = hashes[order], rows[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    h, r = h[keep], r[keep]
    return h, np.concatenate([[0], np.cumsum(np.bincount(r, minlength=n_rows))]).astype(np.int64)


def list_array(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An Arrow list column of flat values."""
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values, kind))

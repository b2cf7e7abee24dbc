"""Words of whole texts as numpy arrays, straight from Arrow buffers.

A batch of texts is one UTF-8 byte buffer with row offsets. Words are maximal runs of bytes
outside an ASCII separator set (a UTF-8 continuation byte is never a separator), so a
boundary scan over bytes finds the same words as a scan over characters. Each word gets a
64-bit polynomial hash; bytes are folded through a 256-entry table, which is how A-Z are
lower-cased and separators are made to weigh nothing. Long texts are hashed in pieces of
whole words, so temporary memory follows ``PIECE`` and not the longest text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SPACE = bytes([0x20, *range(0x09, 0x0E)])  # the separators of the contracts: [\x20\x09-\x0D]
PIECE = 1 << 20
_MULT = 0x9E3779B97F4A7C15 | 1
_INV = pow(_MULT, -1, 1 << 64)


def splitmix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit mixer: equal inputs stay equal, all others look random."""
    x = x.astype(np.uint64, copy=True)
    x += np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & (2**64 - 1))
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def fold_table(lower: bool = True, zero: bytes = SPACE) -> np.ndarray:
    """A random 64-bit weight per byte; A-Z weigh as a-z if ``lower``; ``zero`` bytes weigh 0."""
    t = splitmix(np.arange(256, dtype=np.uint64), 7) | np.uint64(1)
    if lower:
        t[65:91] = t[97:123]
    t[np.frombuffer(zero, np.uint8)] = 0
    return t


def _powers(base: int, n: int) -> np.ndarray:
    p = np.empty(n, np.uint64)
    p[0] = 1
    k = 1
    while k < n:
        m = min(k, n - k)
        p[k:k + m] = p[:m] * np.uint64(pow(base, k, 1 << 64))
        k += m
    return p


_TABLES: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _TABLES or len(_TABLES["p"]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        _TABLES["p"], _TABLES["i"] = _powers(_MULT, size), _powers(_INV, size)
    return _TABLES["p"], _TABLES["i"]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and their row offsets (n + 1). A null counts as an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("").cast(pa.large_string())
    _, off, data = texts.buffers()
    off = np.frombuffer(off, np.int64)[texts.offset:texts.offset + len(texts) + 1] if off else np.zeros(len(texts) + 1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def word_bounds(data: np.ndarray, offsets: np.ndarray, sep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end (exclusive) byte of every word, and the words' row offsets (n + 1).

    ``sep``: 256 booleans, true for separator bytes. A row's end also ends its last word."""
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = ~sep[data]
    first, last = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < n)]
    first[cut] = inside[1:-1][cut]
    last[cut - 1] = inside[1:-1][cut - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(start, offsets)


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray, table: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span; spans ascend, and what lies between two must
    weigh 0 in ``table`` or be absent."""
    out = np.empty(len(start), np.uint64)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + PIECE, "right")))
        lo, hi = int(start[i]), int(end[j - 1])
        p, inv = _power_tables(hi - lo)
        v = table[data[lo:hi]]
        v *= p[:hi - lo]
        at = start[i:j] - lo
        out[i:j] = np.add.reduceat(v, at) * inv[at]
        i = j
    out ^= (end - start).astype(np.uint64) << np.uint64(40)
    return splitmix(out)


_SEP = np.zeros(256, bool)
_SEP[np.frombuffer(SPACE, np.uint8)] = True
_LOWER, _EXACT = fold_table(True), fold_table(False)


def words(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of a batch of texts and the words' row offsets (n + 1)."""
    data, off = text_bytes(texts)
    start, end, rows = word_bounds(data, off, _SEP)
    return hash_spans(data, start, end, _LOWER if lower else _EXACT), rows


def pieces(rows: np.ndarray, most: int):
    """Row ranges whose items number about ``most``, one row at least."""
    i, n = 0, len(rows) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(rows, rows[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = j


def arrow_schema(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    return to_arrow_schema(StructType.fromDDL(ddl))

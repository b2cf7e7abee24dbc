"""Ids of whole texts by the tokenizers library, one call a distinct unit instead of one a text.

The tokenizer's own splitting (letters, single digits, other characters; white space dropped) never
joins units, so a text's ids are its units' ids one after the other. Texts of plain Latin letters
are split with numpy on bytes, each distinct lower-cased unit is encoded once by the library, and
ids are gathered. Any text with a character for which that is not certain (other scripts,
apostrophes, control characters, strings of special tokens) goes through the library as a whole.
"""

from __future__ import annotations

import os
import sys
import types
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa

from . import arrays as A

MOST_UNITS = 1_500_000  # of the cache; it starts anew beyond


def _classes() -> np.ndarray:
    c = np.full(256, 3, np.uint8)
    c[np.frombuffer(A.SPACE, np.uint8)] = 0
    c[48:58] = 2
    c[65:91] = c[97:123] = 1
    c[128:] = 1
    return c


def _byte_chars() -> np.ndarray:
    """Byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on.
    The line break, which no unit holds, stays itself and parts the units."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in shown]
    out = np.arange(256, dtype="<u4")
    out[rest] = 256 + np.arange(len(rest))
    out[10] = 10
    return out


BYTE_CHARS = _byte_chars()
ODD = np.isin(np.arange(256), [*range(9), *range(14, 32), 39, 127])  # control characters, the apostrophe
NO_LETTER = ~np.isin(np.arange(256), [b for b in range(0x80, 0xC0) if b not in (0x97, 0xB7)])  # after 0xC3: all but the two signs
_CACHE = "_token_unit_caches"  # encoders outlive a task in its Python worker


def encoder(path: str) -> Encoder:
    """The worker's encoder of this vocabulary: distinct units are encoded once a worker, not once a task."""
    kept = sys.modules.setdefault(_CACHE, types.ModuleType(_CACHE)).__dict__
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tk = Tokenizer.from_file(path)
        self.cls, self.table = _classes(), A.fold_table(False, zero=b"")
        self._clear()

    def _clear(self) -> None:
        self.known, self.slot = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.flat, self.start, self.len = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _library(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tk.encode_batch(texts, add_special_tokens=False)]

    def _units(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units that the splitting keeps whole, and their number a unit, from the library's
        model itself; it takes bytes as the characters that the byte-level step maps them to."""
        size = end - start + 1
        at = np.cumsum(size) - size
        flat = np.full(int(size.sum()), 10, np.uint8)
        inside = np.ones(len(flat), bool)
        inside[at + size - 1] = False
        flat[inside] = data[(np.repeat(start - at, size) + np.arange(len(flat)))[inside]]
        piece = self.tk.model.tokenize
        text = BYTE_CHARS[flat].tobytes().decode("utf-32-le")
        ids = [[t.id for t in piece(u)] for u in text.split("\n")[:-1]]
        n = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.uint32, int(n.sum())), n

    def _plain(self, raw: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Rows whose texts the fast way covers."""
        b = ODD[raw]
        b[:-1] |= (raw[:-1] == 60) & (raw[1:] == 124)
        high = raw >= 128
        if high.any():
            lead = raw == 0xC3
            follow = np.zeros_like(lead)
            follow[1:] = lead[:-1]
            b |= (high & ~lead & ~follow) | (follow & NO_LETTER[raw])
        plain = np.ones(len(off) - 1, bool)
        plain[np.searchsorted(off, np.flatnonzero(b), "right") - 1] = False
        return plain

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and their row offsets (n + 1)."""
        raw, off = A.text_bytes(texts)
        plain = self._plain(raw, off) if len(raw) else np.ones(len(off) - 1, bool)
        data = raw.copy()
        big = (data >= 65) & (data <= 90)
        big[1:] |= (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E)
        data[big] += 32
        if not plain.all():
            data[np.repeat(~plain, np.diff(off))] = 32
        c = np.zeros(len(data) + 2, np.uint8)
        c[1:-1] = self.cls[data]
        mid, one = c[1:-1], c[1:-1] == 2
        first, last = (mid > 0) & ((mid != c[:-2]) | one), (mid > 0) & ((mid != c[2:]) | one)
        cut = off[1:-1]
        cut = cut[(cut > 0) & (cut < len(data))]
        first[cut] = mid[cut] > 0
        last[cut - 1] = mid[cut - 1] > 0
        start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        rows = np.searchsorted(start, off)
        at = self._slots(data, start, end) if len(start) else np.zeros(0, np.int64)
        size = self.len[at]
        total = np.concatenate([[0], np.cumsum(size)])
        ids = self.flat[np.repeat(self.start[at] - total[:-1], size) + np.arange(total[-1])]
        rows = total[rows]
        if plain.all():
            return ids, rows
        whole = self._library([texts[int(i)].as_py() for i in np.flatnonzero(~plain)])
        parts, w = [], iter(whole)
        for i, ok in enumerate(plain):
            parts.append(ids[rows[i]:rows[i + 1]] if ok else next(w))
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])

    def _slots(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = _hash(data, start, end, self.table)
        codes, uniq = pd.factorize(h)
        at = np.searchsorted(self.known, uniq)
        have = np.zeros(len(uniq), bool)
        inside = at < len(self.known)
        have[inside] = self.known[at[inside]] == uniq[inside]
        new = np.flatnonzero(~have)
        if len(new):
            if len(self.known) + len(new) > MOST_UNITS and len(self.known):
                self._clear()
                return self._slots(data, start, end)
            first = np.empty(len(uniq), np.int64)
            first[codes[::-1]] = np.arange(len(codes))[::-1]
            ids, n = self._units(data, start[first[new]], end[first[new]])
            self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(n) - n])
            self.len, self.flat = np.concatenate([self.len, n]), np.concatenate([self.flat, ids])
            known = np.concatenate([self.known, uniq[new]])
            slot = np.concatenate([self.slot, np.arange(len(self.len) - len(new), len(self.len))])
            order = np.argsort(known, kind="stable")
            self.known, self.slot = known[order], slot[order]
            at = np.searchsorted(self.known, uniq)
        return self.slot[at][codes]


def _hash(data: np.ndarray, start: np.ndarray, end: np.ndarray, table: np.ndarray) -> np.ndarray:
    """As arrays.hash_spans, with the spaces between units taken as weightless."""
    t = table.copy()
    t[np.frombuffer(A.SPACE, np.uint8)] = 0
    return A.hash_spans(data, start, end, t)

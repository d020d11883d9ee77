"""Tokenizer units: pieces of text that the tokenizer treats alike wherever they stand.

The tokenizers used here never form a token across the start of a run of white
space, nor between an ASCII letter or digit and ASCII punctuation other than an
apostrophe. Texts are cut there, each distinct piece is encoded once by the
library, and its ids are looked up for every other place. Texts with white space
outside ASCII or with the beginning of a special string go to the library whole.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa

from orilla.llm import textkernel as tk

_ALNUM = np.zeros(256, bool)
_ALNUM[48:58] = _ALNUM[65:91] = _ALNUM[97:123] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[33:48] = _PUNCT[58:65] = _PUNCT[91:97] = _PUNCT[123:127] = True
_PUNCT[39] = False
# fixed values: white space outside ASCII, in UTF-8
_WIDE_SPACE = (b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x80\x80", b"\xe2\x80\x81", b"\xe2\x80\x82", b"\xe2\x80\x83", b"\xe2\x80\x84", b"\xe2\x80\x85", b"\xe2\x80\x86", b"\xe2\x80\x87", b"\xe2\x80\x88", b"\xe2\x80\x89", b"\xe2\x80\x8a", b"\xe2\x80\xa8", b"\xe2\x80\xa9", b"\xe2\x80\xaf", b"\xe2\x81\x9f", b"\xe3\x80\x80")
_MARKS = (b"<|", *_WIDE_SPACE)
# letters that no normaliser changes but for case, so that a run of them is one word to every tokenizer here
_PLAIN = re.compile(" ?[A-Za-z\\u00c0-\\u00d6\\u00d8-\\u00f6\\u00f8-\\u00ff]+")


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies use for each byte: itself if printable in Latin-1, else the next free one from U+0100."""
    out, free = {}, 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174:
            out[b] = chr(b)
        else:
            out[b], free = chr(free), free + 1
    return out


_LETTER = _byte_letters()


class UnitEncoder:
    """Ids of whole texts by a ``tokenizers`` file, through a bounded cache of pieces.

    keep_space: white space belongs to the piece that follows it (byte-level BPE);
    otherwise it is dropped, as the tokenizer itself drops it.
    lower: the tokenizer lower-cases, so pieces are looked up with A-Z as a-z.
    """

    def __init__(self, path: str, keep_space: bool, lower: bool, most: int = 750_000) -> None:
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.keep_space, self.lower, self.most = keep_space, lower, most
        self._clear()

    def _clear(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.slot = np.zeros(0, np.int64)
        self.start = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _learn(self, fresh: np.ndarray, texts: list[str]) -> None:
        starts, ids = [self.start], [self.ids]
        total = int(self.start[-1])
        plain = [bool(_PLAIN.fullmatch(t)) for t in texts]
        order = sorted(range(len(texts)), key=plain.__getitem__)
        fresh, texts = fresh[order], [texts[i] for i in order]
        odd = len(texts) - sum(plain)
        for k in range(0, odd, 4096):
            part = texts[k : min(k + 4096, odd)]
            e = self.tok.encode(part, is_pretokenized=True, add_special_tokens=False)
            got = np.array(e.ids, np.uint32)
            of = np.array([-1 if w is None else w for w in e.word_ids], np.int64)
            n = np.bincount(of, minlength=len(part)) if len(of) else np.zeros(len(part), np.int64)
            starts.append(total + np.cumsum(n))
            ids.append(got)
            total += len(got)
        if odd < len(texts):
            one = self.tok.model.tokenize
            words = [t.lower() for t in texts[odd:]] if self.lower else texts[odd:]
            flat, sizes = [], []
            for t in words:
                got = one("".join(map(_LETTER.__getitem__, t.encode())) if not t.isascii() or t[0] == " " else t)
                sizes.append(len(got))
                flat += [x.id for x in got]
            starts.append(total + np.cumsum(np.array(sizes, np.int64)))
            ids.append(np.array(flat, np.uint32))
        slots = len(self.known) + np.arange(len(fresh))
        self.start, self.ids = np.concatenate(starts), np.concatenate(ids)
        order = np.argsort(known := np.concatenate([self.known, fresh]), kind="stable")
        self.known, self.slot = known[order], np.concatenate([self.slot, slots])[order]

    def _units(self, data: np.ndarray, offsets: np.ndarray, a: int, z: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and hash of the pieces in a block."""
        piece = data[a:z]
        first = np.zeros(z - a, bool)
        lo, hi = np.searchsorted(offsets, [a, z])
        first[offsets[lo:hi][offsets[lo:hi] < z] - a] = True
        first[0] = True
        blank, alnum, punct = tk.SPACE[piece], _ALNUM[piece], _PUNCT[piece]
        cut = first
        cut[1:] |= (alnum[1:] & punct[:-1]) | (punct[1:] & alnum[:-1])
        if self.keep_space:
            cut[1:] |= blank[1:] & ~blank[:-1]
            s = np.flatnonzero(cut)
            e = np.append(s[1:], z - a)
        else:
            cut[1:] |= blank[:-1]
            s = np.flatnonzero(cut & ~blank)
            stop = np.append(blank[1:] | cut[1:], True) & ~blank
            e = np.flatnonzero(stop) + 1
        return s, e, tk.hash_spans(tk._LOWER[piece] if self.lower else piece, s, e)

    def _whole(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Rows that the library gets whole."""
        raw = data.tobytes()
        leads = {m[:1] for m in _MARKS if m[:1] in raw}
        if not any(m in raw for m in _MARKS if m[:1] in leads):
            return np.zeros(0, np.int64)
        return np.array([i for i in range(len(offsets) - 1) if any(m in raw[offsets[i] : offsets[i + 1]] for m in _MARKS)], np.int64)

    def _look(self, piece: bytes, s: np.ndarray, e: np.ndarray, h: np.ndarray) -> np.ndarray:
        """The cache slots of pieces; new ones are encoded."""
        u, at, back = np.unique(h, return_index=True, return_inverse=True)
        if len(self.known) + len(u) > self.most and len(self.known):
            self._clear()
        k = np.minimum(np.searchsorted(self.known, u), max(len(self.known) - 1, 0))
        new = self.known[k] != u if len(self.known) else np.ones(len(u), bool)
        if new.any():
            self._learn(u[new], [piece[i:j].decode() for i, j in zip(s[at[new]].tolist(), e[at[new]].tolist())])
            k = np.searchsorted(self.known, u)
        return self.slot[k][back]

    def encode(self, column: pa.Array, want_ids: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Token counts of the rows and, if wanted, all ids in a row."""
        data, offsets = tk.utf8(column)
        n = len(offsets) - 1
        counts = np.zeros(n, np.int64)
        whole = self._whole(data, offsets)
        skip = np.zeros(n, bool)
        skip[whole] = True
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for a, z in tk.blocks(data, offsets):
            s, e, h = self._units(data, offsets, a, z)
            row = np.searchsorted(offsets[1:], s + a, "right")
            if len(whole):
                keep = ~skip[row]
                s, e, h, row = s[keep], e[keep], h[keep], row[keep]
            if not len(s):
                continue
            slot = self._look(data[a:z].tobytes(), s, e, h)
            begin, size = self.start[slot], self.start[slot + 1] - self.start[slot]
            counts += np.bincount(row, size, minlength=n).astype(np.int64)
            if want_ids:
                to = np.cumsum(size)
                found.append((np.repeat(row, size), self.ids[np.repeat(begin - (to - size), size) + np.arange(to[-1] if len(to) else 0)]))
        for i in whole:
            got = np.array(self.tok.encode(data[offsets[i] : offsets[i + 1]].tobytes().decode(), add_special_tokens=False).ids, np.uint32)
            counts[i] = len(got)
            found.append((np.full(len(got), i), got))
        if not want_ids:
            return counts, np.zeros(0, np.uint32)
        if not found:
            return counts, np.zeros(0, np.uint32)
        ids = np.concatenate([x for _, x in found])
        if len(whole):
            ids = ids[np.argsort(np.concatenate([r for r, _ in found]), kind="stable")]
        return counts, ids


_encoders: dict[tuple[str, bool, bool], UnitEncoder] = {}


def encoder(path: str, keep_space: bool, lower: bool) -> UnitEncoder:
    """The encoder of this Python worker; its cache serves all tasks that the worker runs."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    key = (path, keep_space, lower)
    if key not in _encoders:
        _encoders[key] = UnitEncoder(path, keep_space, lower)
    return _encoders[key]


def row_slices(column: pa.Array, most: int = 6_000_000) -> list[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes each, one row at least."""
    _, offsets = tk.utf8(column)
    out, a, n = [], 0, len(offsets) - 1
    while a < n:
        z = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, "right")) - 1)
        out.append((a, min(z, n)))
        a = z
    return out

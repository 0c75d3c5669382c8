"""Units of texts as arrays: cut, digested, looked up in a packed table, and pieced together, many texts at a time.

Texts are held as one array of code points. A unit's digest is a polynomial of its code points modulo
2^64, and a unit found by digest counts only if its code points are the stored ones.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np

MARK = "\u2581"
#: Code points handled at a time; a longer text is cut where a unit must begin.
CHUNK = 1 << 18
OTHER, MARKED, LETTER, SINGLE = range(4)
_MIX, _BASE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_EDGE = re.compile(f"(?<=[^ {MARK}])[ {MARK}]")


@lru_cache(1)
def kinds() -> np.ndarray:
    """The kind of each code point: mark, letter, single (digits and line ends), other."""
    table = np.fromiter((LETTER if unicodedata.category(chr(c))[0] == "L" else OTHER for c in range(0x110000)), np.uint8, 0x110000)
    table[ord(MARK)] = MARKED
    table[[ord(c) for c in "0123456789\n"]] = SINGLE
    return table


@lru_cache(1)
def _powers(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, _BASE)]))


def segments(text: str, most: int = CHUNK) -> Iterator[str]:
    """The text with a space before it, in parts of about `most` characters; each part but the first begins with a mark or
    space after another character, where a unit always begins."""
    at, lead = 0, " "
    while len(text) - at > most:
        edge = _EDGE.search(text, at + most)
        if edge is None:
            break
        yield lead + text[at : edge.start()]
        at, lead = edge.start(), ""
    yield lead + text[at:]


class Units:
    """The units of a batch of segments. string: the segments with spaces as marks, joined; code: its code points; start: where
    units begin, with the end appended; bounds: the number of units before each segment, with the total appended."""

    def __init__(self, parts: list[str], fine: bool):
        self.string = "".join(parts).replace(" ", MARK)
        self.code = np.frombuffer(self.string.encode("utf-32-le", "surrogatepass"), np.uint32)
        sizes = np.cumsum([len(p) for p in parts], dtype=np.int64)
        n = len(self.code)
        kind = kinds()[self.code]
        first = np.empty(n, bool)
        mark = kind == MARKED
        if n:
            first[0] = True
        first[1:] = mark[1:] & ~mark[:-1]
        if fine:
            single = kind == SINGLE
            first[1:] |= single[1:] | single[:-1] | ((kind[1:] != kind[:-1]) & ~mark[:-1])
        first[sizes[:-1]] = True
        begins = np.flatnonzero(first)
        self.start = np.append(begins, n)
        self.size = np.diff(self.start)
        self.bounds = np.concatenate([[0], np.searchsorted(begins, sizes)])
        self.inner = np.arange(n) - np.repeat(begins, self.size)

    def digests(self) -> np.ndarray:
        if not len(self.size):
            return np.empty(0, np.uint64)
        longest = 1 << max(6, int(self.size.max() - 1).bit_length())
        x = (self.code.astype(np.uint64) + np.uint64(1)) * _MIX
        x ^= x >> np.uint64(31)
        x *= _powers(longest)[self.inner]
        h = np.add.reduceat(x, self.start[:-1]) + self.size.astype(np.uint64)
        h = (h ^ (h >> np.uint64(29))) * _MIX
        return h ^ (h >> np.uint64(32))

    def unit(self, k: int) -> str:
        return self.string[self.start[k] : self.start[k + 1]]


class UnitTable:
    """Units with the ids of their pieces: sorted digests, and flat arrays of code points and ids."""

    def __init__(self, packed: Iterable[bytes] = ()):
        digest, code, code_n, ids, id_n = [np.empty(0, np.uint64)], [np.empty(0, np.uint32)], [np.empty(0, np.int64)], [np.empty(0, np.int32)], [np.empty(0, np.int64)]
        for data in packed:
            n, n_code, n_ids = np.frombuffer(data, np.int64, 3).tolist()
            at = 24
            for out, kind, count in ((digest, np.uint64, n), (code_n, np.int64, n), (id_n, np.int64, n), (code, np.uint32, n_code), (ids, np.int32, n_ids)):
                out.append(np.frombuffer(data, kind, count, at))
                at += out[-1].nbytes
        digest, code_n, id_n = np.concatenate(digest), np.concatenate(code_n), np.concatenate(id_n)
        order = np.argsort(digest, kind="stable")
        self.digest = digest[order]
        self.code, self.code_at, self.code_n = np.concatenate(code), (np.cumsum(code_n) - code_n)[order], code_n[order]
        self.ids, self.id_at, self.id_n = np.concatenate(ids), (np.cumsum(id_n) - id_n)[order], id_n[order]
        self.shift = np.uint64(64 - max(1, int(len(self.digest)).bit_length()))
        self.bucket = np.searchsorted(self.digest >> self.shift, np.arange((1 << (64 - int(self.shift))) + 1, dtype=np.uint64))

    @staticmethod
    def pack(units: list[str], ids: list[list[int]], fine: bool) -> bytes:
        """Units (each one unit of its cut) and their ids as bytes."""
        whole = Units.__new__(Units)
        whole.string = "".join(units)
        whole.code = np.frombuffer(whole.string.encode("utf-32-le", "surrogatepass"), np.uint32)
        whole.size = np.array([len(u) for u in units], np.int64)
        whole.start = np.concatenate([[0], np.cumsum(whole.size)])
        whole.inner = np.arange(len(whole.code)) - np.repeat(whole.start[:-1], whole.size)
        flat = np.array([x for i in ids for x in i], np.int32)
        parts = [np.array([len(units), len(whole.code), len(flat)], np.int64), whole.digests(), whole.size, np.array([len(i) for i in ids], np.int64), whole.code, flat]
        return b"".join(p.tobytes() for p in parts)

    def find(self, units: Units) -> np.ndarray:
        """The entry of each unit, or -1; -1 too for a unit behind another of the same digest."""
        h = units.digests()
        found = np.full(len(h), -1, np.int64)
        top = (h >> self.shift).astype(np.int64)
        at, end = self.bucket[top], self.bucket[top + 1]
        live = np.flatnonzero(at < end)
        while len(live):
            k = at[live]
            same = self.digest[k] == h[live]
            found[live[same]] = k[same]
            live = live[~same]
            at[live] += 1
            live = live[at[live] < end[live]]
        hit = found >= 0
        hit &= np.where(hit, self.code_n[found] if len(self.code_n) else 0, -1) == units.size
        if hit.any():
            there = np.repeat(np.where(hit, self.code_at[found], 0), units.size) + units.inner
            other = (self.code[np.minimum(there, len(self.code) - 1)] != units.code) & np.repeat(hit, units.size)
            hit &= ~np.logical_or.reduceat(other, units.start[:-1])
        found[~hit] = -1
        return found


def spread(flat: np.ndarray, at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """flat[at[0] : at[0] + n[0]], flat[at[1] : at[1] + n[1]], ... as one array."""
    return flat[np.repeat(at - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]

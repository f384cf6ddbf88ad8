"""Encoding of whole Arrow columns: texts fall apart at spaces, and equal pieces are encoded once.

A piece is what lies between two spaces; it stands alone if it begins with a non-space. Pieces of up to 16 bytes are keys
of a table made of arrays (two words of bytes, so equal keys are equal pieces), which whole arrays of pieces are looked up
in. New pieces of Latin letters, digits, marks and line ends are cut into pre-tokens by their classes of bytes, their words
go to the encoder's kernel together. All other pieces, and texts with other pieces or special strings, are encoded one by
one by the encoder's pattern.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

from ._common import text_bytes

#: Bytes of a key, and pieces worked on at a time.
WIDTH = 16
BLOCK = 400_000

_FILL = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
#: Classes of bytes: letter, digit, mark, line end, and whatever only the pattern can tell. Apostrophes are of the last kind.
LETTER, DIGIT, MARK, LINE, OTHER = range(5)


def _byte_classes() -> np.ndarray:
    out = np.full(256, OTHER, np.uint8)
    for b in range(33, 127):
        c = chr(b)
        out[b] = LETTER if c.isalpha() else DIGIT if c.isdigit() else MARK
    out[ord("'")], out[ord("\n")], out[0xC3] = OTHER, LINE, LETTER
    return out


_CLASS = _byte_classes()


def gather(flat: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """flat[start : start + count] of all rows end to end."""
    ends = np.cumsum(counts)
    return flat[np.repeat(starts - ends + counts, counts) + np.arange(ends[-1] if len(ends) else 0)]


def load(buffer: np.ndarray, at: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first 16 bytes from these places as two integers, zero beyond the sizes; buffer has 16 bytes to spare."""
    words = np.ndarray(len(buffer) - 7, "<u8", buffer, strides=(1,))
    return words[at] & _FILL[np.minimum(sizes, 8)], words[at + 8] & _FILL[np.clip(sizes - 8, 0, 8)]


def classes(text: np.ndarray) -> np.ndarray:
    """Class of each byte in rows of bytes; both bytes of a Latin-1 letter count as letters."""
    out = _CLASS[text]
    second = np.zeros(text.shape, bool)
    second[:, 1:] = text[:, :-1] == 0xC3
    out[second & (text >= 0x80) & (text < 0xC0)] = LETTER
    out[second & ((text == 0x97) | (text == 0xB7))] = OTHER  # the signs of multiplication and division
    return out


class Store:
    """Growing lists of ids."""

    def __init__(self):
        self.flat, self.starts, self.counts = np.zeros(1 << 16, np.uint32), np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)
        self.used, self.n = 0, 1  # list 0 is empty

    def add(self, flat: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Numbers of the new lists."""
        self.flat = self._room(self.flat, self.used + len(flat))
        self.starts, self.counts = (self._room(x, self.n + len(counts)) for x in (self.starts, self.counts))
        self.flat[self.used : self.used + len(flat)] = flat
        new = np.arange(self.n, self.n + len(counts))
        self.starts[new], self.counts[new] = self.used + np.cumsum(counts) - counts, counts
        self.used, self.n = self.used + len(flat), self.n + len(counts)
        return new

    def of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        counts = self.counts[numbers]
        return gather(self.flat, self.starts[numbers], counts), counts

    @staticmethod
    def _room(x: np.ndarray, n: int) -> np.ndarray:
        return x if n <= len(x) else np.concatenate((x, np.zeros(max(n, 2 * len(x)) - len(x), x.dtype)))


class PieceTable:
    """encode_words takes rows of bytes with their sizes and gives ids and counts; encode_pieces takes a list of str and
    encode_text one, they give little-endian ids."""

    def __init__(self, encode_words: Callable, encode_pieces: Callable, encode_text: Callable, special: tuple[str, ...], bits: int = 20):
        self.encode_words, self.encode_pieces, self.encode_text = encode_words, encode_pieces, encode_text
        self.special, self.bits = [s.encode() for s in special], bits
        self.clear()

    def clear(self) -> None:
        size = 1 << self.bits
        self.low, self.high, self.tag, self.value = np.zeros(size, np.uint64), np.zeros(size, np.uint64), np.zeros(size, np.uint8), np.zeros(size, np.int32)
        self.filled, self.store = 0, Store()
        self.others: dict[bytes, int] = {}

    def hashes(self, low: np.ndarray, high: np.ndarray, tag: np.ndarray) -> np.ndarray:
        h = low * _FACTORS[0] ^ (high + tag) * _FACTORS[1]
        return (h ^ h >> np.uint64(32)) * _FACTORS[2]

    def find(self, low: np.ndarray, high: np.ndarray, tag: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Numbers of the lists of ids, -1 for keys that aren't there."""
        mask = (1 << self.bits) - 1
        at = (hashes >> np.uint64(64 - self.bits)).astype(np.int64)
        out, rest = np.full(len(low), -1, np.int64), np.arange(len(low))
        while len(rest):
            seen = self.tag[at]
            hit = (seen == tag[rest]) & (self.low[at] == low[rest]) & (self.high[at] == high[rest])
            out[rest[hit]] = self.value[at[hit]]
            on = ~hit & (seen > 0)
            rest, at = rest[on], (at[on] + 1) & mask
        return out

    def insert(self, low: np.ndarray, high: np.ndarray, tag: np.ndarray, hashes: np.ndarray, values: np.ndarray) -> None:
        """Distinct new keys."""
        mask = (1 << self.bits) - 1
        self.filled += len(low)
        at, rest = (hashes >> np.uint64(64 - self.bits)).astype(np.int64), np.arange(len(low))
        while len(rest):
            free = np.flatnonzero(self.tag[at] == 0)
            _, first = np.unique(at[free], return_index=True)  # one key a slot
            take = free[first]
            slots, keys = at[take], rest[take]
            self.low[slots], self.high[slots], self.tag[slots], self.value[slots] = low[keys], high[keys], tag[keys], values[keys]
            on = np.ones(len(rest), bool)
            on[take] = False
            rest, at = rest[on], (at[on] + 1) & mask

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and where each text's ids begin (and the last ones end)."""
        raw, bounds = text_bytes(column)
        n = len(column)
        blob = raw.tobytes()
        buffer = np.frombuffer(blob + bytes(24), np.uint8)
        spaces = np.flatnonzero(raw == 32)
        lead = np.searchsorted(spaces, bounds) + np.arange(n + 1)  # number of each text's first piece
        is_first = np.zeros(len(spaces) + n, bool)
        is_first[lead[:-1]] = True
        starts = np.empty(len(is_first), np.int64)
        starts[is_first], starts[~is_first] = bounds[:-1], spaces + 1
        ends = np.empty_like(starts)
        ends[:-1] = starts[1:] - 1
        ends[lead[1:] - 1] = bounds[1:]
        whole = self._odd_texts(buffer, blob, bounds, lead, starts, ends)
        skip = np.repeat(whole, np.diff(lead))
        ids, counts = [], np.zeros(n, np.int64)
        edges = lead[np.searchsorted(lead, np.arange(BLOCK, lead[-1], BLOCK))] if lead[-1] > BLOCK else []
        for a, b in zip([0, *edges], [*edges, int(lead[-1])]):
            if a == b:
                continue
            values, before = self._values(buffer, starts[a:b], ends[a:b], is_first[a:b], skip[a:b])
            first, last = np.searchsorted(lead, [a, b])
            for k in np.flatnonzero(whole[first:last]).tolist() if whole[first:last].any() else []:
                found = self.encode_text(blob[bounds[first + k] : bounds[first + k + 1]].decode())
                values[lead[first + k] - a] = self._add([found])[0]
            flat, sizes = self.store.of(values)
            ids.append(flat)
            counts[first:last] = np.add.reduceat(sizes, lead[first:last] - a)
            self.store.n, self.store.used = before
        return np.concatenate(ids) if ids else np.zeros(0, np.uint32), np.concatenate(([0], np.cumsum(counts)))

    def _odd_texts(self, buffer: np.ndarray, blob: bytes, bounds: np.ndarray, lead: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Texts with special strings, or with a piece that is empty or may begin with white space."""
        empty, begin = starts == ends, buffer[starts]
        odd = empty | (begin < 33)
        for k in np.flatnonzero(~empty & ((begin == 0xC2) | (begin >= 0xE1) & (begin <= 0xE3))).tolist():
            odd[k] = bytes(buffer[starts[k] : min(ends[k], starts[k] + 4)]).decode("utf-8", "ignore")[:1].isspace()
        whole = np.add.reduceat(odd, lead[:-1]) > 0 if len(lead) > 1 else np.zeros(0, bool)
        whole &= np.diff(bounds) > 0
        for s in self.special:
            at = blob.find(s)
            while at >= 0:
                k = int(np.searchsorted(bounds, at, "right")) - 1
                whole[k] |= at + len(s) <= bounds[k + 1]
                at = blob.find(s, at + 1)
        return whole

    def _values(self, buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray, is_first: np.ndarray, skip: np.ndarray) -> tuple[np.ndarray, tuple[int, int]]:
        """Number of the list of ids of each piece, and the length of the store up to the lists that stay."""
        sizes = ends - starts
        short = (sizes <= WIDTH) & (sizes > 0) & ~skip
        low, high = load(buffer, starts, np.minimum(sizes, WIDTH))
        tag = (np.minimum(sizes, 127) | is_first.astype(np.int64) << 7).astype(np.uint8)
        hashes = self.hashes(low, high, tag)
        values = np.zeros(len(starts), np.int64)
        look = np.flatnonzero(short)
        values[look] = self.find(low[look], high[look], tag[look], hashes[look])
        missing = np.flatnonzero(values < 0)
        room = (1 << self.bits) * 0.45
        if self.filled > room and len(missing) > 0.4 * len(look):
            self.clear()
            return self._values(buffer, starts, ends, is_first, skip)
        keep, before = self.filled + len(missing) < room, (self.store.n, self.store.used)
        other = np.flatnonzero((sizes > WIDTH) & ~skip)
        if len(missing):
            _, at, where = np.unique(hashes[missing], return_index=True, return_inverse=True)
            one = missing[at]
            same = (low[missing] == low[one][where]) & (high[missing] == high[one][where]) & (tag[missing] == tag[one][where])
            new, plain = self._new(low[one], high[one], tag[one], hashes[one], keep)
            values[missing] = np.where(plain[where] & same, new[where], -1)
            other = np.concatenate((other, missing[values[missing] < 0]))
        if len(other):
            keys = [bytes(buffer[a:b]) if f else b" " + bytes(buffer[a:b]) for a, b, f in zip(starts[other].tolist(), ends[other].tolist(), is_first[other].tolist())]
            known = self.others
            unknown = list(set(keys).difference(known))
            found = dict(zip(unknown, self._add(self.encode_pieces([k.decode() for k in unknown])).tolist()))
            values[other] = [found[k] if k in found else known[k] for k in keys]
            if keep:
                known.update(found)
                self.filled += len(found)
        return values, (self.store.n, self.store.used) if keep else before

    def _add(self, found: list[bytes]) -> np.ndarray:
        return self.store.add(np.frombuffer(b"".join(found), "<u4"), np.fromiter(map(len, found), np.int64, len(found)) // 4)

    def _new(self, low: np.ndarray, high: np.ndarray, tag: np.ndarray, hashes: np.ndarray, keep: bool) -> tuple[np.ndarray, np.ndarray]:
        """List numbers of distinct new pieces, and whether they are of the plain classes (others have no list yet)."""
        n, sizes = len(low), (tag & 127).astype(np.int64)
        text = np.stack((low, high), 1).view(np.uint8).reshape(n, WIDTH)
        inside = np.arange(WIDTH) < sizes[:, None]
        kind = classes(text)
        plain = ~((kind == OTHER) & inside).any(axis=1)
        out = np.zeros(n, np.int64)
        rows = np.flatnonzero(plain)
        kind, inside = kind[rows], inside[rows]
        begins = inside.copy()
        begins[:, 1:] &= kind[:, 1:] != kind[:, :-1]
        # of line ends in a row that something follows, the last one stands alone
        last = (kind[:, 1:-1] == LINE) & (kind[:, :-2] == LINE) & inside[:, 2:] & (kind[:, 2:] != LINE)
        begins[:, 1:-1] |= last & inside[:, 1:-1]
        who, at = np.nonzero(begins)  # the pre-tokens, row by row
        counts = begins.sum(axis=1)
        bound = np.empty(len(who), np.int64)
        bound[:-1] = at[1:]
        bound[np.cumsum(counts) - 1] = sizes[rows]
        length = bound - at
        padded = np.concatenate((text[rows].reshape(-1), np.zeros(24, np.uint8)))
        wl, wh = load(padded, who * WIDTH + at, length)
        wt = (length | ((at > 0) | (tag[rows][who] > 127)).astype(np.int64) << 7).astype(np.uint8)
        hw = self.hashes(wl, wh, wt)
        key = np.stack((wl, wh, wt.astype(np.uint64)), 1)
        order = np.lexsort((wt, wh, wl))
        fresh = np.concatenate(([True], (key[order][1:] != key[order][:-1]).any(axis=1))) if len(order) else np.zeros(0, bool)
        number = np.empty(len(order), np.int64)
        number[order] = np.cumsum(fresh) - 1
        one = order[fresh]
        word = self.find(wl[one], wh[one], wt[one], hw[one])
        unknown = word < 0
        miss = one[unknown]
        word[unknown] = self.store.add(*self.encode_words(*self._matrix(wl[miss], wh[miss], wt[miss])))
        if keep:
            self.insert(wl[miss], wh[miss], wt[miss], hw[miss], word[unknown])
        ends = np.cumsum(counts)
        single = counts == 1
        out[rows[single]] = word[number[ends[single] - 1]]
        several = np.flatnonzero(~single)
        if len(several):
            mine = np.repeat(~single, counts)
            flat, each = self.store.of(word[number[mine]])
            upto = np.concatenate(([0], np.cumsum(counts[several])))
            totals = np.add.reduceat(each, upto[:-1])
            out[rows[several]] = new = self.store.add(flat, totals)
            if keep:
                r = rows[several]
                self.insert(low[r], high[r], tag[r], hashes[r], new)
        return out, plain

    @staticmethod
    def _matrix(low: np.ndarray, high: np.ndarray, tag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of bytes with a space before words that have one, and their sizes."""
        n, spaced = len(low), tag < 128
        content = np.stack((low, high), 1).view(np.uint8).reshape(n, WIDTH)
        out = np.zeros((n, WIDTH + 1), np.uint8)
        out[~spaced, :WIDTH] = content[~spaced]
        out[spaced, 0] = 32
        out[spaced, 1:] = content[spaced]
        return out, (tag & 127).astype(np.int64) + spaced

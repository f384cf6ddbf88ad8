"""BPE encoding and decoding by per-prefix dynamic programming.

For every prefix of a word exactly one token can come last in its encoding. The suffix automaton of the vocabulary gives,
at each position, the longest suffix read that any token holds, and by it the longest token that ends there; each token
knows its longest proper suffix among the tokens. A token is the last one of a prefix when it begins where a shorter
prefix ends and the two tokens are *compatible*: merging by rank their joined bytes gives these two tokens again.
Following the stored last tokens backwards from the end of the word yields the ids.

Words are the pre-tokens of the tokenizer's own pattern. A boundary lies before every single space that is followed by
a non-space, so a text falls apart into pieces that are encoded once and looked up afterwards (bounded table).

Defined results: null text is empty; empty text has no ids; special strings in a text become their special id, as the
library does by default; rows are independent, so ties and repeated rows need no rule.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from ._common import id_text, lean
from .pieces import PieceTable, gather

#: Pieces, words and token pairs that a worker remembers. A full cache takes nothing more; it is emptied when it no
#: longer fits the texts (see refresh) or, for pairs, when full.
PIECE_CACHE = 300_000
WORD_CACHE = 50_000
PAIR_CACHE = 300_000

#: The pattern that splits a text into pre-tokens, as the library's byte-level pre-tokenizer has it (fixed value).
PRE_TOKEN = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = [""] * 256, 0
    for b in printable:
        out[b] = chr(b)
    for b in range(256):
        if not out[b]:
            out[b] = chr(256 + extra)
            extra += 1
    return out


class IntMap:
    """An open-addressed table from non-negative 64-bit keys to non-negative 32-bit values, for whole arrays of keys."""

    def __init__(self, bits: int):
        self.shift, self.mask, self.n = np.uint64(64 - bits), (1 << bits) - 1, 0
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int32)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Distinct new keys."""
        self.n += len(keys)
        at = self.slots(keys)
        while len(keys):
            free = self.keys[at] < 0
            self.keys[at[free]] = keys[free]
            mine = self.keys[at] == keys
            self.values[at[mine]] = values[mine]
            keys, values, at = keys[~mine], values[~mine], (at[~mine] + 1) & self.mask

    def get(self, keys: np.ndarray) -> np.ndarray:
        """Values, -1 for keys that aren't there."""
        at = self.slots(keys)
        seen = self.keys[at]
        out = np.where(seen == keys, self.values[at], np.int32(-1))
        rest = np.flatnonzero((seen != keys) & (seen >= 0))
        at, keys = at[rest], keys[rest]
        while len(rest):
            at = (at + 1) & self.mask
            seen = self.keys[at]
            hit = seen == keys
            out[rest[hit]] = self.values[at[hit]]
            on = ~hit & (seen >= 0)
            rest, at, keys = rest[on], at[on], keys[on]
        return out


class PrefixEncoder:
    """Exact encoder and decoder of one byte-level BPE vocabulary file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        symbol = byte_symbols()
        back = {s: b for b, s in enumerate(symbol)}
        raw = lambda token: bytes(back[c] for c in token)
        # Inside, a token's number is its merge rank: bytes first, then merges in order.
        rank = {bytes([b]): b for b in range(256)}
        self.left, self.right = list(range(256)), list(range(256))
        self.joined: dict[int, int] = {}
        names = [bytes([b]) for b in range(256)]
        for merge in merges:
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            a, b = raw(a), raw(b)
            t = rank[a + b] = len(names)
            names.append(a + b)
            self.left.append(rank[a])
            self.right.append(rank[b])
            self.joined[rank[a] << 20 | rank[b]] = t
        self.ids = [vocab["".join(symbol[b] for b in n)] for n in names]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.special_pattern = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        size = max([*self.ids, *self.special.values()]) + 1
        self.bytes_of = [b""] * size
        for n, i in zip(names, self.ids):
            self.bytes_of[i] = n
        for s, i in self.special.items():
            self.bytes_of[i] = s.encode()
        self.digits, self.contents = Lists([f"{i},".encode() for i in range(size)]), Lists(self.bytes_of)
        self._build_automaton(rank)
        self.words: dict[str, bytes] = {}
        self.table = PieceTable(self.encode_rows, self.encode_pieces, self.encode, tuple(self.special))

    def _build_automaton(self, rank: dict[bytes, int]) -> None:
        """The suffix automaton of the vocabulary: following bytes leads to the class of the longest suffix of the text read
        that some token holds. Each class knows the longest token that its strings end with, each token the next shorter."""
        go: list[dict[int, int]] = [{}]
        link, most = [-1], [0]  # of each class: the class of its next shorter suffixes, and its longest string

        def add(ways: dict[int, int], length: int, suffix: int) -> int:
            go.append(ways)
            most.append(length)
            link.append(suffix)
            return len(go) - 1

        def split(p: int, b: int, q: int) -> int:
            """A class of its own for the strings of q that are one byte longer than those of p."""
            new = add(go[q].copy(), most[p] + 1, link[q])
            link[q] = new
            while p >= 0 and go[p].get(b) == q:
                go[p][b] = new
                p = link[p]
            return new

        def extend(last: int, b: int) -> int:
            """The class of a class's longest string and one more byte."""
            q = go[last].get(b)
            if q is not None:
                return q if most[q] == most[last] + 1 else split(last, b, q)
            new, p = add({}, most[last] + 1, 0), last
            while p >= 0 and b not in go[p]:
                go[p][b] = new
                p = link[p]
            if p >= 0:
                q = go[p][b]
                link[new] = q if most[q] == most[p] + 1 else split(p, b, q)
            return new

        for name in rank:
            state = 0
            for b in name:
                state = extend(state, b)
        tokens_at: dict[int, list[int]] = {}
        for name, t in rank.items():  # classes may have been split since a token was added
            state = 0
            for b in name:
                state = go[state][b]
            tokens_at.setdefault(state, []).append(t)
        lengths = {t: len(n) for n, t in rank.items()}
        longest, shorter = [-1] * len(go), [-1] * len(rank)
        for state in sorted(range(1, len(go)), key=most.__getitem__):
            below = longest[link[state]]
            for t in sorted(tokens_at.get(state, ()), key=lengths.__getitem__):
                shorter[t], below = below, t
            longest[state] = below
        self.go = IntMap(19)
        self.go.add(np.array([s << 8 | b for s, ways in enumerate(go) for b in ways], np.int64), np.array([q for ways in go for q in ways.values()], np.int32))
        self.back, self.most = np.maximum(np.array(link, np.int32), 0), np.array(most, np.int32)
        self.longest, self.shorter = np.array(longest, np.int32), np.array(shorter, np.int32)
        self.length = np.zeros(len(rank), np.int32)
        self.length[list(rank.values())] = [len(n) for n in rank]
        self.id_array = np.array(self.ids, np.uint32)
        self.pair_map = IntMap(20)

    def step(self, state: np.ndarray, match: np.ndarray, byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """States and lengths of the match after one more byte; without a way on, a state falls back to shorter suffixes
        (the root has a way for every byte)."""
        out = self.go.get(state.astype(np.int64) << 8 | byte)
        match = match + 1
        rest = np.flatnonzero(out < 0)
        at = state[rest]
        while len(rest):
            at = self.back[at]
            got = self.go.get(at.astype(np.int64) << 8 | byte[rest])
            out[rest], match[rest] = got, self.most[at] + 1
            on = got < 0
            rest, at = rest[on], at[on]
        return out, match

    def last_tokens(self, state: np.ndarray, match: np.ndarray) -> np.ndarray:
        """The longest token that each match ends with."""
        token = self.longest[state].copy()
        rest = np.flatnonzero(self.length[token] > match)
        while len(rest):
            token[rest] = self.shorter[token[rest]]
            rest = rest[self.length[token[rest]] > match[rest]]
        return token

    def all_compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = a.astype(np.int64) << 20 | b
        known = self.pair_map.get(keys)
        new = np.flatnonzero(known < 0)
        if len(new):
            some, where = np.unique(keys[new], return_inverse=True)
            values = np.fromiter((self.compatible(k >> 20, k & 0xFFFFF) for k in some.tolist()), np.int32, len(some))
            known[new] = values[where]
            if self.pair_map.n + len(some) > PAIR_CACHE:
                self.pair_map = IntMap(20)
            if len(some) <= PAIR_CACHE:
                self.pair_map.add(some, values)
        return known == 1

    def compatible(self, a: int, b: int) -> bool:
        """Whether joining the bytes of two tokens and merging by rank leaves exactly these two tokens.

        The last merges are undone one by one, the later one first; at each step the two tokens at the seam must not
        form a pair that merging would have taken before the merge just undone.
        """
        left, right, joined = self.left, self.right, self.joined
        x, y, limit, ok = a, b, 1 << 40, True
        while True:
            t = joined.get(x << 20 | y)
            if t is not None and t < limit:
                ok = False
                break
            if x > y:
                limit, x = x, right[x]
                if x == limit:  # a byte: only the other side is left to undo
                    limit, y = y + 1, left[y]
                    if y + 1 == limit:
                        break
            else:
                limit, y = y + 1, left[y]
                if y + 1 == limit:
                    limit, x = x, right[x]
                    if x == limit:
                        break
        return ok

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of words as little-endian unsigned 32-bit integers; all words of a similar length go on together, byte by byte."""
        out = [b""] * len(words)
        order = sorted(range(len(words)), key=lambda i: len(words[i]))
        at = 0
        while at < len(order):
            longest, stop, area = len(words[order[at]]), at, 0
            while stop < len(order) and (n := len(words[order[stop]])) <= max(2 * longest, 8) and (stop == at or (stop - at) * n < 1_000_000):
                stop += 1
            part = order[at:stop]
            for i, raw in zip(part, self._encode_group([words[i] for i in part])):
                out[i] = raw
            at = stop
        return out

    def _encode_group(self, words: list[bytes]) -> list[bytes]:
        """Words in ascending order of length."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        text = np.zeros((int(sizes[-1]), len(words)), np.uint8)
        starts = np.concatenate(([0], np.cumsum(sizes)))
        row = np.repeat(np.arange(len(words)), sizes)
        text[np.arange(starts[-1]) - starts[row], row] = np.frombuffer(b"".join(words), np.uint8)
        flat, counts = self._encode_columns(text, sizes)
        raw, bounds = flat.tobytes(), [0, *(np.cumsum(counts) * 4).tolist()]
        return [raw[a:b] for a, b in zip(bounds, bounds[1:])]

    def encode_rows(self, text: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words given as rows of bytes, end to end, and how many each word has."""
        order = np.argsort(sizes, kind="stable")
        flat, counts = self._encode_columns(text[order].T, sizes[order])
        starts, out = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
        starts[order], out[order] = np.cumsum(counts) - counts, counts
        return gather(flat, starts, out), out

    def _encode_columns(self, text: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and counts of words in ascending order of length, one a column."""
        rows = len(sizes)
        width = int(sizes[-1]) if rows else 0
        last = np.zeros((width + 1, rows), np.int32)
        state, match = np.zeros(rows, np.int32), np.zeros(rows, np.int32)
        for end in range(1, width + 1):
            first = int(np.searchsorted(sizes, end))  # shorter words are done
            state[first:], match[first:] = self.step(state[first:], match[first:], text[end - 1, first:])
            open_, token = np.arange(first, rows), self.last_tokens(state[first:], match[first:])
            while len(open_):
                begin = end - self.length[token]
                last[end, open_] = token
                inner = np.flatnonzero(begin > 0)
                bad = inner[~self.all_compatible(last[begin[inner], open_[inner]], token[inner])]
                open_, token = open_[bad], self.shorter[token[bad]]
        at, who, found = sizes.copy(), np.flatnonzero(sizes), []
        while len(who):
            t = last[at[who], who]
            found.append((who, t))
            at[who] -= self.length[t]
            who = who[at[who] > 0]
        counts = np.zeros(rows, np.int64)
        for who, _ in found:
            counts[who] += 1
        ends = np.cumsum(counts)
        flat, place = np.zeros(int(ends[-1]) if rows else 0, np.uint32), ends - 1
        for who, t in found:
            flat[place[who]] = self.id_array[t]
            place[who] -= 1
        return flat, counts

    def split_piece(self, piece: str) -> list[str]:
        """Pre-tokens of a piece; the usual word with or without one mark after it needs no pattern."""
        if piece[0] == " " or piece[0].isalpha():
            if piece[1:].isalpha():
                return [piece]
            if piece[-1] in ".,;:!?" and piece[1:-1].isalpha():
                return [piece[:-1], piece[-1]]
        return PRE_TOKEN.findall(piece)

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        parts = list(map(self.split_piece, pieces))
        new = list({w for p in parts for w in p}.difference(self.words))
        got = dict(zip(new, self.encode_words([w.encode() for w in new])))
        known = self.words
        out = [b"".join([got[w] if w in got else known[w] for w in p]) for p in parts]
        if len(known) >= WORD_CACHE and len(new) > 0.8 * len(pieces):
            known.clear()
        if room := WORD_CACHE - len(known):
            known.update(list(got.items())[:room])
        return out

    def encode_plain(self, text: str) -> bytes:
        return b"".join(self.encode_words([w.encode() for w in PRE_TOKEN.findall(text)]))

    def encode(self, text: str) -> bytes:
        """Ids of any text, without pieces and cache."""
        if not self.special_pattern:
            return self.encode_plain(text)
        out, at = [], 0
        for m in self.special_pattern.finditer(text):
            out += [self.encode_plain(text[at : m.start()]), np.array([self.special[m[0]]], "<u4").tobytes()]
            at = m.end()
        return b"".join([*out, self.encode_plain(text[at:])])

    def encode_column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts of an Arrow column end to end, and where each text's ids begin (and the last ones end)."""
        return self.table.encode(column)

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


class Lists:
    """A byte string for each id, joined for many ids at a time."""

    def __init__(self, strings: list[bytes]):
        self.flat = np.frombuffer(b"".join(strings), np.uint8)
        self.sizes = np.fromiter(map(len, strings), np.int64, len(strings))
        self.starts = np.cumsum(self.sizes) - self.sizes

    def join(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """The joined strings of the ids between one bound and the next."""
        sizes = self.sizes[ids]
        raw = gather(self.flat, self.starts[ids], sizes).tobytes()
        at = np.concatenate(([0], np.cumsum(sizes)))[bounds].tolist()
        return [raw[a:b] for a, b in zip(at, at[1:])]


def refresh(cache: dict, found: dict, missed: int, asked: int, most: int = PIECE_CACHE) -> None:
    """Add what was found while there is room; start anew when a full cache misses over 40 in 100 of what was asked."""
    if len(cache) >= most and missed > 0.4 * asked:
        cache.clear()
    if room := most - len(cache):
        cache.update(found if room >= len(found) else list(found.items())[:room])


_ENCODERS: dict[str, PrefixEncoder] = {}


def encoder(path: str) -> PrefixEncoder:
    """One encoder a worker process and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PrefixEncoder(path)
    return _ENCODERS[path]


def bpe_round_trip(docs: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Encode every text and decode its ids: doc_id, n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids, decoded."""
    path = vocabulary or public_tokenizers.path("byte_bpe_50k.json")
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded string" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in batches:
            ids, bounds = enc.encode_column(b.column(1))
            sha = lambda raw: hashlib.sha256(raw).hexdigest()
            decoded = [raw.decode("utf-8", "replace") for raw in enc.contents.join(ids, bounds)]
            cols = [b.column(0), pa.array(np.diff(bounds)), pa.array([sha(raw[:-1]) for raw in enc.digits.join(ids, bounds)], pa.string()), pa.array([sha(t.encode()) for t in decoded], pa.string())]
            if with_ids:
                cols += [pa.ListArray.from_arrays(bounds.astype(np.int32), ids.astype(np.int32)), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"][: len(cols)])

    return id_text(docs, id_col, text_col).mapInArrow(lean(run), schema)

"""Token counts by byte-pair merging with a heap and a linked list; no ids are made.

A word starts as one symbol a byte, the last one with the end-of-word mark. The lowest-ranked adjacent pair (leftmost
of equals) is popped and merged until none is left; the count is the initial symbols minus the merges done.

Defined results: null text counts as empty; empty text and text of white space have 0 tokens; special strings inside a
text count one each, as the library does by default.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from ._common import id_text, lean, text_chunks
from .bpe import byte_symbols, refresh

#: Words and pieces that a worker remembers the counts of.
WORD_CACHE = PIECE_CACHE = 500_000


class MergeCounter:
    """Counts the tokens that one word-level BPE file of the tokenizers library gives."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, self.end = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"] or ""
        symbols = byte_symbols()
        self.first = [vocab[s] for s in symbols]
        self.final = [vocab[s + self.end] for s in symbols]
        self.merges: dict[int, tuple[int, int]] = {}
        for r, merge in enumerate(spec["model"]["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            self.merges[vocab[a] << 20 | vocab[b]] = (r, vocab[a + b])
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = regex.compile(split["pattern"]["Regex"].replace(r"[^\s", r"[^\p{White_Space}"))
        self.special = {t["content"] for t in spec.get("added_tokens", [])}
        self.special_pattern = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.words: dict[str, int] = {}
        self.pieces: dict[str, int] = {}

    def merge_count(self, word: bytes) -> int:
        """Tokens of one pre-token: initial symbols minus merges."""
        n = len(word)
        if n < 2:
            return n
        ids = [self.first[b] for b in word]
        ids[-1] = self.final[word[-1]]
        merges = self.merges
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            m = merges.get(ids[i] << 20 | ids[i + 1])
            if m is not None:
                heap.append((m[0], i, m[1]))
        heapify(heap)
        left = n
        while heap:
            r, i, new = heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= n:
                continue
            m = merges.get(ids[i] << 20 | ids[j])
            if m is None or m[0] != r:  # one of the two has been merged away meanwhile
                continue
            ids[i], ids[j] = new, -1
            after[i] = k = after[j]
            left -= 1
            if k < n:
                before[k] = i
                m = merges.get(new << 20 | ids[k])
                if m is not None:
                    heappush(heap, (m[0], i, m[1]))
            h = before[i]
            if h >= 0:
                m = merges.get(ids[h] << 20 | new)
                if m is not None:
                    heappush(heap, (m[0], h, m[1]))
        return left

    def count_word(self, word: str) -> int:
        n = self.words.get(word)
        if n is None:
            n = self.merge_count(word.encode())
            if len(self.words) < WORD_CACHE:
                self.words[word] = n
        return n

    def normal(self, text: str) -> str:
        """Composed and lower case; characters are lowered one by one, so a final sigma stays an ordinary one."""
        text = unicodedata.normalize("NFC", text)
        return "".join(map(str.lower, text)) if "\u03a3" in text else text.lower()

    def count_normal(self, text: str) -> int:
        if text.isalpha():
            return self.count_word(text)
        if text[:-1].isalpha() and text[-1] in ".,;:!?":
            return self.count_word(text[:-1]) + self.count_word(text[-1])
        return sum(map(self.count_word, self.pattern.findall(text)))

    def count_plain(self, text: str) -> int:
        return self.count_normal(self.normal(text))

    def count(self, text: str) -> int:
        if not self.special_pattern:
            return self.count_plain(text)
        total, at = 0, 0
        for m in self.special_pattern.finditer(text):
            total += self.count_plain(text[at : m.start()]) + 1
            at = m.end()
        return total + self.count_plain(text[at:])

    def count_texts(self, texts: list[str]) -> list[int]:
        """No token crosses a space, so the parts between spaces are counted once each and looked up afterwards."""
        spans, pieces, out = [], [], [0] * len(texts)
        for k, t in enumerate(texts):
            if any(s in t for s in self.special):
                out[k] = self.count(t)
                continue
            begin = len(pieces)
            pieces += self.normal(t).split(" ")
            spans.append((k, begin, len(pieces)))
        values = list(map(self.pieces.get, pieces))
        if missing := [i for i, v in enumerate(values) if v is None]:
            found = {p: self.count_normal(p) for p in {pieces[i] for i in missing}}
            for i in missing:
                values[i] = found[pieces[i]]
            refresh(self.pieces, found, len(missing), len(pieces), PIECE_CACHE)
        for k, a, b in spans:
            out[k] = sum(values[a:b])
        return out


_COUNTERS: dict[str, MergeCounter] = {}


def counter(path: str) -> MergeCounter:
    if path not in _COUNTERS:
        _COUNTERS[path] = MergeCounter(path)
    return _COUNTERS[path]


def token_counts(docs: DataFrame, limit: int = 2048, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit) of every text."""
    path = vocabulary or public_tokenizers.path("word_bpe_49k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        for ids, texts in text_chunks(batches):
            n = count.count_texts(texts)
            yield pa.RecordBatch.from_pydict({"doc_id": pa.array(ids, pa.int64()), "n_bytes": pa.array([len(t.encode()) for t in texts], pa.int64()), "n_tokens": pa.array(n, pa.int64()), "over_limit": pa.array([x > limit for x in n], pa.bool_())})

    return id_text(docs, id_col, text_col).mapInArrow(lean(run), "doc_id long, n_bytes long, n_tokens long, over_limit boolean")

"""Language identification with blended-spectrum presence kernels.

The kernel of two texts counts the character n-grams (n = 1 to 3) that both hold, divided by the geometric mean of the
counts of their own. A Nyström map over landmark texts gives finite features, on which one ridge regression per
language is fitted (one against the rest). Because a kernel value is a product of presence vectors, the trained map and
regressions fold into one weight per n-gram and language: a batch of texts is scored by one product of its presence
matrix with these weights, which gives the same values as going through the landmarks.

Characters are letters of any script in lower case; everything else is one sign. N-grams are told apart by a hash of 19
bits. The model is fitted on at most `max_rows` labelled rows, those with the smallest hashes of their ids.

Defined results: `und` with score 0 for null text and text without a letter, and where nothing could be learned; equal
scores go to the alphabetically first language.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import held_out, held_out_expr, id_text, lean, text_chunks

#: Bounds on the labelled rows and landmarks of a model.
MAX_ROWS = 4_000
LANDMARKS = 256
RIDGE = 1e-2
#: N-grams are told apart by a hash of so many bits.
BITS = 19
#: Texts whose presence rows are multiplied at a time.
BATCH = 64
#: Margins are multiplied by this before the softmax that makes a score of them.
SHARPNESS = 5.0
#: Characters whose n-grams are marked at a time.
SLICE = 1_000_000


#: Whether a code point is a letter; 255 where nobody has asked yet. Filled as texts need it, in each worker.
_LETTER = np.full(0x110000, 255, np.uint8)
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def letters(text: str) -> np.ndarray:
    """Code points in lower case; whatever is no letter is 0, so words have one and the same sign at their ends."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    kind = _LETTER[points]
    if (new := kind == 255).any():
        for p in np.unique(points[new]).tolist():
            _LETTER[p] = chr(p).isalpha()
        kind = _LETTER[points]
    return np.where(kind == 1, points, 0).astype(np.uint64)


class Marker:
    """Finds the distinct n-grams of texts; its scratch space is zero between texts."""

    def __init__(self):
        self.words = np.zeros(1 << BITS - 3, np.uint64)
        self.flags = self.words.view(np.uint8)

    def grams(self, text: str) -> np.ndarray:
        """Numbers of the n-grams of 1, 2 and 3 characters in the text, in ascending order."""
        shift = np.uint64(64 - BITS)
        for a in range(0, len(text), SLICE):
            c = letters(text[a : a + SLICE + 2])
            one = (c + np.uint64(1)) * _MIX[0]
            self.flags[one * _MIX[3] >> shift] = 1
            two = one[:-1] + c[1:] * _MIX[1] + np.uint64(1)
            self.flags[two * _MIX[3] >> shift] = 1
            self.flags[(two[:-1] + c[2:] * _MIX[2] + np.uint64(1)) * _MIX[3] >> shift] = 1
        at = np.flatnonzero(self.words)
        found = np.flatnonzero(self.flags.reshape(-1, 8)[at].reshape(-1))
        self.words[at] = 0
        return at[found >> 3] << 3 | found & 7


class Presence:
    """Products of presence rows, texts by n-grams, with matrices over a chosen set of n-grams."""

    def __init__(self, grams: np.ndarray):
        self.column = np.full(1 << BITS, -1, np.int32)
        self.column[grams] = np.arange(len(grams))
        self.width = len(grams)

    def times(self, rows: list[np.ndarray], matrix: np.ndarray) -> np.ndarray:
        """One product a batch; each row is divided by the root of its number of n-grams, the norm that its kernel has."""
        out = np.empty((len(rows), matrix.shape[1]), np.float32)
        batch = np.zeros((min(BATCH, len(rows)), self.width), np.float32)
        for a in range(0, len(rows), BATCH):
            part = rows[a : a + BATCH]
            known = [self.column[r] for r in part]
            known = [k[k >= 0] for k in known]
            place = np.concatenate([k + i * self.width for i, k in enumerate(known)])
            batch.reshape(-1)[place] = 1
            size = np.sqrt([max(len(r), 1) for r in part]).astype(np.float32)
            out[a : a + BATCH] = (batch[: len(part)] @ matrix) / size[:, None]
            batch.reshape(-1)[place] = 0
        return out


class LanguageModel:
    def __init__(self, texts: list[str], langs: list[str], landmarks: int = LANDMARKS):
        pairs = [(t, y) for t, y in zip(texts, langs) if any(map(str.isalpha, t))]
        self.langs = sorted({y for _, y in pairs})
        if not self.langs:
            return
        mark = Marker()
        rows = [mark.grams(t) for t, _ in pairs]
        truth = np.array([self.langs.index(y) for _, y in pairs])
        turns = [np.flatnonzero(truth == c).tolist() for c in range(len(self.langs))]
        self.chosen = [g[i] for i in range(max(map(len, turns))) for g in turns if i < len(g)][:landmarks]  # the languages in turn
        self.presence = Presence(np.unique(np.concatenate([rows[i] for i in self.chosen])))
        marks = np.zeros((self.presence.width, len(self.chosen)), np.float32)
        for j, i in enumerate(self.chosen):
            marks[self.presence.column[rows[i]], j] = 1 / np.sqrt(len(rows[i]))
        kernel = self.presence.times(rows, marks).astype(np.float64)
        values, vectors = np.linalg.eigh((kernel[self.chosen] + kernel[self.chosen].T) / 2)
        keep = values > 1e-6 * values[-1]
        self.root = vectors[:, keep] / np.sqrt(values[keep])
        phi = np.hstack([kernel @ self.root, np.ones((len(rows), 1))])
        goal = np.where(truth[:, None] == np.arange(len(self.langs)), 1.0, -1.0)
        ridge = RIDGE * len(rows) * np.eye(phi.shape[1]) / phi.shape[1]
        ridge[-1, -1] = 1e-6
        self.ridge = np.linalg.solve(phi.T @ phi + ridge, phi.T @ goal)
        # landmarks and ridge weights folded into one weight per n-gram and language
        self.bias = self.ridge[-1].astype(np.float32)
        self.weights = (marks.astype(np.float64) @ (self.root @ self.ridge[:-1])).astype(np.float32)

    def margins(self, texts: list[str], mark: Marker) -> np.ndarray:
        """Margins of each text and language: the presence rows of a batch times the n-gram weights."""
        return self.presence.times([mark.grams(t) for t in texts], self.weights) + self.bias

    def predict(self, texts: list[str], mark: Marker) -> tuple[list[str], list[float]]:
        if not self.langs:
            return ["und"] * len(texts), [0.0] * len(texts)
        m = self.margins(texts, mark).astype(np.float64) * SHARPNESS
        e = np.exp(m - m.max(axis=1, keepdims=True))
        p = e / e.sum(axis=1, keepdims=True)
        best = p.argmax(axis=1)
        some = [any(map(str.isalpha, t)) for t in texts]
        return [self.langs[b] if a else "und" for a, b in zip(some, best.tolist())], [float(p[i, b]) if some[i] else 0.0 for i, b in enumerate(best.tolist())]


def fit(docs: DataFrame, max_rows: int = MAX_ROWS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.where("doc_id is not null and text is not null and lang is not null").where(~held_out_expr())
    chosen = rows.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)  # ids alone are sorted
    got = rows.join(F.broadcast(chosen), "doc_id").orderBy("doc_id", "text", "lang").limit(max_rows).toArrow().to_pydict()
    return LanguageModel(got["text"], got["lang"])


def language_id(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score of every text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the 2^BITS n-grams and the languages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        mark = Marker()
        for ids, texts in text_chunks(batches):
            langs, scores = m.predict(texts, mark)
            yield pa.RecordBatch.from_pydict({"doc_id": pa.array(ids, pa.int64()), "held_out": pa.array([held_out(i) for i in ids], pa.bool_()), "lang_pred": pa.array(langs, pa.string()), "score": pa.array(scores, pa.float64())})

    return id_text(docs, id_col, text_col).mapInArrow(lean(run), "doc_id long, held_out boolean, lang_pred string, score double")

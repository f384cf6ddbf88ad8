"""Toxicity by the nearest labelled examples under exact TF-IDF cosine, found in a block-max inverted index.

Every word of the examples is a dimension. A word's inverse document frequency is raised by how much it tells of toxic
texts: by the lower end of a confidence interval on the toxic share of the examples that hold it, counted over texts that
aren't near copies of each other. Beginnings of words that tell stand for words no example holds. Cosines are exact in
this space. Examples lie in blocks, those with the same frequent word together; each term keeps its largest weight in
every block, which bounds the cosines a block can hold. The blocks with the highest bounds are opened first, then those
whose bound still reaches the k-th best cosine; no other can hold a neighbour. The neighbours vote with weight
1 / (distance + margin); a logistic curve fitted to the examples' own leave-one-out votes (their near copies left out)
turns the vote into a probability.

Words are judged by at most `max_rows` labelled rows, up to half of them toxic, each half those with the smallest hashes
of their ids; at most `max_examples` of them, halved likewise, are the examples. All are read as whole texts; counts,
votes and the curve weigh them by the shares that the labels have. Labels come only from rows that are not held out; lang, source and doc_id are no inputs of a score. An example with the very words of
a text (cosine 1) never votes on it, so the label of a text or of a copy of it doesn't enter its score.

Defined results: null text is empty; a text without words of the examples gets the toxic share of the labels; equal
cosines are taken in an order that doesn't know the labels; without labelled rows every score is 0.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import held_out, held_out_expr, id_text, lean, small_batches, text_chunks
from .ngram_join import HASHES, min_hashes

#: The bounds on the labelled rows that words are judged by, and on the examples among them.
MAX_ROWS = 6_000
MAX_EXAMPLES = 1_200
NEIGHBOURS = 15
BLOCK = 64
#: Blocks with at least this share of the highest bound are opened before any is left out.
FIRST = 0.5
#: How many times its weight a word has that only toxic texts hold.
RAISE = 40.0
#: Lengths of the beginnings of words that can be terms, the longest tried first.
PREFIXES = (6, 5, 4)
#: Words whose term a worker remembers.
WORD_CACHE = 100_000
#: A document is predicted toxic from this score on.
THRESHOLD = 0.7
#: Added to a neighbour's distance before it is inverted.
MARGIN = 0.05
#: Labelled texts are near copies from this Jaccard index of their word sets on; pairs agreeing in fewer of the 128 MinHash
#: values (five standard deviations below) aren't compared.
COPY = 0.8
ALIKE = 80

WORD = re.compile(r"\w+")


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def lower_share(hits: int, total: int, z: float = 1.96) -> float:
    """Lower end of the Wilson interval of a share."""
    p = hits / total
    return (p + z * z / 2 / total - z * math.sqrt(p * (1 - p) / total + z * z / 4 / total / total)) / (1 + z * z / total)


def word_hashes(text: str) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the words."""
    words = set(words_of(text))
    return np.sort(np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)))


def copy_groups(texts: list[str]) -> np.ndarray:
    """For each text the place of the earliest group head whose word set is at least COPY similar (Jaccard), or its own.

    MinHash values only choose the heads that are compared, from the most alike down; the exact sets decide. Texts
    without words are one group.
    """
    sizes, sig = np.zeros(len(texts), np.int64), np.zeros((HASHES, len(texts)), np.uint32)
    for a in range(0, len(texts), 64):  # the words of some texts at a time are in memory
        sets = [word_hashes(t) for t in texts[a : a + 64]]
        sizes[a : a + 64] = [len(x) for x in sets]
        full = [i for i, x in enumerate(sets) if len(x)]
        if full:
            sig[:, [a + i for i in full]] = min_hashes([sets[i] for i in full]).T
    group, head = np.arange(len(texts)), np.zeros(len(texts), bool)
    for i, t in enumerate(texts):
        near = np.flatnonzero(head[:i] & (np.minimum(sizes[:i], sizes[i]) >= COPY * np.maximum(sizes[:i], sizes[i])))
        agree = (sig[:, near] == sig[:, i, None]).sum(axis=0)
        near, agree = near[agree >= ALIKE], agree[agree >= ALIKE]
        own = word_hashes(t) if len(near) else None
        for j in near[np.argsort(-agree, kind="stable")].tolist():
            common = len(np.intersect1d(own, word_hashes(texts[j]), assume_unique=True))
            if common >= COPY * (sizes[i] + sizes[j] - common):
                group[i] = j
                break
        head[i] = group[i] == i
    return group


class ToxicityModel:
    """toxic_share: that of all labelled rows; the examples may hold more toxic ones."""

    def __init__(self, ids: list[int], texts: list[str], labels: list[int], toxic_share: float | None = None, k: int = NEIGHBOURS, max_examples: int = MAX_EXAMPLES):
        self.k = k
        self.prior = (float(np.mean(labels)) if labels else 0.0) if toxic_share is None else toxic_share
        group = copy_groups(texts).tolist()
        turn = sorted(range(len(ids)), key=lambda i: (xxhash.xxh64_intdigest(str(ids[i])), i))
        each = [[i for i in turn if labels[i] == y] for y in (0, 1)]
        toxic = min(len(each[1]), max(max_examples // 2, max_examples - len(each[0])))
        some = sorted(each[1][:toxic] + each[0][: max_examples - toxic])
        self.worth = self.worths(labels)
        self._choose_terms(texts, labels, group, set(some))
        ids, texts, labels, group = ([x[i] for i in some] for x in (ids, texts, labels, group))
        self.n, self.worth = len(ids), self.worths(labels)
        rows = [self.vector(t) for t in texts]
        # equal cosines are taken in this order, so it must not know the labels
        common = set(np.argsort(-np.bincount(np.concatenate([np.zeros(0, np.int64), *(r[0] for r in rows)]), minlength=len(self.idf)), kind="stable")[:64].tolist())
        lead = [next((t for t in r[0][np.argsort(-r[1], kind="stable")].tolist() if t in common), -1) for r in rows]
        order = sorted(range(self.n), key=lambda i: (lead[i], xxhash.xxh64_intdigest(str(ids[i])), i))
        self.ids = np.array([ids[i] for i in order], np.int64)
        self.labels = np.array([labels[i] for i in order], np.float64)
        self.group = np.array([group[i] for i in order], np.int64)
        self.share = np.array([self.worth[0] if y else self.worth[1] for y in self.labels])
        self._build_index([rows[i] for i in order])
        self.slope, self.shift = 1.0, 0.0
        if self.n:
            self._calibrate([rows[i] for i in order])

    def _choose_terms(self, texts: list[str], labels: list[int], group: list[int], examples: set[int]) -> None:
        """All words count, of near copies with the same label one; those of the examples are terms."""
        begins = lambda words: {w[:n] + "*" for n in PREFIXES for w in words if len(w) > n}
        seen, vocabulary, df, hits = set(), set(), Counter(), Counter()
        for i, (t, y, g) in enumerate(zip(texts, labels, group)):
            words = set(words_of(t))
            if i in examples:
                vocabulary |= words
            if (g, y) not in seen:
                seen.add((g, y))
                df.update(words)
                if y:
                    hits.update(words)
        n = len(seen)
        telling = {t for t, a in hits.items() if self.tells(a, df[t]) > 0}
        starts, start_hits, seen = Counter(), Counter(), set()
        wanted = begins(telling)
        for t, y, g in zip(texts, labels, group):  # beginnings of telling words, counted like words
            if (g, y) not in seen:
                seen.add((g, y))
                found = begins(set(words_of(t))) & wanted
                starts.update(found)
                if y:
                    start_hits.update(found)
        sure = {b: c for b, c in starts.items() if self.tells(start_hits[b], c) > 0}
        stem = lambda w: any(w[:n] + "*" in sure for n in PREFIXES if len(w) > n)
        names = sorted([*(w for w in vocabulary if w in telling or not stem(w)), *sure])
        self.terms = {t: i for i, t in enumerate(names)}
        self.stems = [(n, {t[:-1]: i for t, i in self.terms.items() if t in sure and len(t) == n + 1}) for n in PREFIXES]
        self.known: dict[str, int] = {}
        count = np.array([max(sure.get(t, 0) or df[t], 1) for t in names], float)
        toxic = np.array([start_hits[t] if t in sure else hits[t] for t in names], float)
        tells = np.array([self.tells(int(a), int(c)) for a, c in zip(toxic, count)])
        self.idf = np.log((n + 1) / count) * (1 + RAISE * tells) if names else np.zeros(0)

    def worths(self, labels: list[int]) -> tuple[float, float]:
        """How many labelled rows a toxic and a clean one of these stand for, one on average."""
        mine = float(np.mean(labels)) if labels else 0.0
        return self.prior / max(mine, 1e-9), (1 - self.prior) / max(1 - mine, 1e-9)

    def tells(self, hits: int, total: int) -> float:
        """How far a word's toxic share among labelled rows surely lies above a half: 0 to 1."""
        if hits < 4:
            return 0.0
        low = lower_share(hits, total)
        toxic, clean = low * self.worth[0], (1 - low) * self.worth[1]
        return max(0.0, 2 * toxic / (toxic + clean) - 1)

    def term(self, word: str) -> int:
        """The term of a word: itself or, if that isn't one, its longest beginning among the terms; -1 without either."""
        t = self.terms.get(word)
        for n, stems in self.stems:
            if t is not None:
                return t
            if len(word) > n:
                t = stems.get(word[:n])
        return -1 if t is None else t

    def vector(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Term numbers and weights of unit length; empty without words of the examples."""
        words, known = words_of(text), self.known
        if len(known) > WORD_CACHE:
            known.clear()
        for w in set(words).difference(known):
            known[w] = self.term(w)
        terms, counts = np.unique(np.fromiter(map(known.__getitem__, words), np.int64, len(words)), return_counts=True)
        if len(terms) and terms[0] < 0:
            terms, counts = terms[1:], counts[1:]
        weights = self.idf[terms] * (1 + np.log(counts))
        norm = math.sqrt(float(weights @ weights))
        return terms, weights / norm if norm else weights

    def _build_index(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> None:
        n_terms, self.blocks = len(self.idf), -(-self.n // BLOCK)
        term = np.concatenate([r[0] for r in rows]) if rows else np.zeros(0, np.int64)
        weight = np.concatenate([r[1] for r in rows]) if rows else np.zeros(0)
        example = np.repeat(np.arange(self.n), [len(r[0]) for r in rows]) if rows else np.zeros(0, np.int64)
        order = np.lexsort((example, term))
        term, self.post_weight, self.post_example = term[order], weight[order], example[order].astype(np.int32)
        cell = term * self.blocks + self.post_example // BLOCK
        self.cell_start = np.searchsorted(cell, np.arange(n_terms * self.blocks + 1)).astype(np.int32)
        most = np.zeros(n_terms * self.blocks)
        np.maximum.at(most, cell, self.post_weight)
        self.block_max = np.nextafter(most.astype(np.float32), np.float32(2)).reshape(n_terms, max(self.blocks, 1) if n_terms else self.blocks)

    def _cosines(self, terms: np.ndarray, weights: np.ndarray, blocks: np.ndarray | None = None) -> np.ndarray:
        """Cosines of all examples, 0 outside the given blocks; terms are added in their order, so copies get equal ones."""
        if blocks is None:  # the cells of a term lie side by side
            first, last = terms * self.blocks, (terms + 1) * self.blocks
        else:
            first = (terms[:, None] * self.blocks + blocks).reshape(-1)
            last, weights = first + 1, np.repeat(weights, len(blocks))
        begin = self.cell_start[first].astype(np.int64)
        sizes = self.cell_start[last] - begin
        ends = np.cumsum(sizes)
        at = np.repeat(begin - ends + sizes, sizes)
        at += np.arange(len(at), dtype=at.dtype)
        return np.bincount(self.post_example[at], self.post_weight[at] * np.repeat(weights, sizes), minlength=self.n)

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int, without: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The k nearest examples and their cosines, exactly; copies of the text are left out, as is a group of near copies."""
        if not len(terms) or not self.n:
            return np.zeros(0, np.int64), np.zeros(0)
        bounds = weights @ self.block_max[terms]
        open_ = bounds >= FIRST * bounds.max()
        allowed = lambda c: np.flatnonzero((c > 0) & (c < 1 - 1e-9) & (True if without is None else self.group != without))
        found = np.zeros(self.n)
        while True:
            all_ = 2 * np.count_nonzero(open_) > self.blocks  # then it is as cheap to open all
            found = self._cosines(terms, weights) if all_ else found + self._cosines(terms, weights, np.flatnonzero(open_))
            best = allowed(found)
            edge = np.partition(found[best], len(best) - k)[len(best) - k] if len(best) >= k else 0.0
            bounds[open_] = -1
            open_ = bounds >= edge - 1e-6
            if all_ or not open_.any():
                break
        near = best[np.lexsort((best, -np.round(found[best], 12)))[:k]]
        return near, found[near]

    def vote(self, ids: np.ndarray, cosines: np.ndarray) -> float:
        if not len(ids):
            return self.prior
        w = self.share[ids] / (1 - np.minimum(cosines, 1) + MARGIN)
        return float((w @ self.labels[ids] + self.prior) / (w.sum() + 1))

    def _calibrate(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """Logistic curve over the logits of leave-one-out votes, by Newton's method with a slight pull to the identity."""
        p = np.clip([self.vote(*self.nearest(*r, self.k, int(g))) for r, g in zip(rows, self.group)], 1e-3, 1 - 1e-3)
        x, y, w = np.log(p / (1 - p)), self.labels, self.share
        loss = lambda v: float(w @ np.logaddexp(0, -(2 * y - 1) * (v[0] * x + v[1])) + ((v[0] - 1) ** 2 + v[1] ** 2) / 2)
        at = np.array([1.0, 0.0])
        for _ in range(25):
            q = 1 / (1 + np.exp(-np.clip(at[0] * x + at[1], -50, 50)))
            g = np.array([w @ ((q - y) * x) + at[0] - 1, w @ (q - y) + at[1]])
            s = w * q * (1 - q)
            step = np.linalg.solve(np.array([[s @ (x * x) + 1, s @ x], [s @ x, s.sum() + 1]]), g)
            while loss(at - step) > loss(at) and np.abs(step).max() > 1e-9:
                step = step / 2
            at = at - step
            if np.abs(step).max() < 1e-7:
                break
        self.slope, self.shift = max(float(at[0]), 0.1), float(at[1])

    def score(self, text: str) -> tuple[float, np.ndarray, np.ndarray]:
        """Probability, neighbours and their cosines."""
        if not self.n:
            return 0.0, np.zeros(0, np.int64), np.zeros(0)
        ids, cosines = self.nearest(*self.vector(text), self.k)
        if not len(ids):
            return self.prior, ids, cosines
        p = min(max(self.vote(ids, cosines), 1e-3), 1 - 1e-3)
        return 1 / (1 + math.exp(-(self.slope * math.log(p / (1 - p)) + self.shift))), ids, cosines


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, max_examples: int = MAX_EXAMPLES, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> ToxicityModel:
    """A model from at most max_rows labelled rows that are not held out, half of them toxic if there are as many."""
    truth = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y")).where("doc_id is not null and y in (0, 1)")
    truth = truth.where(~held_out_expr()).groupBy("doc_id").agg(F.max("y").alias("y"))
    by_class = dict.fromkeys((0, 1), 0) | {r["y"]: r["n"] for r in truth.groupBy("y").agg(F.count("*").alias("n")).collect()}
    toxic = min(by_class[1], max(max_rows // 2, max_rows - by_class[0]))
    chosen = [truth.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for y, n in ((1, toxic), (0, max_rows - toxic))]
    rows = id_text(docs, id_col, text_col).join(F.broadcast(chosen[0].union(chosen[1])), "doc_id").orderBy("doc_id", "text").limit(max_rows).toArrow().to_pydict()
    total = sum(by_class.values())
    return ToxicityModel(rows["doc_id"], rows["text"], rows["y"], by_class[1] / total if total else 0.0, max_examples=max_examples)


def toxicity_scores(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted and the evidence: the nearest examples with their cosines and labels."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # the words of at most max_examples texts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.int32())]))
        for ids, texts in text_chunks(batches):
            got = [m.score(t) for t in texts]
            scores = [g[0] for g in got]
            evidence = [[{"doc_id": int(m.ids[e]), "cosine": float(c), "toxic": int(m.labels[e])} for e, c in zip(g[1][:5], g[2][:5])] for g in got]
            yield pa.RecordBatch.from_pydict({"doc_id": pa.array(ids, pa.int64()), "held_out": pa.array([held_out(i) for i in ids], pa.bool_()), "score": pa.array(scores, pa.float64()), "predicted": pa.array([int(s >= threshold) for s in scores], pa.int32()), "evidence": pa.array(evidence, kind)})

    return id_text(docs, id_col, text_col).mapInArrow(lean(run), "doc_id long, held_out boolean, score double, predicted int, evidence array<struct<doc_id: long, cosine: double, toxic: int>>")


def drop_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns as they were, whose score is below the threshold."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    small_batches(docs.sparkSession)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            yield b.filter(pa.array([m.score(t.as_py() or "")[0] < threshold for t in b.column(at)], pa.bool_()))

    return docs.mapInArrow(lean(run), docs.schema)

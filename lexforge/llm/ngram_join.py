"""Similarity join of documents by the Jaccard index of their word n-grams, with Bayesian pruning of candidates.

Documents with the same n-gram set form one class and take part once. Each class has MinHash values; classes that agree
on any band of them are linked to the smallest class of that band, and the components of these links are the groups in
which partners are sought. Within a group, pairs are compared some MinHash values at a time: under a uniform prior, the
posterior probability that a pair reaches the threshold follows from the matches so far, and the pair is dropped when it
falls below the tolerance. Pairs that are left are verified exactly on their n-gram sets (64-bit hashes of n-grams).

Groups larger than a block are dealt out as pairs of blocks, so no task holds a whole large group. A task returns one
row per class, its verified links counted and its smallest partner, never the pairs.

Words are runs of word characters in lower case; a text with fewer words than n has one n-gram of all its words.

Defined results: null text is empty; texts without words have no partners, not even each other; a null id takes no part
(its class is null); rows that share an id are one document; a document's links are the other documents that reach the
threshold, copies included.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import cut, finish, id_text, join_frequent, lean, mix64, power_of_two, text_chunks
from .components import connected_components

WORDS = 5
THRESHOLD = 0.8
#: MinHash values, bands of them for candidates, and values compared between two looks at the posterior.
HASHES = 128
BANDS = 32
STEP = 16
#: A pair is dropped when the probability that it reaches the threshold is below this.
TOLERANCE = 1e-7
#: Classes of a block, and of a task that holds several small groups.
BLOCK = 1_024
TASK_ROWS = 2_048
WORD_CACHE = 300_000

WORD = re.compile(r"\w+")
_RNG = np.random.default_rng(20_240_501)
_XOR = _RNG.integers(0, 2**64, HASHES, np.uint64)
_MUL = _RNG.integers(0, 2**64, HASHES, np.uint64) | np.uint64(1)
_PLACE = _RNG.integers(0, 2**64, 64, np.uint64) | np.uint64(1)


class _WordHashes(dict):
    def __missing__(self, word: str) -> int:
        h = xxhash.xxh64_intdigest(word)
        if len(self) < WORD_CACHE:
            self[word] = h
        return h


_WORDS = _WordHashes()


def gram_sets(texts: list[str], n: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the word n-grams of each text."""
    words, ends = [], []
    for t in texts:
        words += WORD.findall(t.lower())
        ends.append(len(words))
    h = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    grams = np.zeros(max(len(h) - n + 1, 0), np.uint64)
    for k in range(n):
        grams += mix64(h[k : k + len(grams)]) * _PLACE[k]
    grams = mix64(grams)
    out, a = [], 0
    for b in ends:
        if b - a >= n:
            out.append(np.unique(grams[a : b - n + 1]))
        elif b > a:
            whole = (mix64(h[a:b]) * _PLACE[32 : 32 + b - a]).sum(dtype=np.uint64, keepdims=True)
            out.append(mix64(whole + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
        a = b
    return out


def min_hashes(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash values of non-empty sets, one row each."""
    out = np.empty((len(sets), HASHES), np.uint32)
    a = 0
    while a < len(sets):  # some sets at a time, so that the arrays stay in the processor's cache
        b, size = a, 0
        while b < len(sets) and (b == a or size + len(sets[b]) <= 65_536):
            size += len(sets[b])
            b += 1
        flat = np.concatenate(sets[a:b])
        starts = np.concatenate(([0], np.cumsum([len(s) for s in sets[a : b - 1]], dtype=np.int64))).astype(np.int64)
        for i in range(HASHES):
            out[a:b, i] = np.minimum.reduceat(((flat ^ _XOR[i]) * _MUL[i]) >> np.uint64(32), starts)
        a = b
    return out


def least_matches(threshold: float, tolerance: float) -> dict[int, int]:
    """For each number of values compared, the fewest matches with which a pair is not dropped.

    With a uniform prior and m of n matches, the posterior of the similarity is Beta(m + 1, n - m + 1); its mass above t
    is the chance that a binomial count of n + 1 draws of probability t is at most m.
    """
    out = {}
    for n in range(STEP, HASHES + 1, STEP):
        mass, m = 0.0, -1
        while mass < tolerance and m < n:
            m += 1
            mass += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out[n] = m
    return out


def verified_pairs(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray | None, threshold: float, tolerance: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of left × right (left × left, each once, without right) whose Jaccard index reaches the threshold."""
    sizes = np.array([len(s) for s in sets])
    sig = min_hashes(sets)
    need = least_matches(threshold, tolerance)
    first, second = [], []
    for k, i in enumerate(left.tolist()):
        others = left[k + 1 :] if right is None else right
        lo, hi = np.minimum(sizes[i], sizes[others]), np.maximum(sizes[i], sizes[others])
        others = others[lo >= threshold * hi - 1e-9]
        matches = np.zeros(len(others), np.int64)
        for n in range(STEP, HASHES + 1, STEP):
            if not len(others):
                break
            matches += (sig[others, n - STEP : n] == sig[i, n - STEP : n]).sum(axis=1)
            stay = matches >= need[n]
            others, matches = others[stay], matches[stay]
        first.append(np.full(len(others), i))
        second.append(others)
    a = np.concatenate(first) if first else np.zeros(0, np.int64)
    b = np.concatenate(second) if second else np.zeros(0, np.int64)
    if not len(a):
        return a, b
    common = shared_counts(sets, a, b)
    stay = common >= threshold * (sizes[a] + sizes[b] - common) - 1e-9
    return a[stay], b[stay]


def shared_counts(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of pairs: by set operations if the pairs are few, else by products of incidence blocks."""
    used = np.unique(np.concatenate([a, b]))
    if len(a) <= 8 * len(used):
        as_set = {i: set(sets[i].tolist()) for i in used.tolist()}
        return np.fromiter((len(as_set[i] & as_set[j]) for i, j in zip(a.tolist(), b.tolist())), np.int64, len(a))
    at = np.zeros(len(sets), np.int64)
    at[used] = np.arange(len(used))
    flat = np.concatenate([sets[i] for i in used.tolist()])
    owner = np.repeat(np.arange(len(used)), [len(sets[i]) for i in used.tolist()])
    _, column, df = np.unique(flat, return_inverse=True, return_counts=True)
    keep = df[column] > 1
    owner, column = owner[keep], column[keep]
    _, column = np.unique(column, return_inverse=True)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total = np.zeros((len(used), len(used)), np.float32)
    width = 4_096
    for c in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        lo, hi = np.searchsorted(column, [c, c + width])
        block = np.zeros((len(used), width), np.float32)
        block[owner[lo:hi], column[lo:hi] - c] = 1
        total += block @ block.T
    return np.rint(total[at[a], at[b]]).astype(np.int64)


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> list[int]:
    """The smallest index connected with each of n indexes."""
    parent = list(range(n))

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x, y in zip(a.tolist(), b.tolist()):
        x, y = top(x), top(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    return [top(x) for x in range(n)]


SKETCH = "doc_id long, set_key binary, n_grams int, sig binary"


def sketches(docs: DataFrame, n: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in text_chunks(batches):
            sets = gram_sets(texts, n)
            full = [i for i, s in enumerate(sets) if len(s)]
            sig = dict(zip(full, min_hashes([sets[i] for i in full])))
            yield pa.RecordBatch.from_pydict({"doc_id": pa.array(ids, pa.int64()), "set_key": pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()), "n_grams": pa.array([len(s) for s in sets], pa.int32()), "sig": pa.array([sig[i].tobytes() if i in sig else None for i in range(len(sets))], pa.binary())})

    return docs.where("doc_id is not null").mapInArrow(lean(run), SKETCH)


def candidate_groups(classes: DataFrame) -> DataFrame:
    """(id, component) of the classes that agree on a band with another one."""
    rows = HASHES // BANDS * 4
    keys = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.xxhash64(i, F.expr("sig").substr(i * rows + 1, F.lit(rows))))
    bands = classes.select("rep", F.explode(keys).alias("band"))
    heads = bands.groupBy("band").agg(F.min("rep").alias("head"), F.count("*").alias("c")).where("c > 1").drop("c")
    links = bands.join(heads, "band").where("rep <> head").select(F.col("rep").alias("a"), F.col("head").alias("b")).distinct()
    return connected_components(links)


def ngram_join(docs: DataFrame, n: int = WORDS, threshold: float = THRESHOLD, tolerance: float = TOLERANCE, block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, class_id, n_links, n_grams: class_id is the smallest id that links lead to."""
    texts = id_text(docs, id_col, text_col)
    sketch = cut(sketches(texts, n))
    sets = sketch.where("n_grams > 0").groupBy("set_key").agg(F.min("doc_id").alias("rep"), F.countDistinct("doc_id").alias("copies"))
    sets = cut(sets)
    own = sketch.select("set_key", F.col("doc_id").alias("rep"), "sig")
    classes = sets.join(own, ["set_key", "rep"]).select("rep", "sig")
    groups = finish(lambda: candidate_groups(classes))
    sizes = groups.groupBy("component").agg(F.count("*").alias("size"))
    total = groups.count()
    tasks = power_of_two(total / TASK_ROWS, 16)
    members = groups.join(sizes, "component").join(sets.select(F.col("rep").alias("id"), "copies"), "id")
    blocks = F.ceil(F.col("size") / block).cast("int")
    members = members.withColumn("blocks", blocks).withColumn("mine", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    met = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    small = F.col("blocks") == 1
    met = met.select(
        "id", "component", "copies", "mine", (F.col("blocks") > 1).alias("split"),
        F.when(small, F.pmod(F.xxhash64("component"), F.lit(tasks))).otherwise(F.xxhash64("component", F.least("mine", "other"), F.greatest("mine", "other"))).alias("task"),
        F.when(small, F.lit(0)).otherwise(F.least("mine", "other")).alias("lo"), F.when(small, F.lit(0)).otherwise(F.greatest("mine", "other")).alias("hi"),
    )
    met = met.join(texts.select(F.col("doc_id").alias("id"), "text"), "id")

    def compare(rows: pa.Table) -> pa.Table:
        """Links inside the groups, or pairs of blocks, of one task."""
        ids, texts = rows.column("id").to_pylist(), rows.column("text").to_pylist()
        copies, mine, split = (rows.column(c).to_pylist() for c in ("copies", "mine", "split"))
        cells = defaultdict(dict)
        for i, cell in enumerate(zip(rows.column("component").to_pylist(), rows.column("lo").to_pylist(), rows.column("hi").to_pylist())):
            cells[cell].setdefault(ids[i], i)  # repeated rows count once
        out: dict[str, list] = {"id": [], "root": [], "links": [], "split": []}
        for (_, lo, hi), found in cells.items():
            order = [found[i] for i in sorted(found)]
            if len(order) < 2:
                continue
            grams = [s for k in range(0, len(order), 256) for s in gram_sets([texts[i] for i in order[k : k + 256]], n)]
            if lo == hi:
                a, b = verified_pairs(grams, np.arange(len(order)), None, threshold, tolerance)
            else:
                side = np.array([mine[i] for i in order])
                a, b = verified_pairs(grams, np.flatnonzero(side == lo), np.flatnonzero(side == hi), threshold, tolerance)
            if not len(a):
                continue
            weight = np.array([copies[i] for i in order])
            links = np.bincount(a, weight[b], len(order)) + np.bincount(b, weight[a], len(order))
            roots = local_roots(len(order), a, b)
            for k in np.flatnonzero(links).tolist():
                out["id"].append(ids[order[k]])
                out["root"].append(ids[order[roots[k]]])
                out["links"].append(int(links[k]))
                out["split"].append(split[order[k]])
        types = {"id": pa.int64(), "root": pa.int64(), "links": pa.int64(), "split": pa.bool_()}
        return pa.table({k: pa.array(v, types[k]) for k, v in out.items()})

    found = cut(met.groupBy("task").applyInArrow(lean(compare), "id long, root long, links long, split boolean"))
    wide = connected_components(found.where("split").select(F.col("id").alias("a"), F.col("root").alias("b")))
    roots = found.where("not split").select("id", "root").union(wide.select("id", "component"))
    links = found.groupBy("id").agg(F.sum("links").alias("links")).join(roots, "id")
    per_set = sets.join(links.withColumnRenamed("id", "rep"), "rep", "left").select("set_key", "copies", F.coalesce("root", "rep").alias("class_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    named = sketch.select("doc_id", "set_key", "n_grams")
    rows = join_frequent(named.where("n_grams > 0"), cut(per_set), ["set_key"], "copies", named.count())
    rows = rows.select("doc_id", "class_id", F.col("n_links").cast("long").alias("n_links"), "n_grams")
    rows = rows.unionByName(named.where("n_grams = 0").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), "n_grams"))  # texts without words
    none = texts.where("doc_id is null").select("doc_id", F.lit(None).cast("long").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.lit(0).alias("n_grams"))
    return rows.unionByName(none)


ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+') AS w FROM documents WHERE doc_id IS NOT NULL),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], chr(1)))) END AS g FROM w),
grams AS (SELECT doc_id, unnest(g) AS g FROM sets), shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
pairs AS (SELECT a, b FROM shared JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b WHERE n >= 0.8 * (len(x.g) + len(y.g) - n) - 1e-9),
links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs), reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
low AS (SELECT a, min(b) AS b FROM reach GROUP BY a), n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT doc_id, least(doc_id, coalesce(low.b, doc_id)) AS class_id, coalesce(n.n, 0) AS n_links, CAST(len(g) AS INT) AS n_grams FROM sets LEFT JOIN low ON low.a = doc_id LEFT JOIN n ON n.a = doc_id
UNION ALL SELECT doc_id, NULL, 0, 0 FROM documents WHERE doc_id IS NULL
"""

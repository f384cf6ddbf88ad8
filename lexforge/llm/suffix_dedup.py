"""Removal of byte strings that occur earlier in the corpus, by merging Burrows-Wheeler transforms of shards.

Candidates. Every window of `length` bytes is represented by the smallest hash among the `GRAM`-byte strings in it;
equal windows have equal representatives. Successive windows with the same representative are one run, kept as its
representative's hash, a hash of its bytes and its place. Runs whose representative occurs once cannot repeat. Of runs
with the same bytes (by 128 bits of hash: representative and run) all but the first are repeats as a whole. What is left are the first runs of representatives that
occur with different bytes around them: parts of these may repeat.

Parts. These runs are dealt out by representative. A task cuts its runs into shards, orders each shard's suffixes by
their first bytes (a transform of bounded order) and takes the shard's Burrows-Wheeler transform over STEP symbols. The
transforms are merged by refining an interleave of the shards: it begins with the suffixes at the ends of all windows;
each round goes STEP bytes to the left by the last-to-first maps and needs only stable passes over the symbols there, so
after h rounds all suffixes are in the order of their first h * STEP bytes and no suffix is ever sorted anew. Suffixes are
grouped by common prefix on the way: one that is alone in its group cannot become a repeat and is left out. At `length`
bytes the groups are the repeated windows, compared byte by byte, and all their members but the earliest are repeats.

Representatives with more than HOT_RUNS different runs (a passage that a large part of all documents holds, at its edges)
are not gathered in a task: their windows are grouped by their bytes in an ordinary aggregation, which is as exact.

Defined results: null text is empty; texts shorter than `length` have nothing removed; rows with a null id take no part
and are returned whole; rows that share an id are the same document; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import cut, drop_table, finish, free_shuffles, id_text, join_frequent, lean, mix64, power_of_two, small_batches, text_bytes, text_chunks

LENGTH = 100
#: Bytes of a representative string.
GRAM = 24
#: Window starts that are worked on at a time; at most 2^20.
SLICE = 500_000
#: Runs of a task that merges transforms, shards of it, and the runs of one representative from which windows are hashed.
TASK_RUNS = 8_192
SHARDS = 4
HOT_RUNS = 8_192
#: Bytes a round of the merge compares, bytes that a shard's suffixes are ordered by beforehand, bytes of a batch of runs.
STEP = 4
ORDER = 7
CUT_BYTES = 4_000_000

_MULTIPLIER = 0x5851F42D4C957F2D
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_TABLE = np.random.default_rng(11).integers(0, 2**64, 256, np.uint64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_MULTIPLIER, SLICE + 2_000), _powers(_INVERSE, SLICE + 2_000)


class Hashes:
    """Hashes of all substrings of a piece of text, by prefix sums of a polynomial."""

    def __init__(self, raw: np.ndarray):
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_TABLE[raw] * _UP[: len(raw)], dtype=np.uint64)))

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((self.sums[end] - self.sums[start]) * _DOWN[start] + (end - start).astype(np.uint64))

    def grams(self, n: int) -> np.ndarray:
        return mix64((self.sums[n:] - self.sums[:-n]) * _DOWN[: len(self.sums) - n])


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return x if size == width else np.minimum(x[: len(x) - (width - size)], x[width - size :])


def runs_of(raw: np.ndarray, owner: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First and last window start, hash of the representative and hash of the bytes of every run.

    owner: the number of the document that each byte belongs to; windows stay inside a document.
    """
    empty = np.zeros(0, np.int64)
    if len(raw) < length:
        return empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    hashes = Hashes(raw)
    grams = hashes.grams(GRAM)
    low = np.uint64((1 << 20) - 1)
    least = sliding_min(grams & ~low | np.arange(len(grams), dtype=np.uint64), length - GRAM + 1)
    at = (least & low).astype(np.int64)
    starts = np.flatnonzero(owner[: len(at)] == owner[length - 1 : length - 1 + len(at)])
    if not len(starts):
        return empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    at = at[starts]
    new = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1))))
    first, last = starts[new], starts[np.concatenate((new[1:], [len(starts)])) - 1]
    return first, last, grams[at[new]], hashes.of(first, last + length)


RUNS = "h long, c long, doc_id long, lo int, hi int"


def find_runs(texts: DataFrame, length: int) -> DataFrame:
    def emit(ids: np.ndarray, shift: np.ndarray, raw: np.ndarray, owner: np.ndarray) -> pa.RecordBatch:
        first, last, h, c = runs_of(raw, owner, length)
        who = owner[first]
        cols = (h.view(np.int64), c.view(np.int64), ids[who], (first - shift[who]).astype(np.int32), (last - shift[who]).astype(np.int32))
        return pa.RecordBatch.from_arrays([pa.array(x) for x in cols], ["h", "c", "doc_id", "lo", "hi"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts_ in text_chunks(batches, SLICE // 4):
            raws = [t.encode() for t in texts_]
            full = [i for i, r in enumerate(raws) if len(r) >= length]
            if not full:
                continue
            sizes = np.array([len(raws[i]) for i in full])
            if sizes.sum() <= SLICE:
                starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
                yield emit(np.array([ids[i] for i in full]), starts, np.frombuffer(b"".join(raws[i] for i in full), np.uint8), np.repeat(np.arange(len(full)), sizes))
                continue
            for i in full:  # long texts by slices that overlap by less than a window
                for a in range(0, len(raws[i]) - length + 1, SLICE - length):
                    part = np.frombuffer(raws[i], np.uint8, min(SLICE - 1, len(raws[i]) - a), a)
                    yield emit(np.array([ids[i]]), np.array([-a]), part, np.zeros(len(part), np.int64))

    return texts.mapInArrow(lean(run), RUNS)


def suffix_order(text: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Order of all suffixes of strings that end with symbol 0 by their first ORDER symbols; others stay in place order."""
    place = np.arange(len(text), dtype=np.int64)
    key = np.zeros(len(text), np.uint64)
    for d in range(ORDER):
        here = place + d
        key = key << np.uint64(9) | np.where(here <= ends, text[np.minimum(here, len(text) - 1)], 0).astype(np.uint64)
    return np.argsort(key, kind="stable")


class Transform(NamedTuple):
    """A shard's transform over STEP symbols: for each row, in the order of the suffixes, the symbols before the suffix and
    the row of the suffix that begins with them (-1: they reach beyond the run); and the places of the suffixes."""

    symbols: np.ndarray
    row: np.ndarray
    place: np.ndarray


def shard_transform(raw: np.ndarray, sizes: np.ndarray) -> Transform:
    """Transform of a few runs laid end to end in raw; each is closed by a 0 of its own."""
    bounds = np.concatenate(([0], np.cumsum(sizes + 1)))
    text = np.zeros(bounds[-1], np.uint16)
    inner = np.ones(bounds[-1], bool)
    inner[bounds[1:] - 1] = False
    text[inner] = raw.astype(np.uint16) + 1
    order = suffix_order(text, np.repeat(bounds[1:] - 1, sizes + 1))
    row = np.empty(len(order), np.int32)
    row[order] = np.arange(len(order), dtype=np.int32)
    inside = order - np.repeat(bounds[:-1], sizes + 1)[order] >= STEP
    before = np.maximum(order - STEP, 0)
    symbols = np.zeros(len(order), np.uint32)
    for d in range(STEP):  # symbols of a place in the run lie in 1..256
        symbols = symbols << np.uint32(8) | (text[np.minimum(before + d, len(text) - 1)] - 1 & 255).astype(np.uint32)
    return Transform(symbols, np.where(inside, row[before], -1), order)


def merge_transforms(shards: list[Transform], ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Members of all groups of suffixes with a common prefix of `length` bytes, and their group numbers.

    Members are places in the shards' texts laid end to end; ends are the places that lie `length` bytes after a member.
    After each round the interleave holds the suffixes STEP bytes further to the left in the order of the bytes compared.
    """
    base = np.concatenate(([0], np.cumsum([len(s.place) for s in shards])))
    symbols = np.concatenate([s.symbols for s in shards])
    back = np.concatenate([np.where(s.row < 0, -1, s.row + b) for s, b in zip(shards, base)])
    place = np.concatenate([s.place + b for s, b in zip(shards, base)])
    wanted = np.zeros(base[-1], bool)
    wanted[ends] = True
    current = np.flatnonzero(wanted[place])  # round 0: no bytes compared, shard after shard
    group = np.zeros(len(current), np.int64)
    for _ in range(length // STEP):
        s = symbols[current]
        order = np.argsort((s & np.uint32(0xFFFF)).astype(np.uint16), kind="stable")
        order = order[np.argsort((s >> np.uint32(16)).astype(np.uint16)[order], kind="stable")]
        current, group, s = back[current[order]], group[order], s[order]
        if not len(current):
            break
        new = np.concatenate(([True], (s[1:] != s[:-1]) | (group[1:] != group[:-1])))
        shared = ~(new & np.concatenate((new[1:], [True])))
        group = np.cumsum(new)[shared]
        current = current[shared]
    return place[current], group


def repeated_parts(docs: np.ndarray, lows: np.ndarray, raw: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """doc_id, first and last start of the windows in these runs that have an earlier equal one among them.

    raw: the runs' bytes end to end, run k from bounds[k] to bounds[k + 1].
    """
    n = len(docs)
    edges = np.linspace(0, n, min(SHARDS, n) + 1).astype(np.int64)
    sizes = np.diff(bounds)
    shards = [shard_transform(raw[bounds[a] : bounds[b]], sizes[a:b]) for a, b in zip(edges, edges[1:])]
    at = bounds[:-1] + np.arange(n)  # where each run begins among texts that have one more symbol a run
    windows = sizes - length + 1
    ends = np.repeat(at + length, windows) + _counted(windows)
    trimmed = length - length % STEP  # windows are compared in whole steps, the odd bytes at their beginning below
    members, group = merge_transforms(shards, ends, trimmed)
    members, group = _compare_rest(members, group, raw, at, length - trimmed)
    run = np.searchsorted(at, members, "right") - 1
    doc, start = docs[run], lows[run] + members - at[run]
    by = np.lexsort((start, doc, group))
    doc, start, group = doc[by], start[by], group[by]
    if not len(group):
        return docs[:0], lows[:0], lows[:0]
    head = np.maximum.accumulate(np.where(np.concatenate(([True], group[1:] != group[:-1])), np.arange(len(group)), 0))
    later = (doc != doc[head]) | (start != start[head])  # a repeated row has the same place
    doc, start = doc[later], start[later]
    by = np.lexsort((start, doc))
    doc, start = doc[by], start[by]
    new = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (start[1:] > start[:-1] + 1)))) if len(doc) else np.zeros(0, np.int64)
    last = np.concatenate((new[1:], [len(doc)])).astype(np.int64) - 1 if len(doc) else new
    return doc[new], start[new], start[last]


def _counted(sizes: np.ndarray) -> np.ndarray:
    """0, 1, … for each of the sizes, end to end."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)


def _compare_rest(members: np.ndarray, group: np.ndarray, raw: np.ndarray, at: np.ndarray, rest: int) -> tuple[np.ndarray, np.ndarray]:
    """One byte more to the left for each of the `rest` bytes that whole steps left over."""
    for _ in range(rest):
        members = members - 1
        run = np.searchsorted(at, members, "right") - 1
        s = raw[members - run]
        order = np.lexsort((s, group))
        members, group, s = members[order], group[order], s[order]
        group = np.cumsum(np.concatenate(([True], (s[1:] != s[:-1]) | (group[1:] != group[:-1])))) if len(s) else group
    return members, group


SPANS = "doc_id long, lo int, hi int"


def cut_runs(texts: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """(h, doc_id, lo, run) for wanted (h, doc_id, lo, hi); a batch of at most CUT_BYTES (or one run) at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, bounds = text_bytes(b.column(1))
            found, counts = b.column(2).flatten(), pc.list_value_length(b.column(2)).to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(b.num_rows), counts)
            h, lo, hi = (found.field(k).to_numpy(zero_copy_only=False) for k in range(3))
            begin, size = bounds[row] + lo, hi.astype(np.int64) - lo + length
            fits = np.flatnonzero(begin + size <= bounds[row + 1])  # rows that share an id may hold other texts
            doc = b.column(0).to_numpy(zero_copy_only=False)[row]
            upto = np.cumsum(size[fits])
            a = 0
            while a < len(fits):
                e = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + CUT_BYTES, "right")))
                part = fits[a:e]
                offsets = np.concatenate(([0], np.cumsum(size[part]))).astype(np.int32)
                data = raw[np.repeat(begin[part] - offsets[:-1], size[part]) + np.arange(offsets[-1])]
                runs = pa.BinaryArray.from_buffers(pa.binary(), len(part), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
                yield pa.RecordBatch.from_arrays([pa.array(h[part]), pa.array(doc[part]), pa.array(lo[part]), runs], ["h", "doc_id", "lo", "run"])
                a = e

    lists = wanted.groupBy("doc_id").agg(F.collect_list(F.struct("h", "lo", "hi")).alias("found"))
    return texts.join(lists, "doc_id").select("doc_id", "text", "found").mapInArrow(lean(run), "h long, doc_id long, lo int, run binary")


def windows_of(parts: DataFrame, length: int) -> DataFrame:
    """(window, doc_id, lo): the bytes of every window of the runs (h, doc_id, lo, run)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 500):
                raw, bounds = text_bytes(b.column(3).slice(k, 500))
                doc, lo = (b.column(c).slice(k, 500).to_numpy(zero_copy_only=False) for c in (1, 2))
                n = np.diff(bounds) - length + 1
                step = _counted(n)
                data = raw[(np.repeat(bounds[:-1], n) + step)[:, None] + np.arange(length)]
                offsets = np.arange(len(data) + 1, dtype=np.int32) * length
                found = pa.BinaryArray.from_buffers(pa.binary(), len(data), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])
                yield pa.RecordBatch.from_arrays([found, pa.array(np.repeat(doc, n)), pa.array((np.repeat(lo, n) + step).astype(np.int32))], ["window", "doc_id", "lo"])

    return parts.mapInArrow(lean(run), "window binary, doc_id long, lo int")


def repeat_spans(texts: DataFrame, length: int = LENGTH, hot_runs: int = HOT_RUNS) -> DataFrame:
    """(doc_id, lo, hi): ranges of window starts whose windows have an earlier equal one."""
    spark = texts.sparkSession
    runs = cut(find_runs(texts, length))
    often = runs.groupBy("h").agg(F.count("*").alias("n"), F.min("c").alias("c1"), F.max("c").alias("c2")).where("n > 1").select("h", "n", (F.col("c1") != F.col("c2")).alias("mixed"))
    often = cut(often)
    shared = cut(join_frequent(runs, often, ["h"], "n", runs.count()).drop("n"))
    for t in (runs, often):
        drop_table(t)
    free_shuffles(spark)
    heads = cut(shared.groupBy("h", "c").agg(F.min(F.struct("doc_id", "lo")).alias("head"), F.count("*").alias("n")).where("n > 1"))
    alone = shared.where("mixed").join(heads.select("h", "c"), ["h", "c"], "left_anti").select("h", "doc_id", "lo", "hi", "mixed", F.lit(True).alias("first"))
    first = (F.col("doc_id") == F.col("head.doc_id")) & (F.col("lo") == F.col("head.lo"))
    several = join_frequent(shared, heads, ["h", "c"], "n", shared.count()).select("h", "doc_id", "lo", "hi", "mixed", first.alias("first"))
    placed = cut(several.unionByName(alone))
    for t in (shared, heads):
        drop_table(t)
    free_shuffles(spark)
    whole = placed.where("not first").select("doc_id", "lo", "hi")
    open_ = placed.where("first and mixed").select("h", "doc_id", "lo", "hi").distinct()
    parts = cut(cut_runs(texts, open_, length))
    free_shuffles(spark)
    n = parts.count()
    hot = parts.groupBy("h").count().where(F.col("count") > hot_runs).select("h")  # at most n / hot_runs of them
    hot = cut(hot)
    tasks = power_of_two(n / TASK_RUNS, 16)

    def merge(rows: pa.Table) -> pa.Table:
        raw, bounds = text_bytes(rows.column("run").combine_chunks())
        doc, lo, hi = repeated_parts(rows.column("doc_id").to_numpy(), rows.column("lo").to_numpy().astype(np.int64), raw, bounds, length)
        return pa.table({"doc_id": pa.array(doc, pa.int64()), "lo": pa.array(lo.astype(np.int32)), "hi": pa.array(hi.astype(np.int32))})

    cool = parts.join(hot, "h", "left_anti").withColumn("task", F.pmod(F.xxhash64("h"), F.lit(tasks)))
    some = cool.groupBy("task").applyInArrow(lean(merge), SPANS)
    single = windows_of(parts.join(hot, "h", "left_semi"), length)
    first = single.groupBy("window").agg(F.min(F.struct("doc_id", "lo")).alias("head"), F.count("*").alias("n")).where("n > 1")
    rest = single.join(first, "window").where(F.struct("doc_id", "lo") != F.col("head")).select("doc_id", "lo", F.col("lo").alias("hi"))
    return whole.unionByName(some).unionByName(rest)


def span_lists(docs: DataFrame, length: int, hot_runs: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, spans) of the documents that have something to remove."""
    spans = finish(lambda: repeat_spans(id_text(docs, id_col, text_col).where("doc_id is not null"), length, hot_runs))
    return spans.groupBy("doc_id").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))


def suffix_dedup(docs: DataFrame, length: int = LENGTH, hot_runs: int = HOT_RUNS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    lists = span_lists(docs, length, hot_runs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[] for _ in range(5)]
            for i, t, found in zip(b.column(0).to_pylist(), b.column(1), b.column(2)):
                raw = t.as_py().encode()
                kept, removed, n = remove_spans(raw, found.values if found.is_valid else None, length)
                for c, v in zip(out, (i, len(raw), removed, n, hashlib.sha256(kept).hexdigest())):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (*[pa.int64()] * 4, pa.string()))], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return id_text(docs, id_col, text_col).join(lists, "doc_id", "left").select("doc_id", "text", "spans").mapInArrow(lean(run), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def strip_repeats(docs: DataFrame, length: int = LENGTH, hot_runs: int = HOT_RUNS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with its columns, repeats cut out of the texts; bytes that no longer form whole characters go too."""
    small_batches(docs.sparkSession)
    key, spans = "_suffix_dedup_id", "_suffix_dedup_spans"
    lists = span_lists(docs, length, hot_runs, id_col, text_col).select(F.col("doc_id").alias(key), F.col("spans").alias(spans))
    names = docs.columns
    at = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = []
            for t, found in zip(b.column(at), b.column(len(names))):
                t = t.as_py()
                texts.append(t if t is None or not found.is_valid else remove_spans(t.encode(), found.values, length)[0].decode("utf-8", "ignore"))
            cols = list(b.columns[: len(names)])
            cols[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(cols, names)

    joined = docs.join(lists, docs[id_col].cast("long") == F.col(key), "left").select(*(docs[c] for c in names), spans)
    return joined.mapInArrow(lean(run), docs.schema)


def remove_spans(raw: bytes, found: pa.StructArray | None, length: int) -> tuple[bytes, int, int]:
    """What is left without the windows that start in the given ranges, the bytes removed and the runs of them."""
    if found is None or not len(found):
        return raw, 0, 0
    lo, hi = found.field(0).to_numpy(), found.field(1).to_numpy().astype(np.int64) + length
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    new = np.flatnonzero(np.concatenate(([True], lo[1:] > hi[:-1])))
    begin, end = lo[new].tolist(), hi[np.concatenate((new[1:], [len(lo)])) - 1].tolist()
    kept = b"".join(raw[a:b] for a, b in zip([0, *end], [*begin, len(raw)]))
    return kept, len(raw) - len(kept), len(begin)


ORACLE = """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents WHERE doc_id IS NOT NULL),
win AS (SELECT doc_id, s, b[s:s + 99] AS x FROM d, LATERAL (SELECT unnest(range(1, octet_length(b) - 98)) AS s)),
firsts AS (SELECT x, min((doc_id, s)) AS f FROM win GROUP BY x HAVING count(*) > 1),
hits AS (SELECT win.doc_id, s FROM win JOIN firsts USING (x) WHERE (win.doc_id, s) <> f),
runs AS (SELECT doc_id, s, sum(CASE WHEN s <= p + 100 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY s) AS k FROM (SELECT *, lag(s) OVER (PARTITION BY doc_id ORDER BY s) AS p FROM hits)),
spans AS (SELECT doc_id, k, min(s) AS a, max(s) + 100 AS z FROM runs GROUP BY doc_id, k),
kept AS (SELECT doc_id, a, lag(z, 1, 1) OVER (PARTITION BY doc_id ORDER BY a) AS from_ FROM spans),
texts AS (SELECT doc_id, string_agg(hex(b[from_:a - 1]), '' ORDER BY a) AS h, max(z) AS z FROM kept JOIN (SELECT doc_id, max(z) AS z FROM spans GROUP BY doc_id) USING (doc_id) JOIN d USING (doc_id) GROUP BY doc_id),
n AS (SELECT doc_id, sum(z - a) AS removed, count(*) AS spans FROM spans GROUP BY doc_id)
SELECT doc_id, octet_length(b) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, coalesce(spans, 0) AS n_spans, sha256(CASE WHEN h IS NULL THEN b ELSE unhex(h || hex(b[z:octet_length(b)])) END) AS kept_sha256
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN texts USING (doc_id)
UNION ALL SELECT doc_id, octet_length(encode(coalesce(text, ''))), 0, 0, sha256(coalesce(text, '')) FROM documents WHERE doc_id IS NULL
"""

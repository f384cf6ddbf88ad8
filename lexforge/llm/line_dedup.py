"""Line deduplication by an edit-distance join with segment partitions.

Two lines are partners when at most `edits` insertions, deletions and substitutions of characters lead from one to the
other. Cut into edits + 1 segments, a line must keep one segment unchanged in each partner, near its place: so segments
are indexed by length of the line and number of the segment, and a line probes, for each length it may meet, the
substrings at the few positions where the shift fits the edits left and right of it. Entries are dealt into buckets by
their hashes, in packed rows. Lines that meet at an index entry are linked to the smallest of them; the components of these links are the groups in which partners are sought. In a
group the index is probed once more with the lines themselves, and candidates that aren't connected yet are verified by
edit distance in a band of diagonals, whose states are bits of small integers. A line's class is its component of
partners; the earliest line of a class stays.

Groups larger than a block are dealt out as pairs of blocks.

Defined results: null text is empty; lines end at line feeds; lines of white space are never compared and stay; lines
shorter than `min_chars` match only when equal; order is by id, then line number; rows with a null id are returned whole;
rows that share an id are the same document.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import cut, finish, free_shuffles, id_text, join_frequent, lean, power_of_two, text_chunks
from .components import connected_components

EDITS = 2
MIN_CHARS = 20
#: Lines of a block, and characters of a task that holds several small groups, on average.
BLOCK = 2_048
TASK_ROWS = 4_096
#: Bytes of text whose index entries are one bucket, on average; entries that a task packs at once; bits of the filter of
#: lines that have candidates.
BUCKET_BYTES = 8_000_000
WINDOW = 1 << 20
FILTER_BITS = 1 << 24


def line_key(line: str) -> int:
    """A line's signed 64-bit name."""
    return xxhash.xxh64_intdigest(line) - (1 << 63)


def segments(length: int, edits: int) -> list[tuple[int, int]]:
    """Start and size of each of edits + 1 segments that are as even as can be, the longer ones last."""
    parts = edits + 1
    base, longer = divmod(length, parts)
    out, at = [], 0
    for i in range(parts):
        size = base + (i >= parts - longer)
        out.append((at, size))
        at += size
    return out


def probes(length: int, edits: int) -> list[tuple[int, int, int, int]]:
    """(length of the partner, segment, start, size) of the substrings that a line of this length looks up.

    Only partners that aren't longer: the longer line of a pair does the asking.
    """
    out = []
    for other in range(max(length - edits, 1), length + 1):
        shift = length - other
        for i, (at, size) in enumerate(segments(other, edits)):
            left, right = i, edits - i
            for start in range(max(at - left, at + shift - right, 0), min(at + left, at + shift + right, length - size) + 1):
                out.append((other, i, start, size))
    return out


_PROBES: dict[tuple[int, int], list] = {}


def cached_probes(length: int, edits: int) -> list[tuple[int, int, int, int]]:
    got = _PROBES.get((length, edits))
    if got is None:
        if len(_PROBES) > 20_000:
            _PROBES.clear()
        got = _PROBES[length, edits] = probes(length, edits)
    return got


def within(a: str, b: str, edits: int) -> bool:
    """Whether the edit distance is at most edits: common ends are cut off, the rest runs through a band of diagonals.

    Bit t of level d says that the first i = j - edits + t characters of a can become the first j of b with d edits.
    """
    if abs(len(a) - len(b)) > edits:
        return False
    if a == b:
        return True
    at, most = 0, min(len(a), len(b))
    step = 1 << max(most.bit_length() - 1, 0)
    while step and at < most:
        if at + step <= most and a[at : at + step] == b[at : at + step]:
            at += step
        else:
            step >>= 1
    a, b, most = a[at:], b[at:], most - at
    end, step = 0, 1 << max(most.bit_length() - 1, 0)
    while step and end < most:
        if end + step <= most and a[len(a) - end - step : len(a) - end] == b[len(b) - end - step : len(b) - end]:
            end += step
        else:
            step >>= 1
    a, b = a[: len(a) - end], b[: len(b) - end]
    m, n, k = len(a), len(b), edits
    places: dict[str, int] = defaultdict(int)
    for i, c in enumerate(a):
        places[c] |= 1 << i
    full = (1 << 2 * k + 1) - 1
    levels = [0] * (k + 1)
    for d in range(k + 1):
        levels[d] = ((1 << d + 1) - 1) << k & full
        levels[d] &= (1 << m + k + 1) - 1
    for j, c in enumerate(b):
        s = j - k
        match = (places.get(c, 0) >> s if s >= 0 else places.get(c, 0) << -s) & full
        limit = m - (s + 1)  # the last bit that still is a prefix of a
        valid = (1 << limit + 1) - 1 & full if limit >= 0 else 0
        before, new = 0, 0
        for d in range(k + 1):
            old = levels[d]
            here = (old & match | before | before >> 1 | new << 1) & valid
            before, new = old, here
            levels[d] = here
        if not new:
            return False
    t = m - (n - k)
    return 0 <= t <= 2 * k and bool(levels[k] >> t & 1)


def comparable(line: str, min_chars: int) -> bool:
    return len(line) >= min_chars and not line.isspace()


def index_rows(texts: DataFrame, edits: int, min_chars: int, bits: int, window: int = WINDOW) -> DataFrame:
    """(bucket, fills, entries, names): the index entries that lines fill (first `fills` of a row) or only look up.

    A bucket holds the entries with the same first bits. A row packs those that up to `window` of a task's entries have in
    one bucket: of each the 48 bits after these, and the line's name.
    """

    def pack(entry: np.ndarray, name: np.ndarray, asks: np.ndarray) -> pa.RecordBatch:
        bucket = (entry >> np.uint64(64 - bits)).astype(np.int64)
        order = np.lexsort((entry, asks, bucket))
        entry, name, asks, bucket = entry[order], name[order], asks[order], bucket[order]
        low = ((entry << np.uint64(bits)) >> np.uint64(16)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
        bounds = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True])
        fills = np.add.reduceat(~asks, bounds[:-1], dtype=np.int64)
        pairs = list(zip(bounds[:-1], bounds[1:]))
        cols = [pa.array(bucket[bounds[:-1]], pa.int32()), pa.array(fills, pa.int32())]
        # the bytes of one rank lie together: those of ordered entries repeat
        cols += [pa.array([low[i:j].T.tobytes() for i, j in pairs], pa.binary()), pa.array([name[i:j].astype("<i8").tobytes() for i, j in pairs], pa.binary())]
        return pa.RecordBatch.from_arrays(cols, ["bucket", "fills", "entries", "names"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        held, size = [], 0
        for _, texts_ in text_chunks(batches, 500_000):
            lines = {x for t in texts_ for x in t.split("\n") if comparable(x, min_chars)}
            entry, name, asks = [], [], []
            for x in lines:
                key, own = line_key(x), segments(len(x), edits)
                for other, i, start, size_ in cached_probes(len(x), edits):
                    entry.append(digest(x[start : start + size_], other * 64 + i))
                    asks.append(not (other == len(x) and own[i][0] == start))
                name += [key] * (len(entry) - len(name))
            held.append((np.array(entry, np.uint64), np.array(name, np.int64), np.array(asks, bool)))
            size += len(entry)
            if size >= window:
                yield pack(*map(np.concatenate, zip(*held)))
                held, size = [], 0
        if size:
            yield pack(*map(np.concatenate, zip(*held)))

    return texts.mapInArrow(lean(run), "bucket int, fills int, entries binary, names binary")


def bucket_links(found: pa.Table) -> pa.Table:
    """(a, b): every line that meets others at a filled entry of a bucket, and the smallest of them."""
    entry, name, asks = [], [], []
    for fills, entries, names in zip(*(found.column(c).to_pylist() for c in ("fills", "entries", "names"))):
        n = len(names) // 8
        wide = np.zeros((n, 8), np.uint8)
        wide[:, :6] = np.frombuffer(entries, np.uint8).reshape(6, n).T
        entry.append(wide.view("<u8").ravel())
        name.append(np.frombuffer(names, "<i8"))
        asks.append(np.arange(n) >= fills)
    entry, name, asks = map(np.concatenate, (entry, name, asks))
    order = np.argsort(entry, kind="stable")
    entry, name, asks = entry[order], name[order], asks[order]
    starts = np.flatnonzero(np.r_[True, entry[1:] != entry[:-1]])
    sizes = np.diff(np.r_[starts, len(entry)])
    heads = np.minimum.reduceat(name, starts)
    met = np.repeat((sizes > 1) & ~np.logical_and.reduceat(asks, starts), sizes)
    head = np.repeat(heads, sizes)
    met &= name != head  # a line may fill an entry twice: no link then
    links = np.unique(np.stack([name[met], head[met]], 1), axis=0) if met.any() else np.zeros((0, 2), np.int64)
    return pa.table({"a": pa.array(links[:, 0], pa.int64()), "b": pa.array(links[:, 1], pa.int64())})


def member_filter(groups: DataFrame) -> np.ndarray:
    """Words of FILTER_BITS bits in which that of every grouped line is set; its size doesn't grow with the input."""
    bit = F.col("id").bitwiseAND(F.lit(FILTER_BITS - 1))
    words = groups.select(F.shiftright(bit, 6).cast("int").alias("word"), F.expr("shiftleft(1L, cast(id & 63 as int))").alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bit")).toArrow()
    out = np.zeros(FILTER_BITS >> 6, np.int64)
    out[words.column("word").to_numpy()] = words.column("bit").to_numpy()
    return out.view(np.uint64)


def join_group(lines: list[tuple[int, str]], edits: int, sides: list[int] | None = None) -> dict[int, int]:
    """Smallest connected name of every line that has a partner; with sides, only lines of unequal sides are compared."""
    order = sorted(range(len(lines)), key=lambda i: (len(lines[i][1]), lines[i]))
    parent = list(range(len(lines)))

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    index: dict[tuple, list[int]] = defaultdict(list)
    for i in order:
        x = lines[i][1]
        tried = set()
        for other, part, start, size in cached_probes(len(x), edits):
            for j in index.get((other, part, x[start : start + size]), ()):
                if j in tried or sides and sides[i] == sides[j]:
                    continue
                tried.add(j)
                a, b = top(i), top(j)
                if a != b and within(lines[j][1], x, edits):
                    parent[max(a, b)] = min(a, b)
        for part, (start, size) in enumerate(segments(len(x), edits)):
            index[len(x), part, x[start : start + size]].append(i)
    members = defaultdict(list)
    for i in range(len(lines)):
        members[top(i)].append(lines[i][0])
    return {name: min(m) for m in members.values() if len(m) > 1 for name in m}


def line_classes(texts: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS, block: int = BLOCK) -> DataFrame:
    """(line, class) of the lines that have partners; a class is named after its smallest line."""
    spark = texts.sparkSession
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = power_of_two(size / BUCKET_BYTES, 16)
    # each entry moves once, packed; no table of entries is written
    links = index_rows(texts, edits, min_chars, buckets.bit_length() - 1).groupBy("bucket").applyInArrow(lean(bucket_links), "a long, b long")
    groups = finish(lambda: connected_components(links))
    members = member_filter(groups)
    sizes = groups.groupBy("component").agg(F.count("*").alias("size"))
    tasks = power_of_two(groups.count() / TASK_ROWS, 16)
    met = groups.join(sizes, "component").withColumn("blocks", F.ceil(F.col("size") / block).cast("int"))
    met = met.withColumn("mine", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    small = F.col("blocks") == 1
    lo, hi = F.least("mine", "other"), F.greatest("mine", "other")
    met = met.select(F.col("id").alias("line"), "component", "mine", (~small).alias("split"), F.when(small, F.pmod(F.xxhash64("component"), F.lit(tasks))).otherwise(F.xxhash64("component", lo, hi)).alias("task"), F.when(small, F.lit(0)).otherwise(lo).alias("lo"), F.when(small, F.lit(0)).otherwise(hi).alias("hi"))

    def split_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts_ in text_chunks(batches):
            lines = list({x for t in texts_ for x in t.split("\n") if comparable(x, min_chars)})
            names = np.array(list(map(line_key, lines)), np.int64)
            bit = names & (FILTER_BITS - 1)
            maybe = np.flatnonzero(members[bit >> 6] >> (bit & 63).astype(np.uint64) & np.uint64(1))  # the join is exact
            yield pa.RecordBatch.from_arrays([pa.array(names[maybe], pa.int64()), pa.array([lines[i] for i in maybe], pa.string())], ["line", "content"])

    def compare(found: pa.Table) -> pa.Table:
        cells: dict[tuple, dict] = defaultdict(dict)
        cols = (found.column(c).to_pylist() for c in ("component", "lo", "hi", "line", "content", "mine", "split"))
        for component, lo_, hi_, name, content, mine, split in zip(*cols):
            cells[component, lo_, hi_][name] = (content, mine, split)
        out: list[list] = [[], [], []]
        for (_, lo_, hi_), lines in cells.items():
            names = sorted(lines)
            sides = [lines[n][1] for n in names] if lo_ != hi_ else None
            for name, root in join_group([(n, lines[n][0]) for n in names], edits, sides).items():
                for c, v in zip(out, (name, root, lines[name][2])):
                    c.append(v)
        return pa.table({"line": pa.array(out[0], pa.int64()), "root": pa.array(out[1], pa.int64()), "split": pa.array(out[2], pa.bool_())})

    contents = texts.mapInArrow(lean(split_lines), "line long, content string")
    found = cut(contents.join(met, "line").groupBy("task").applyInArrow(lean(compare), "line long, root long, split boolean"))
    free_shuffles(spark)
    wide = connected_components(found.where("split").select(F.col("line").alias("a"), F.col("root").alias("b")))
    return found.where("not split").select("line", F.col("root").alias("class")).union(wide.select("id", "component"))


def line_dedup(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS, block: int = BLOCK, with_text: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_lines, n_removed, removed_lines, removed_classes, kept_sha256 and, if asked for, the text that is left.

    removed_lines are line numbers from 0, removed_classes the names of their classes.
    """
    texts = id_text(docs, id_col, text_col)
    named = texts.where("doc_id is not null")
    classes = finish(lambda: line_classes(named, edits, min_chars, block))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts_ in text_chunks(batches):
            doc, no, name = [], [], []
            for i, t in zip(ids, texts_):
                for n, x in enumerate(t.split("\n")):
                    if x and not x.isspace():
                        doc.append(i)
                        no.append(n)
                        name.append(line_key(x))
            yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(no, pa.int32()), pa.array(name, pa.int64())], ["doc_id", "no", "line"])

    places = named.mapInArrow(lean(number), "doc_id long, no int, line long").join(classes, "line", "left").select("doc_id", "no", F.coalesce("class", "line").alias("class"))
    places = cut(places)
    free_shuffles(docs.sparkSession)
    first = places.groupBy("class").agg(F.min(F.struct("doc_id", "no")).alias("head"), F.count("*").alias("n")).where("n > 1")
    later = join_frequent(places, cut(first), ["class"], "n", places.count()).where(F.struct("doc_id", "no") != F.col("head"))
    gone = later.groupBy("doc_id").agg(F.array_sort(F.collect_set(F.struct("no", "class"))).alias("gone"))
    schema = "doc_id long, n_lines long, n_removed long, removed_lines array<int>, removed_classes array<long>, kept_sha256 string" + (", text string" if with_text else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[] for _ in range(7)]
            for i, t, g in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                lines = t.split("\n") if t else []
                numbers = [x["no"] for x in g or ()]
                drop = set(numbers)
                left = "\n".join(x for n, x in enumerate(lines) if n not in drop)
                for c, v in zip(out, (i, len(lines), len(numbers), numbers, [x["class"] for x in g or ()], hashlib.sha256(left.encode()).hexdigest(), left)):
                    c.append(v)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.string(), pa.string())
            names = [f.split()[0] for f in schema.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, types)][: len(names)], names)

    return texts.join(gone, "doc_id", "left").select("doc_id", "text", "gone").mapInArrow(lean(run), schema)

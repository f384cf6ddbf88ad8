"""Best-fit packing of token pieces into sequences by minimum bin slack.

How pieces fit depends on their lengths alone, so the plan is made from a histogram of at most `size` lengths, however
many pieces there are. For each bin, beginning with the longest length left, a subset-sum dynamic program over bitsets
finds the fullest combination of lengths still available; the combination is removed as often as the histogram allows
before the next one is sought. The plan is a list of length runs; every piece then takes the slot that its rank among
the pieces of its length names. Ranks come from counts by (length, bucket of the document) and a row number inside
each bucket, so no length is ever ordered in one task.

Defined results: null text is empty and has one piece with only the end id; longer documents are cut from the end
backwards so that the first piece may be the shorter one; repeated rows are packed once each; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._common import cut, id_text, lean, power_of_two
from .bpe import encoder

#: Pieces of one (length, bucket) group on average at most; groups are ordered inside one task.
GROUP_ROWS = 20_000

PIECES = "doc_id long, bucket int, piece int, start long, length int, ids_crc32 long"


def token_pieces(docs: DataFrame, path: str, size: int, end_id: int, buckets: int, id_col: str, text_col: str) -> DataFrame:
    """Pieces of at most `size` ids of every document, each with its checksum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(path), np.array([end_id], "<u4")
        for b in batches:
            ids, bounds = enc.encode_column(b.column(1))
            raw = memoryview(np.insert(ids, bounds[1:], end).astype("<u4", copy=False)).cast("B")  # the end id after each text
            begin = bounds[:-1] + np.arange(b.num_rows)
            n = np.diff(bounds) + 1
            pieces = -(-n // size)
            row = np.repeat(np.arange(b.num_rows), pieces)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            first = (n - 1) % size + 1
            start = np.where(piece > 0, first[row] + (piece - 1) * size, 0)
            length = np.where(piece > 0, size, first[row])
            at = (4 * (begin[row] + start)).tolist()
            sums = [zlib.crc32(raw[a : a + s]) for a, s in zip(at, (4 * length).tolist())]
            bucket = np.array([zlib.crc32(str(i).encode()) % buckets for i in b.column(0).to_pylist()], np.int32)
            cols = [b.column(0).take(pa.array(row)), pa.array(bucket[row]), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length.astype(np.int32)), pa.array(sums, pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, [f.split()[0] for f in PIECES.split(", ")])

    return id_text(docs, id_col, text_col).mapInArrow(lean(run), PIECES)


def fullest(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The combination of available lengths with the largest sum up to capacity that holds the longest one.

    Bit s of a reach set says that sum s can be had. Lengths come in from long to short, each in parcels of 1, 2, 4, …
    copies; walking the sets back from the largest sum tells which parcels it took.
    """
    longest = max(counts)
    room = capacity - longest
    mask = (1 << room + 1) - 1
    reach, steps = 1, []
    for length in sorted(counts, reverse=True):
        most = min(counts[length] - (length == longest), room // length)
        parcel = 1
        while most > 0:
            take = min(parcel, most)
            steps.append((length, take, reach))
            reach |= reach << length * take & mask
            most -= take
            parcel *= 2
        if reach >> room & 1:
            break
    total, used = reach.bit_length() - 1, {longest: 1}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            total -= length * take
            used[length] = used.get(length, 0) + take
    return used


def plan_bins(histogram: dict[int, int], size: int) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first rank, copies in a bin, first bin, first offset) that give every rank of a length its slot."""
    left = {k: n for k, n in histogram.items() if n > 0}
    given = dict.fromkeys(left, 0)
    runs, bins = [], 0
    while left:
        used = fullest(left, size)
        times = min(left[k] // c for k, c in used.items())
        offset = 0
        for k in sorted(used, reverse=True):
            c = used[k]
            runs.append((k, given[k], c, bins, offset))
            given[k] += c * times
            offset += c * k
            left[k] -= c * times
            if not left[k]:
                del left[k]
        bins += times
    return runs


def place(lengths: np.ndarray, ranks: np.ndarray, runs: list[tuple[int, int, int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of pieces by their length and rank."""
    table = np.array(sorted(runs), np.int64).reshape(-1, 5)
    at = np.zeros(len(lengths), np.int64)
    for k in np.unique(lengths):
        a, b = np.searchsorted(table[:, 0], [k, k + 1])
        mine = lengths == k
        at[mine] = a + np.searchsorted(table[a:b, 1], ranks[mine], "right") - 1
    _, first, copies, bin_, offset = table[at].T
    nth = ranks - first
    return bin_ + nth // copies, offset + nth % copies * lengths


def best_fit_pack(docs: DataFrame, size: int = 1024, end_id: int = 2, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: every piece with its place in a packed sequence.

    The driver holds only the histogram (at most `size` counters) and the plan made from it.
    """
    path = vocabulary or public_tokenizers.path("byte_bpe_50k.json")
    buckets = power_of_two(docs.count() / GROUP_ROWS, 64)
    pieces = cut(token_pieces(docs, path, size, end_id, buckets, id_col, text_col))
    cells = pieces.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    cells = cut(cells.select("length", "bucket", "n", F.coalesce(before, F.lit(0)).alias("before")))
    histogram = {r["length"]: r["n"] for r in cells.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = plan_bins(histogram, size)
    rank = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32"))
    ranked = pieces.withColumn("nth", rank).join(cells.drop("n"), ["length", "bucket"])
    ranked = ranked.select("doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", (F.col("before") + F.col("nth") - 1).alias("nth"))

    def seat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                bins, offsets = place(b.column(3).to_numpy(), b.column(5).to_numpy(), runs)
                yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(bins), pa.array(offsets)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(lean(seat), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")

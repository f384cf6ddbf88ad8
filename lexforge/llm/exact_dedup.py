"""Exact deduplication against a history that is held in minimal perfect hash tables.

The history's distinct digests are dealt out to shards by their first bytes. Each shard hashes its digests perfectly;
a slot holds the whole digest, the row that stays (its locator) and the group's size. New digests, already reduced to
one row each, look up their slot and compare all 32 bytes: equal means a repeat of that history row, anything else is no
member, and nonmembers form groups of their own. Without a history of its own, a table is taken in two waves: half of
the rows (by a hash of the id) are the history of the other half.

Defined results: null text is empty; of equal texts the row with the largest id stays; rows that share that id too are
the same row to this operator, so each of them counts in group_size and is marked kept; a null id never wins over
another; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import id_text, power_of_two
from .mphf import MinimalPerfectHash, digest_keys

#: Distinct digests a shard holds on average at most.
SHARD_ROWS = 50_000

GROUPS = "digest binary, keep_id long, group_size long"


class DigestIndex:
    """One shard: slots in the order of a minimal perfect hash."""

    def __init__(self, digests: np.ndarray, keep: np.ndarray, sizes: np.ndarray):
        self.hash = MinimalPerfectHash(digest_keys(digests))
        order = np.empty(len(digests), np.int64)
        order[self.hash.slots(digest_keys(digests))] = np.arange(len(digests))
        self.digests, self.keep, self.sizes = digests[order], keep[order], sizes[order]

    def find(self, digests: np.ndarray) -> np.ndarray:
        """The slot of each digest, -1 for nonmembers; all bytes are compared."""
        if not len(self.digests) or not len(digests):
            return np.full(len(digests), -1, np.int64)
        slots = self.hash.slots(digest_keys(digests))
        return np.where((slots >= 0) & (self.digests[slots] == digests).all(axis=1), slots, -1)


def _columns(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if not t.num_rows:
        return np.zeros((0, 32), np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64)
    digests = np.frombuffer(b"".join(t.column("digest").to_pylist()), np.uint8).reshape(-1, 32)
    keep = t.column("keep_id").fill_null(NO_ID).to_numpy()
    return digests, keep, t.column("group_size").to_numpy()


#: Stands for a null id while ids are compared.
NO_ID = -(2**63)


def resolve_shard(history: pa.Table, arrivals: pa.Table) -> pa.Table:
    """Groups of one shard: the history's with the arrivals that repeat them, then the groups of nonmembers."""
    old, keep, sizes = _columns(history)
    new, new_keep, new_sizes = _columns(arrivals)
    index = DigestIndex(old, keep, sizes)
    slots = index.find(new)
    member = slots >= 0
    np.maximum.at(index.keep, slots[member], new_keep[member])
    np.add.at(index.sizes, slots[member], new_sizes[member])
    digests = np.concatenate([index.digests, new[~member]])
    keep = np.concatenate([index.keep, new_keep[~member]])
    raw = digests.tobytes()
    return pa.table({
        "digest": pa.array([raw[i : i + 32] for i in range(0, len(raw), 32)], pa.binary()),
        "keep_id": pa.array(keep, pa.int64(), mask=keep == NO_ID),
        "group_size": pa.array(np.concatenate([index.sizes, new_sizes[~member]]), pa.int64()),
    })


def digests_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return id_text(docs, id_col, text_col).select("doc_id", F.unhex(F.sha2("text", 256)).alias("digest"))


def digest_groups(rows: DataFrame, shards: int) -> DataFrame:
    """One row for each distinct digest; equal digests are counted before they are shuffled."""
    shard = F.conv(F.substring(F.hex("digest"), 1, 8), 16, 10).cast("long") % shards
    return rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")).withColumn("shard", shard)


def text_groups(docs: DataFrame, history: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """digest, keep_id, group_size of every distinct text of history and docs together."""
    shards = power_of_two(docs.count() / SHARD_ROWS, 64)
    if history is None:
        early: Column = F.pmod(F.xxhash64(F.col(id_col).cast("long")), F.lit(2)) == 0
        history, docs = docs.where(early), docs.where(~early)
    old, new = (digest_groups(digests_of(d, id_col, text_col), shards) for d in (history, docs))
    # columns of the two sides must not be the same attributes: a cogroup of those loses some
    old, new = (d.select(*(F.col(c).alias(c) for c in d.columns)) for d in (old, new))
    return old.groupBy("shard").cogroup(new.groupBy("shard")).applyInArrow(resolve_shard, GROUPS)


def exact_dedup(docs: DataFrame, history: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row of docs.

    The rows meet their group in a sort-merge join on the digest, whose frequent keys Spark splits at run time.
    """
    groups = text_groups(docs, history, id_col, text_col)
    rows = digests_of(docs, id_col, text_col)
    return rows.join(groups, "digest").select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with the row that stays of each distinct text (rows that share id and text are the same row), columns as they were."""
    groups = text_groups(docs, None, id_col, text_col)
    digest = F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))
    winners = groups.select(F.col("digest").alias("_kept_digest"), F.col("keep_id").alias("_kept_id"))
    return docs.join(winners, (digest == F.col("_kept_digest")) & F.col(id_col).eqNullSafe(F.col("_kept_id")), "left_semi")


ORACLE = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""

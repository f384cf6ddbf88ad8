"""Whether chunks still cover their sources: outer joins of documents and chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as T


def document_fidelity(docs: DataFrame, chunks: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document on either side: source_chars, chunk_chars, n_chunks, retention.

    Lengths are those of the letters and digits; a title repeated at the head of a chunk doesn't count.
    """
    source = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.length(T.near_key(T.text_or_empty(F.col(text_col)))).alias("n"))
    source = source.groupBy("doc_id").agg(F.max("n").alias("source_chars"))
    body = chunk_bodies(chunks).groupBy("doc_id").agg(F.sum(F.length("flat")).alias("chunk_chars"), F.count("*").alias("n_chunks"))
    both = source.join(body, "doc_id", "full_outer")
    return both.withColumn("retention", F.when((F.col("source_chars") > 0) & F.col("n_chunks").isNotNull(), F.col("chunk_chars") / F.col("source_chars")))


def chunk_bodies(chunks: DataFrame) -> DataFrame:
    """(doc_id, flat): letters and digits of every chunk that isn't blank, without its repeated title."""
    c = T.text_or_empty(F.col("content"))
    flat = T.near_key(c)
    head = T.near_key(T.text_or_empty(F.col("dieu"))) if "dieu" in chunks.columns else F.lit("")
    rows = chunks.where(T.strip(c) != "").select(F.col("doc_id").cast("string").alias("doc_id"), flat.alias("flat"), head.alias("head"))
    rest = F.substr(F.col("flat"), F.length("head") + 1)
    return rows.select("doc_id", F.when((F.col("head") != "") & F.startswith("flat", F.col("head")), rest).otherwise(F.col("flat")).alias("flat"))


def containment(docs: DataFrame, chunks: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int | None = None) -> DataFrame:
    """(doc_id, contained, mangled): chunks found, or not, in their document; of the first `sample` documents by id.

    A document meets the list of its chunks once; its text isn't copied to each of them.
    """
    source = docs.select(F.col(id_col).alias("_order"), F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("_text"))
    source = source.orderBy("_order").limit(sample) if sample else source
    lists = chunk_bodies(chunks).where("flat <> ''").groupBy("doc_id").agg(F.collect_list("flat").alias("flats"))
    both = source.join(lists, "doc_id").withColumn("whole", T.near_key(T.text_or_empty(F.col("_text"))))
    both = both.select("doc_id", F.size("flats").alias("n"), F.size(F.filter("flats", lambda f: F.contains(F.col("whole"), f))).alias("contained"))
    return both.groupBy("doc_id").agg(F.sum("contained").alias("contained"), F.sum(F.col("n") - F.col("contained")).alias("mangled"))


def exact_median(df: DataFrame, column: str) -> DataFrame:
    """One row (median): the mean of the two middle values, nulls left out.

    Values are counted, counts are added up by stretch of values, and only the stretches that hold the middle are looked
    into; no task sees all values.
    """
    values = df.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("double").alias("v")).agg(F.count("*").alias("n")).withColumn("b", F.floor(F.col("v") * 4096))
    hist = values.groupBy("b").agg(F.sum("n").alias("n"))
    upto = F.sum("n").over(Window.orderBy("b"))  # a row a stretch
    hist = hist.select("b", (upto - F.col("n")).alias("before"), F.sum("n").over(Window.partitionBy()).alias("all"), F.col("n").alias("size"))
    low, high = F.floor((F.col("all") - 1) / 2), F.floor(F.col("all") / 2)
    hist = hist.where((F.col("before") <= high) & (F.col("before") + F.col("size") > low)).drop("size")  # two rows at most
    middle = values.join(F.broadcast(hist), "b").withColumn("to", F.col("before") + F.sum("n").over(Window.partitionBy("b").orderBy("v")))
    held = lambda r: (F.col("to") - F.col("n") <= r) & (F.col("to") > r)
    return middle.agg(((F.max(F.when(held(low), F.col("v"))) + F.max(F.when(held(high), F.col("v")))) / 2).alias("median"))


def fidelity_report(docs: DataFrame, chunks: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int | None = None) -> DataFrame:
    """One row of counts, retention and containment."""
    per = document_fidelity(docs, chunks, id_col, text_col)
    thin = F.coalesce(F.col("retention") < 0.5, F.lit(False))
    left = per.agg(
        F.count("source_chars").alias("source_documents"), F.count("n_chunks").alias("documents_with_chunks"),
        F.count_if(F.col("source_chars").isNotNull() & F.col("n_chunks").isNull()).alias("documents_with_no_chunks"),
        F.bround(F.avg("retention"), 3).alias("mean_character_retention"), F.count_if(thin).alias("documents_under_50pct_retained"),
    )
    middle = exact_median(per, "retention").select(F.bround("median", 3).alias("median_character_retention"))
    right = containment(docs, chunks, id_col, text_col, sample).agg(F.coalesce(F.sum(F.col("contained") + F.col("mangled")), F.lit(0)).alias("containment_checked"), F.coalesce(F.sum("contained"), F.lit(0)).alias("containment_ok"), F.coalesce(F.sum("mangled"), F.lit(0)).alias("containment_failed"))
    return left.crossJoin(middle).crossJoin(right)  # one row each


def missing_documents(docs: DataFrame, chunks: DataFrame, id_col: str = "doc_id", limit: int = 20) -> DataFrame:
    """The first documents without a chunk."""
    have = chunks.where(T.strip(T.text_or_empty(F.col("content"))) != "").select(F.col("doc_id").cast("string").alias("doc_id"))
    return docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(id_col).alias("_order")).join(have, "doc_id", "left_anti").orderBy("_order").limit(limit).select("doc_id")


def thin_documents(docs: DataFrame, chunks: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = 20) -> DataFrame:
    """The documents that kept least, of those under a half."""
    per = document_fidelity(docs, chunks, id_col, text_col).where("retention < 0.5")
    return per.select("doc_id", F.bround("retention", 3).alias("kept"), "source_chars", F.col("n_chunks").alias("chunks")).orderBy("kept", "doc_id").limit(limit)

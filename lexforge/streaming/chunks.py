"""The stages that look at one document, over a stream of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators.splitter import split_text


def read_documents(spark: SparkSession, path: str, schema: str = "id string, link string, name string, passage string", files_per_trigger: int = 100) -> DataFrame:
    """Documents of JSON-lines files as they arrive."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(path)


def stream_pieces(docs: DataFrame, text_col: str = "passage", **options) -> DataFrame:
    """One row per piece of each document: the other columns, part, n_parts, content, cut_by."""
    keep = [c for c in docs.columns if c != text_col]
    rows = split_text(docs.withColumn("_text", T.clean_content(T.normalize_text(F.col(text_col)))), "_text", "_pieces", **options)
    rows = rows.select(*keep, F.size("_pieces").alias("n_parts"), F.posexplode("_pieces").alias("_no", "_piece"))
    return rows.select(*keep, (F.col("_no") + 1).alias("part"), "n_parts", F.col("_piece.text").alias("content"), F.col("_piece.cut_by").alias("cut_by"))


def first_contents(pieces: DataFrame, time_col: str | None = None, watermark: str = "1 day") -> DataFrame:
    """Pieces whose content has not come before; with a time column, within the watermark only, which bounds the state."""
    keyed = pieces.withColumn("content_hash", F.md5("content"))
    if time_col:
        return keyed.withWatermark(time_col, watermark).dropDuplicatesWithinWatermark(["content_hash"])
    return keyed.dropDuplicates(["content_hash"])
